"""Every operator as a query over the given tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from checks import streams
from checks.given import AS_OF, Given, finish
from checks.sql import AS_OF as NOW, DEVICE, EV, PLAY_TYPES, completion, minute, rnd, units, with_tables, xavg, xsum
from marquee.functions import masking, scalars, vectors
from marquee.operators import erasure, factors, governance, hybrid, pruned, quality, rollups, rules, sessions, staging, text, vector
from marquee.plans import daily, incremental, marts
from marquee.session import cut_lineage, scratch_path
from marquee.sources import events as sources, lake, tables, upsert
from marquee.sources.contracts import CONTRACTS
from marquee.streaming import complete, jobs, monitors, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
BUILDERS: dict[str, Callable[[Given], DataFrame]] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; ``sql`` may mention the derived tables by name."""

    def add(build: Callable[[Given], DataFrame]):
        BUILDERS[name] = build
        QUERIES[name] = lambda spark, sf_dir: finish(build(Given(spark, sf_dir)))
        if sql is not None:
            SQL[name] = with_tables(sql)
        return build

    return add


PLAY = "count(*) FILTER (WHERE event_type = 'video_play')"
DONE = "count(*) FILTER (WHERE event_type = 'video_complete')"

# --- sources and sinks ------------------------------------------------------


@check("s02_read_events", "SELECT CAST(event_id AS VARCHAR) AS event_id, schema_version, CAST(user_id AS VARCHAR) AS user_id, event_time FROM raw")
def _(g):
    path, schema = scratch_path(g.spark, "events"), CONTRACTS["playback"].schema
    g.raw.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(path)
    return sources.read_events(g.spark, path, "playback").select("event_id", "schema_version", "user_id", F.col("event_time").cast("timestamp").alias("event_time"))


# texts that are no JSON keep nothing but themselves
DECODED = """
    SELECT CASE WHEN ok THEN CAST(event_id AS VARCHAR) END AS event_id, CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS user_id,
      schema_version, CASE WHEN ok THEN content_id END AS content_id, CASE WHEN ok THEN position_seconds END AS position_seconds, CASE WHEN NOT ok THEN 'not json' END AS broken
    FROM (SELECT *, coalesce(content_id, '') <> 'ghost_000092' AS ok FROM raw)"""


def event_text(g):
    """The deliveries as text files, a JSON object a line."""
    path = scratch_path(g.spark, "event-text")
    g.raw_json.select("value").write.text(path)
    return path


def decoded_rows(df):
    return df.select("event_id", "user_id", "schema_version", "content_id", "position_seconds", F.col("_corrupt_record").alias("broken"))


@check("s01_event_stream", DECODED)
def _(g):
    root = scratch_path(g.spark, "decoded")
    stream = sources.read_event_stream(g.spark, "playback", "text", path=event_text(g), maxFilesPerTrigger="4")
    streams.run_to_end(decoded_rows(stream), sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return sinks.read_batches(g.spark, f"{root}/t")


@check("s03_contract", DECODED)
def _(g):
    return decoded_rows(sources.read_events(g.spark, event_text(g), "playback", "text"))


@check("s04_schema_drift", """
    SELECT 'bad_version' AS kind, schema_version AS key, count(*) AS n FROM raw WHERE schema_version <> '1.0.0' GROUP BY schema_version
    UNION ALL SELECT 'unexpected_field', 'unauthorized_field', count(*) FROM raw WHERE schema_version <> '1.0.0' HAVING count(*) > 0
    UNION ALL SELECT 'missing_field', f, count(*) FROM raw, (SELECT unnest(['event_id', 'event_type', 'user_id', 'session_id',
      'device_id', 'device_type', 'app_version', 'content_id', 'position_seconds', 'playback_seconds', 'event_time', 'ingestion_time']) AS f)
      WHERE coalesce(content_id, '') = 'ghost_000092' OR (content_id IS NULL AND f = 'content_id') GROUP BY f""")
def _(g):
    return sources.schema_drift(g.raw_json, "playback")


@check("s07_replay", f"""
    SELECT CAST(user_id AS VARCHAR) AS key, 'ott.playback.events.v1' AS topic, event_id, true AS is_replayed FROM stg""")
def _(g):
    out = sources.replay(g.events.withColumn("category", F.lit("playback")))
    field = lambda n: F.get_json_object("value", f"$.{n}")
    return out.select("key", "topic", field("event_id").cast("bigint").alias("event_id"),
                      field("is_replayed").cast("boolean").alias("is_replayed"))


REASON = f"""CASE WHEN coalesce(content_id, '') = '' THEN 'Missing required field: ''content_id'''
      WHEN event_type NOT IN {PLAY_TYPES} THEN 'Invalid event_type: ''' || event_type || ''''
      WHEN event_time > {NOW} + INTERVAL 2 HOUR THEN 'Event timestamp is too far in future: ' || strftime(event_time, '%Y-%m-%d %H:%M:%S.%f') END"""
DEAD = f"SELECT event_id, content_id, ingestion_time, CASE WHEN coalesce(content_id, '') = 'ghost_000092' THEN 'Payload is not a valid JSON dictionary' ELSE {REASON} END AS failure_reason FROM raw"


def decoded(g):
    return sources.decode_json(g.raw_json.select("value"), "playback")


@check("s08_dead_letters", f"""
    SELECT failure_reason, 'ott.playback.events.v1' AS source_topic, {NOW} AS failed_at, count(*) AS n,
      CAST(sum(CASE WHEN failure_reason LIKE 'Payload%' THEN NULL ELSE event_id END) AS BIGINT) AS event_ids
    FROM ({DEAD}) WHERE failure_reason IS NOT NULL GROUP BY failure_reason""")
def _(g):
    _, bad = staging.split_valid(staging.validate_events(decoded(g), AS_OF))
    dlq = staging.to_dlq(bad, AS_OF)
    return dlq.groupBy("failure_reason", "source_topic", "failed_at").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.try_to_number(F.get_json_object("failed_event", "$.event_id"), F.lit("9999999999999")).cast("bigint")).alias("event_ids"))


class Sourced(Given):
    """Tables derived from rows that the relational source reads."""

    def read(self, name):
        return tables.read_table(self.spark, self.dir, pathGlobFilter=f"{name}.parquet")


@check("s10_relational_source", "SELECT * FROM users")
def _(g):
    return Sourced(g.spark, g.dir).users


@check("s11_sync_content", """
    SELECT content_id, coalesce(title, 'Untitled') AS title, CASE WHEN total_seasons > 40 THEN 'General' ELSE array_to_string(genres, '|') END AS genres,
      'en' AS language, release_year, CASE WHEN total_seasons > 45 THEN 'Unknown' ELSE director END AS director,
      CASE WHEN is_series THEN 5400 ELSE duration_seconds END AS duration_seconds, maturity_rating FROM content""")
def _(g):
    gap = lambda c, broken: F.when(~broken, F.col(c))
    docs = g.content.withColumns({
        "genres": gap("genres", F.col("total_seasons") > 40), "director": gap("director", F.col("total_seasons") > 45),
        "duration_seconds": gap("duration_seconds", F.col("is_series"))}).drop("language")
    return tables.sync_dim_content(docs)


@check("s12_sync_device", f"""
    SELECT CAST(s_suppkey AS VARCHAR) AS device_id, {DEVICE.format('s_nationkey')} AS device_type, s_name AS device_name,
      CASE WHEN s_acctbal > 1000 THEN 'Android' ELSE 'Unknown' END AS os,
      CASE WHEN s_acctbal > 5000 THEN '1.0.0' ELSE '2.1.0' END AS app_version FROM supplier""")
def _(g):
    return tables.sync_dim_device(g.devices)


def cdc_text(g):
    """Subscription changes as change-feed JSON; urgent ones come bare, the rest under payload."""
    row = F.struct("subscription_id", "user_id", "plan_id", "status")
    body = F.struct(
        F.when(F.col("op") == "d", row).alias("before"), F.when(F.col("op") != "d", row).alias("after"), "op",
        F.unix_millis("updated_at").alias("ts_ms"))
    orders = g.read("orders").select(F.col("o_orderkey").alias("subscription_id"), "o_orderpriority")
    bare = F.col("o_orderpriority") == "1-URGENT"
    return g.subs.join(orders, "subscription_id").select(
        F.when(bare, F.to_json(body)).otherwise(F.to_json(F.struct(body.alias("payload")))).alias("value"))


CDC_ROW = "subscription_id bigint, user_id bigint, plan_id string, status string"


@check("s13_decode_cdc", """
    SELECT subscription_id, CASE WHEN op = 'd' THEN NULL ELSE user_id END AS user_id, CASE WHEN op = 'd' THEN NULL ELSE plan_id END AS plan_id,
      CASE WHEN op = 'd' THEN NULL ELSE status END AS status, op, epoch_ms(updated_at) AS ts_ms FROM subs""")
def _(g):
    return sources.changed_rows(sources.decode_cdc(cdc_text(g), CDC_ROW), ["subscription_id"])


@check("s14_apply_changes", """
    SELECT user_id, plan_id, status, updated_at, seq FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, seq DESC) AS rn FROM (
        SELECT user_id, plan_id, status, updated_at, subscription_id AS seq, op FROM subs
        UNION ALL SELECT user_id, 'plan_0', 'expired', TIMESTAMP '1996-06-01', -1, 'r' FROM users)) WHERE rn = 1 AND op <> 'd'""")
def _(g):
    base = g.users.select("user_id", F.lit("plan_0").alias("plan_id"), F.lit("expired").alias("status"),
                          F.lit("1996-06-01").cast("timestamp").alias("updated_at"), F.lit(-1).cast("bigint").alias("seq"))
    feed = g.subs.withColumnRenamed("subscription_id", "seq")
    return upsert.apply_changes(base, feed, ["user_id"], ["updated_at", "seq"])


def progress_table(g):
    return g.users.select("user_id", F.lit("plan_9").alias("plan_id"), F.lit("none").alias("status"))


LATEST_SUB = """SELECT user_id, plan_id, status FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, subscription_id DESC) AS rn FROM subs) WHERE rn = 1"""


@check("s15_upsert", f"""
    SELECT user_id, plan_id, status FROM ({LATEST_SUB}) UNION ALL
    SELECT user_id, 'plan_9', 'none' FROM users WHERE user_id NOT IN (SELECT user_id FROM subs)""")
def _(g):
    newest = staging.latest_by_key(g.subs, ["user_id"], ["updated_at", "subscription_id"])
    return upsert.upsert(progress_table(g), newest.select("user_id", "plan_id", "status"), ["user_id"])


@check("s16_insert_ignore", """
    SELECT DISTINCT user_id, content_id, 'old' AS origin FROM stg WHERE event_type = 'video_complete' UNION ALL
    SELECT DISTINCT user_id, content_id, 'new' FROM stg WHERE event_type = 'video_play' AND (user_id, content_id) NOT IN
      (SELECT (user_id, content_id) FROM stg WHERE event_type = 'video_complete')""")
def _(g):
    kind = lambda t, name: g.events.where(F.col("event_type") == t).select("user_id", "content_id", F.lit(name).alias("origin"))
    return upsert.insert_ignore(kind("video_complete", "old").distinct(), kind("video_play", "new"), ["user_id", "content_id"])


@check("s20_metric_lines", f"""
    SELECT '# HELP media_dq_check_status Status of data quality check (1=PASS, 0=FAIL/WARN)' AS value
    UNION ALL SELECT '# TYPE media_dq_check_status gauge'
    UNION ALL SELECT 'media_dq_check_status{{check="freshness"}} ' || CASE WHEN lag_seconds <= 172800 THEN 1 ELSE 0 END FROM fresh
    UNION ALL SELECT 'media_dq_check_status{{check="null_and_duplicate_rates"}} ' || CASE WHEN null_user_rate <= 0.01 AND null_content_rate <= 0.05 AND duplicate_rate <= 0.25 THEN 1 ELSE 0 END FROM rates
    UNION ALL SELECT 'media_dq_check_status{{check="quarantine_routing"}} 1'
    UNION ALL SELECT '# HELP media_dq_quarantine_total Total records held in data quality quarantine'
    UNION ALL SELECT '# TYPE media_dq_quarantine_total gauge'
    UNION ALL SELECT 'media_dq_quarantine_total ' || count(*) FROM violations""")
def _(g):
    return quality.metric_lines(quality.run_suite(g.raw, g.content, AS_OF), quality.find_violations(g.raw, g.content, AS_OF))


# --- scalar functions -------------------------------------------------------


@check("p01_validate_events", f"SELECT event_id, ingestion_time, {REASON} AS failure_reason FROM raw")
def _(g):
    text_time = g.raw.withColumn("event_time", quality.stamp(F.col("event_time")))
    return staging.validate_events(text_time, AS_OF).select("event_id", "ingestion_time", "failure_reason")


@check("p02_split_valid", f"""
    SELECT 'valid' AS branch, count(*) AS n FROM ({DEAD}) WHERE failure_reason IS NULL
    UNION ALL SELECT 'invalid', count(*) FROM ({DEAD}) WHERE failure_reason IS NOT NULL""")
def _(g):
    ok, bad = staging.split_valid(staging.validate_events(decoded(g), AS_OF))
    return marts.platform_stats({"valid": ok, "invalid": bad}).withColumnRenamed("name", "branch")


@check("p03_parse_event_time", """
    SELECT event_id, CASE k % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 330 MINUTE
      WHEN 2 THEN date_trunc('milliseconds', ts) WHEN 3 THEN date_trunc('second', ts) END AS parsed FROM keyed""")
def _(g):
    ts, k = F.col("ts"), F.get_json_object("props", "$.k").cast("int")
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    text_time = (F.when(k % 5 == 0, F.concat(iso, F.lit("Z"))).when(k % 5 == 1, F.concat(iso, F.lit("+05:30")))
                 .when(k % 5 == 2, F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"))
                 .when(k % 5 == 3, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" junk"))).otherwise("not a time"))
    return g.read("events").select("event_id", scalars.parse_event_time(text_time).alias("parsed"))


@check("p04_partition_time", f"""
    SELECT event_id, CASE WHEN k < 50 THEN ts WHEN k < 80 THEN ts + INTERVAL 1 SECOND ELSE {NOW} END AS filed_at FROM keyed""")
def _(g):
    ts, k = F.col("ts").cast("timestamp"), F.get_json_object("props", "$.k").cast("int")
    when = scalars.partition_time(F.when(k < 50, ts), F.when(k < 80, ts + F.expr("INTERVAL 1 SECOND")), AS_OF)
    return g.read("events").select("event_id", when.alias("filed_at"))


@check("p05_topics", """
    SELECT event_id, CASE event_type WHEN 'view' THEN 'playback' WHEN 'signup' THEN 'search' ELSE 'subscriptions' END AS category,
      CASE event_type WHEN 'view' THEN 'ott.playback.events.v1' WHEN 'signup' THEN 'ott.search.events.v1' ELSE 'ott.subscription.cdc.v1' END AS topic FROM events""")
def _(g):
    kind = F.col("event_type")
    topic = F.when(kind == "view", scalars.PLAYBACK_TOPIC).when(kind == "signup", scalars.SEARCH_TOPIC).otherwise(scalars.SUBSCRIPTION_TOPIC)
    category = scalars.category_of(topic)
    return g.read("events").select("event_id", category.alias("category"), scalars.topic_of(category).alias("topic"))


@check("p07_stg_search", """
    SELECT event_id, user_id, session_id, device_id, query_text, results_count, selected_content_id,
      CASE WHEN coalesce(selected_content_id, '') <> '' THEN 1 ELSE 0 END AS has_click, event_time, ingestion_time FROM searches""")
def _(g):
    return staging.stg_search_events(g.searches)


@check("p08_stg_content", """
    SELECT content_id, title, array_to_string(genres, '|') AS genres, language, release_year, director, duration_seconds, maturity_rating FROM content""")
def _(g):
    return staging.stg_content(g.content)


@check("p09_fact_searches", """
    SELECT event_id, user_id, session_id, device_type, query_text, results_count, selected_content_id,
      CASE WHEN coalesce(selected_content_id, '') <> '' THEN 1 ELSE 0 END AS has_click, event_time FROM searches""")
def _(g):
    return staging.fact_searches(g.searches)


@check("p10_fact_engagement", "SELECT content_id, user_id, device_type, event_type, position_seconds, playback_seconds, event_time FROM stg")
def _(g):
    return staging.fact_content_engagement(g.events)


@check("p11_apply_ttl", f"SELECT event_id, event_time FROM raw WHERE event_time > {NOW} - INTERVAL 15 DAY")
def _(g):
    return staging.apply_ttl(g.raw, "event_time", 15, AS_OF).select("event_id", "event_time")


@check("p12_dates", f"""
    SELECT event_id, CAST(ts AS DATE) AS day, date_trunc('hour', ts) AS hour, CAST(date_trunc('week', ts) AS DATE) AS monday,
      CAST(year(ts) * 100 + month(ts) AS INTEGER) AS yyyymm, ({minute(NOW)} - {minute('ts')}) // 60 AS minutes_left,
      CAST(({NOW}::DATE - CAST(date_trunc('week', ts) AS DATE)) // 7 AS BIGINT) AS weeks, ts - INTERVAL 7 DAY AS week_before FROM events""")
def _(g):
    ts, now = F.col("ts").cast("timestamp"), scalars.as_time(AS_OF)
    monday = scalars.to_monday(ts)
    return g.read("events").select(
        "event_id", scalars.to_day(ts).alias("day"), scalars.to_hour(ts).alias("hour"), monday.alias("monday"),
        scalars.to_yyyymm(ts).alias("yyyymm"), scalars.minute_diff(ts, now).alias("minutes_left"),
        scalars.week_diff(monday, scalars.to_day(now)).alias("weeks"), scalars.shift(ts, days=-7).alias("week_before"))


@check("p13_math", f"""
    SELECT event_id, {rnd('value / 7.0e0', 2)} AS rounded, least(value, 100.0e0) AS capped, greatest(value, 100.0e0) AS floored,
      value / greatest(k, 1) AS ratio, {rnd('k / greatest(event_id, 1) * 100.0e0', 2)} AS share, {rnd('ln(1.0e0 + value)', 6)} AS logged FROM keyed""")
def _(g):
    v, k = F.col("value"), F.get_json_object("props", "$.k").cast("int")
    return g.read("events").select(
        "event_id", scalars.round_half_up(v / 7.0, 2).alias("rounded"), F.least(v, F.lit(100.0)).alias("capped"),
        F.greatest(v, F.lit(100.0)).alias("floored"), scalars.safe_ratio(v, k).alias("ratio"),
        scalars.pct(k, F.col("event_id")).alias("share"), scalars.round_half_up(F.log1p(v), 6).alias("logged"))


@check("p14_conditionals", """
    SELECT event_id, CASE WHEN content_id IS NULL OR content_id = '' THEN true ELSE false END AS missing,
      coalesce(nullif(content_id, ''), 'none') AS content_or_none, CASE WHEN event_type = 'video_play' THEN coalesce(playback_seconds, 30.0e0) ELSE 0.0e0 END AS play_seconds FROM raw""")
def _(g):
    return g.raw.select("event_id", scalars.is_missing(F.col("content_id")).alias("missing"),
                        F.coalesce(F.nullif(F.col("content_id"), F.lit("")), F.lit("none")).alias("content_or_none"),
                        sessions.play_seconds().alias("play_seconds"))


@check("p15_strings", """
    SELECT user_id, substr(CAST(user_id AS VARCHAR), 1, 8) || '...' AS short_id, regexp_replace(phone, '[^0-9]', '', 'g') AS digits,
      split_part(email, '@', 2) AS domain, country_code || ', ' || ip AS joined FROM users""")
def _(g):
    return g.users.select(
        "user_id", F.concat(F.substring(F.col("user_id").cast("string"), 1, 8), F.lit("...")).alias("short_id"),
        F.regexp_replace("phone", r"\D", "").alias("digits"), F.split_part(F.col("email"), F.lit("@"), F.lit(2)).alias("domain"),
        F.concat_ws(", ", "country_code", "ip").alias("joined"))


@check("p16_arrays", """
    SELECT user_id, count(DISTINCT content_id) AS titles, count(DISTINCT content_id) FILTER (WHERE content_id = 'cnt_000007') > 0 AS has_seven,
      string_agg(DISTINCT content_id, ',' ORDER BY content_id) AS title_list FROM stg GROUP BY user_id""")
def _(g):
    sets = g.events.groupBy("user_id").agg(F.sort_array(F.collect_set("content_id")).alias("s"))
    return sets.select("user_id", F.size("s").cast("bigint").alias("titles"), F.array_contains("s", "cnt_000007").alias("has_seven"),
                       F.array_join("s", ",").alias("title_list"))


@check("p17_json", """
    SELECT event_id, k, '{"event_id":' || CAST(event_id AS VARCHAR) || ',"event_type":"' || event_type || '"}' AS payload FROM keyed""")
def _(g):
    return g.read("events").select("event_id", F.from_json("props", "k int").getField("k").alias("k"),
                                   F.to_json(F.struct("event_id", "event_type")).alias("payload"))


# --- joins ------------------------------------------------------------------


@check("j02_enrich_events", "SELECT event_id, content_id, content_title, content_duration_seconds FROM rich")
def _(g):
    return sessions.enrich_events(g.events, g.content).select("event_id", "content_id", "content_title", "content_duration_seconds")


@check("j05_unknown_content", "SELECT event_id, content_id FROM stg WHERE content_id NOT IN (SELECT content_id FROM content)")
def _(g):
    return quality.unknown_content(g.events, g.content).select("event_id", "content_id")


SUBSCRIBERS = """SELECT s.user_id, email_masked AS email, phone_masked AS phone, country_code, status AS subscription_status, plan_name
    FROM subs s JOIN plans p ON s.plan_id = p.plan_id JOIN masked_users u ON u.user_id = s.user_id WHERE status = 'active'"""


@check("j06_active_subscribers", SUBSCRIBERS)
def _(g):
    return marts.active_subscribers(g.users, g.subs, g.plans)


@check("j06_newest_subscribers", SUBSCRIBERS + " ORDER BY created_at DESC, s.user_id, s.plan_id LIMIT 10")
def _(g):
    return marts.active_subscribers(g.users, g.subs, g.plans, n=10)


@check("j07_lookup_content", "SELECT content_id, title FROM content WHERE content_id IN (SELECT content_id FROM stg)")
def _(g):
    return marts.lookup_content(g.events, g.content).select("content_id", "title")


@check("j08_lookup_catalog", """
    SELECT s.content_id, coalesce(c.title, 'Untitled') AS title, CASE WHEN is_series THEN 'series' WHEN NOT is_series THEN 'movie' END AS type
    FROM (SELECT DISTINCT content_id FROM stg) s LEFT JOIN content c ON s.content_id = c.content_id""")
def _(g):
    return marts.lookup_catalog(g.events.select("content_id").distinct(), g.movies, g.series, "Untitled").select("content_id", "title", "type")


@check("j10_merge_candidates", """
    SELECT coalesce(w.item_id, s.item_id) AS item_id, coalesce(w.content_id, s.content_id) AS content_id,
      floor((coalesce(w.lift * 0.1e0, 0.0e0) + coalesce(s.semantic_score * 0.5e0, 0.0e0)) * 10000.0e0 + 0.5e0) / 10000.0e0 AS score,
      CASE WHEN s.item_id IS NULL THEN 'left' WHEN w.item_id IS NULL THEN 'right' ELSE 'both' END AS strategy
    FROM (SELECT antecedent_content_id AS item_id, consequent_content_id AS content_id, lift FROM rules) w
    FULL JOIN item_sims s ON w.item_id = s.item_id AND w.content_id = s.content_id""")
def _(g):
    keys = ["item_id", "content_id"]
    a = purchase_rules(g).select(F.col("antecedent_content_id").alias("item_id"), F.col("consequent_content_id").alias("content_id"), F.col("lift").alias("score"))
    b = item_sims(g).where(F.col("item_id") != F.col("content_id")).groupBy(*keys).agg(F.max("similarity_score").alias("score"))
    return hybrid.merge_candidates(a, b, keys, 0.1, 0.5, ("left", "right", "both"))


# --- aggregations and models ------------------------------------------------


@check("a01_watch_sessions", "SELECT * FROM sessions")
def _(g):
    return g.sessions


@check("a02_daily_user_activity", "SELECT user_id, activity_date, sessions_count, daily_watch_seconds, daily_watch_hours, avg_completion_pct FROM activity")
def _(g):
    return g.activity


@check("a03_content_engagement", "SELECT * FROM engagement")
def _(g):
    return marts.content_engagement(g.sessions)


@check("a04_subscription_history", """
    SELECT user_id, 'premium' AS subscription_tier, 'active' AS current_status, min(session_start) AS subscription_started_at,
      max(session_end) AS last_active_at FROM sessions GROUP BY user_id""")
def _(g):
    return marts.subscription_history(g.sessions)


@check("a04_subscription_history_real", f"""
    SELECT h.user_id, coalesce(l.plan_id, 'premium') AS subscription_tier, coalesce(l.status, 'active') AS current_status, subscription_started_at, last_active_at
    FROM (SELECT user_id, min(session_start) AS subscription_started_at, max(session_end) AS last_active_at FROM sessions GROUP BY user_id) h
    LEFT JOIN ({LATEST_SUB}) l ON l.user_id = h.user_id""")
def _(g):
    newest = staging.latest_by_key(g.subs, ["user_id"], ["updated_at", "subscription_id"])
    return marts.subscription_history(g.sessions, newest.select(
        "user_id", F.col("plan_id").alias("subscription_tier"), F.col("status").alias("current_status")))


@check("a05_churn_features", "SELECT * FROM churn")
def _(g):
    return marts.churn_features(g.sessions, staging.stg_search_events(g.searches), g.recs, AS_OF)


@check("a06_daily_platform_metrics", "SELECT * FROM daily")
def _(g):
    return marts.daily_platform_metrics(g.activity)


@check("a07_recommendation_performance", f"""
    SELECT CAST(event_time AS DATE) AS event_date, model_version, count(*) AS total_recommendations_shown,
      count(*) FILTER (WHERE event_type = 'recommendation_click') AS total_clicks,
      {rnd("count(*) FILTER (WHERE event_type = 'recommendation_click') / greatest(count(*), 1) * 100.0e0", 2)} AS recommendation_ctr
    FROM recs GROUP BY CAST(event_time AS DATE), model_version""")
def _(g):
    return marts.recommendation_performance(g.recs)


@check("a08_weekly_retention", """
    SELECT cohort_week, activity_week, CAST((activity_week - cohort_week) // 7 AS BIGINT) AS week_number, count(DISTINCT user_id) AS active_users_in_cohort FROM (
      SELECT a.user_id, cohort_week, CAST(date_trunc('week', activity_date) AS DATE) AS activity_week FROM activity a
      JOIN (SELECT user_id, CAST(date_trunc('week', min(activity_date)) AS DATE) AS cohort_week FROM activity GROUP BY user_id) f ON a.user_id = f.user_id)
    GROUP BY cohort_week, activity_week""")
def _(g):
    return marts.weekly_retention(g.activity)


DAY_N = ", ".join(f"count(*) FILTER (WHERE age = {n}) AS day_{n}_retained" for n in (1, 7, 14, 30))
RATE_N = ", ".join(rnd(f"day_{n}_retained / greatest(total_cohort_users, 1) * 100.0e0", 2) + f" AS day_{n}_retention_rate" for n in (1, 7, 14, 30))


@check("a09_day_n_retention", f"""
    SELECT *, {RATE_N} FROM (SELECT cohort_date, count(*) FILTER (WHERE age = 0) AS total_cohort_users, {DAY_N} FROM (
      SELECT min(activity_date) OVER (PARTITION BY user_id) AS cohort_date, activity_date - min(activity_date) OVER (PARTITION BY user_id) AS age FROM activity)
      GROUP BY cohort_date)""")
def _(g):
    return marts.day_n_retention(g.activity)


@check("a10_stg_users", """
    SELECT user_id, device_type, app_version, date_trunc('second', min(event_time)) AS first_seen_at, date_trunc('second', max(event_time)) AS last_seen_at
    FROM stg GROUP BY user_id, device_type, app_version""")
def _(g):
    return staging.stg_users(g.events)


HOURLY = f"""SELECT content_id, date_trunc('hour', event_time) AS window_hour, {PLAY} AS total_plays, {DONE} AS total_completions,
    {xsum('playback_seconds')} AS total_watch_seconds, count(DISTINCT user_id) AS unique_viewers_count FROM raw GROUP BY content_id, date_trunc('hour', event_time)"""
PLATFORM = f"""SELECT CAST(event_time AS DATE) AS metric_date, count(*) AS total_events, {PLAY} AS total_plays, count(DISTINCT user_id) AS unique_active_users,
    {rnd(xsum('playback_seconds') + ' / 3600.0e0', 2)} AS total_watch_hours, {rnd(xavg('playback_seconds') + ' / 60.0e0', 2)} AS avg_session_minutes
    FROM raw GROUP BY CAST(event_time AS DATE)"""


@check("a11_content_hourly", HOURLY)
def _(g):
    return rollups.content_hourly(g.raw)


@check("a12_platform_daily", PLATFORM)
def _(g):
    return rollups.platform_daily(g.raw)


def merged(g, grain):
    """States of plays and of all other events, merged."""
    play = F.col("event_type") == "video_play"
    parts = [rollups.rollup_partial(g.raw.where(kind), grain) for kind in (play, ~play)]
    return rollups.rollup_finish(rollups.rollup_merge(staging.union_all(parts), grain), grain)


@check("a13_rollup_merge_hourly", HOURLY)
def _(g):
    return merged(g, "content_hourly")


@check("a13_rollup_merge_daily", PLATFORM)
def _(g):
    return merged(g, "platform_daily")


@check("a14_gold_content_daily", f"""
    SELECT metric_date, q.content_id, title, array_to_string(genres, '|') AS genres, release_year, total_plays, total_completions, unique_viewers,
      total_watch_hours, avg_completion_rate, {NOW} AS created_at FROM (
      SELECT CAST(event_time AS DATE) AS metric_date, content_id, {PLAY} AS total_plays, {DONE} AS total_completions, count(DISTINCT user_id) AS unique_viewers,
        {rnd(xsum('playback_seconds') + ' / 3600.0e0', 2)} AS total_watch_hours, {rnd(xavg('completion_percentage'), 2)} AS avg_completion_rate
      FROM silver GROUP BY CAST(event_time AS DATE), content_id) q LEFT JOIN content c ON q.content_id = c.content_id""")
def _(g):
    return marts.gold_content_daily(silver(g), g.content, AS_OF)


def silver(g):
    return sessions.silver_playback(g.raw, g.content, AS_OF, "event_id", scope=["source_partition"])


@check("a15_silver_playback", "SELECT * FROM silver")
def _(g):
    return silver(g)


@check("a16_event_distribution", f"""
    SELECT event_type, count(*) AS event_count, {rnd(xavg('position_seconds'), 2)} AS avg_position_sec, {rnd(xavg('playback_seconds'), 2)} AS avg_played_sec
    FROM raw GROUP BY event_type""")
def _(g):
    return marts.event_distribution(g.raw)


@check("a17_recent_play_stats", f"""
    SELECT count(*) AS event_cnt, {rnd(xavg('playback_seconds'), 2)} AS avg_played FROM raw
    WHERE event_type = 'video_play' AND event_time >= {NOW} - INTERVAL 14 DAY""")
def _(g):
    return marts.recent_play_stats(g.raw, AS_OF)


@check("a18_device_breakdown", f"""
    SELECT device_type, count(*) AS event_cnt, {rnd(xsum('playback_seconds'), 2)} AS total_watch FROM raw GROUP BY device_type""")
def _(g):
    return marts.device_breakdown(g.raw)


@check("a19_platform_stats", """
    SELECT 'raw_playback_events' AS name, count(*) AS n FROM raw UNION ALL SELECT 'watch_sessions', count(*) FROM sessions
    UNION ALL SELECT 'catalog_titles', count(*) FROM content UNION ALL SELECT 'registered_users', count(*) FROM users
    UNION ALL SELECT 'vector_embeddings', count(*) FROM embeddings""")
def _(g):
    return marts.platform_stats({
        "raw_playback_events": g.raw, "watch_sessions": g.sessions, "catalog_titles": g.movies.select("content_id").unionByName(g.series.select("content_id")),
        "registered_users": g.users, "vector_embeddings": g.chunks})


@check("a20_refresh_features", f"""
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY features_updated_at DESC) AS rn FROM (
      SELECT user_id, 1.0e0 AS genre_watch_minutes_7d, 2.0e0 AS genre_watch_minutes_30d, 3.0e0 AS content_completion_rate, CAST(4 AS BIGINT) AS search_count_7d,
        CAST(5 AS BIGINT) AS active_days_30d, 6.0e0 AS recommendation_ctr, 7.0e0 AS average_session_length, TIMESTAMP '2024-01-01' AS features_updated_at FROM users
      UNION ALL SELECT *, {NOW} FROM churn)) WHERE rn = 1""")
def _(g):
    features = marts.churn_features(g.sessions, staging.stg_search_events(g.searches), g.recs, AS_OF)
    old = g.users.select("user_id", *[F.lit(i + 1).cast(f.dataType).alias(f.name) for i, f in enumerate(features.schema.fields[1:])],
                         F.lit("2024-01-01").cast("timestamp").alias("features_updated_at"))
    return marts.refresh_features(old, features, AS_OF)


# --- windows, sorts, limits, set operations ---------------------------------


@check("w01_stg_playback_events", f"SELECT {EV} FROM stg")
def _(g):
    return g.events


@check("w02_daily_content_rank", "SELECT engagement_date, content_id, daily_rank FROM engagement")
def _(g):
    return marts.content_engagement(g.sessions).select("engagement_date", "content_id", "daily_rank")


@check("w02_rank_by_range", "SELECT engagement_date, content_id, daily_rank FROM engagement")
def _(g):
    return marts.content_engagement(g.sessions, ranges=13).select("engagement_date", "content_id", "daily_rank")


PERFORMANCE = """SELECT e.content_id, content_title, engagement_date, array_to_string(genres, '|') AS genres, language, release_year, director, total_sessions,
    unique_viewers, total_watch_hours, avg_completion_percentage, daily_rank, CAST(sum({u}) OVER (PARTITION BY e.content_id ORDER BY {o}) AS DOUBLE) / 10000.0e0 AS rolling_7d_watch_hours
    FROM engagement e LEFT JOIN content c ON e.content_id = c.content_id"""


@check("w03_content_performance", PERFORMANCE.format(u=units("total_watch_hours"), o="engagement_date, content_title ROWS BETWEEN 6 PRECEDING AND CURRENT ROW"))
def _(g):
    return marts.content_performance(marts.content_engagement(g.sessions), g.content)


@check("w03_content_performance_days", PERFORMANCE.format(u=units("total_watch_hours"), o="engagement_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))
def _(g):
    return marts.content_performance(marts.content_engagement(g.sessions), g.content, range_days=7)


@check("w04_latest_by_key", """
    SELECT * EXCLUDE (rn) FROM (SELECT user_id, plan_id, status, subscription_id, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, subscription_id DESC) AS rn FROM subs) WHERE rn = 1""")
def _(g):
    return staging.latest_by_key(g.subs, ["user_id"], ["updated_at", "subscription_id"]).select("user_id", "plan_id", "status", "subscription_id")


@check("w05_top_k", """
    SELECT * FROM (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_shipdate,
      row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate) AS rank FROM lineitem) WHERE rank <= 3""")
def _(g):
    cols = ["l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    order = [F.col("l_extendedprice").desc()] + [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_shipdate")]
    return staging.top_k(g.read("lineitem").select(*cols), ["l_suppkey"], order, 3)


@check("w06_recent_watches", """
    SELECT * FROM (SELECT user_id, content_id, event_time, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rank FROM stg) WHERE rank <= 5""")
def _(g):
    return hybrid.recent_watches(g.events, 5)


@check("w06_recent_titles", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, event_id DESC) AS rank FROM (
      SELECT user_id, content_id, max(event_time) AS event_time, max(event_id) AS event_id FROM stg GROUP BY user_id, content_id)) WHERE rank <= 5""")
def _(g):
    return hybrid.recent_watches(g.events, 5, distinct=True)


PROGRESS = f"""SELECT p.user_id, p.content_id, position_seconds, coalesce(CAST(c.duration_seconds AS DOUBLE), 7200.0e0) AS duration_seconds,
      {rnd('position_seconds / greatest(coalesce(CAST(c.duration_seconds AS DOUBLE), 7200.0e0), 1.0e0) * 100.0e0', 1)} AS completion_percentage, event_time AS updated_at, c.title, c.is_series
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, content_id ORDER BY event_time DESC, event_id DESC) AS rn FROM stg) p
    LEFT JOIN content c ON p.content_id = c.content_id WHERE rn = 1"""


@check("w07_continue_watching", f"""
    SELECT user_id, content_id, position_seconds, duration_seconds, completion_percentage, updated_at, rank, title, CASE WHEN is_series THEN 'series' ELSE 'movie' END AS type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, content_id) AS rank FROM ({PROGRESS}) WHERE position_seconds > 0 AND completion_percentage < 95)
    WHERE rank <= 6 AND title IS NOT NULL""")
def _(g):
    return marts.continue_watching(marts.watch_progress(g.events, g.content), g.movies, g.series)


@check("w08_watch_progress", f"SELECT * EXCLUDE (title, is_series) FROM ({PROGRESS})")
def _(g):
    return marts.watch_progress(g.events, g.content)


@check("w09_top_active_users", f"""
    SELECT user_id, count(*) AS play_count, {xsum('playback_seconds')} AS total_seconds FROM raw WHERE event_type = 'video_play'
    GROUP BY user_id ORDER BY total_seconds DESC, user_id LIMIT 10""")
def _(g):
    return marts.top_active_users(g.raw)


@check("w10_latest_events", """
    SELECT event_id, event_type, user_id, content_id, device_type, position_seconds, event_time FROM stg ORDER BY event_time DESC, event_id LIMIT 5""")
def _(g):
    return marts.latest_events(g.events)


@check("w11_catalog", """
    SELECT content_id, title, type FROM (SELECT content_id, title, CASE WHEN is_series THEN 'series' ELSE 'movie' END AS type FROM content
      WHERE list_contains(genres, 'Brand#7')) ORDER BY type, content_id LIMIT 60""")
def _(g):
    return marts.catalog(g.movies, g.series, genre="Brand#7").select("content_id", "title", "type")


@check("w12_unwatched", """
    SELECT user_id, content_id FROM raw WHERE event_type = 'error' AND content_id <> '' EXCEPT SELECT user_id, content_id FROM stg""")
def _(g):
    tried = g.raw.where((F.col("event_type") == "error") & (F.col("content_id") != "")).select("user_id", "content_id")
    return tried.join(g.events.select("user_id", "content_id"), ["user_id", "content_id"], "left_anti").distinct()


# --- stream operators, batch twins ------------------------------------------


@check("t04_late_flag", """
    SELECT event_id, source_partition, event_time, event_time < max(event_time) OVER (PARTITION BY source_partition ORDER BY event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND AS is_late FROM stg""")
def _(g):
    keyed = g.events.withColumn("source_partition", F.col("user_id") % 6)
    return sessions.late_flag(keyed, "event_id", scope=["source_partition"], chunk_rows=500).select("event_id", "source_partition", "event_time", "is_late")


@check("t04_late_flag_global", """
    SELECT event_id, event_time < max(event_time) OVER (ORDER BY event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 900 SECOND AS is_late FROM stg""")
def _(g):
    return sessions.late_flag(g.events, "event_id", 900.0, chunk_rows=500).select("event_id", "is_late")


PLAY_SESSIONS = f"""SELECT user_id, session_id, content_id, device_type, app_version, watch_seconds, pause_count, seek_count,
      {completion('last_pos', 'greatest(last_dur, 1.0e0)')} AS completion_percentage, session_start, session_end FROM (
      SELECT user_id, session_id, min_by(content_id, (event_time, event_id)) AS content_id, min_by(device_type, (event_time, event_id)) AS device_type,
        min_by(app_version, (event_time, event_id)) AS app_version,
        {xsum("CASE WHEN event_type = 'video_play' THEN playback_seconds ELSE 0.0e0 END")} AS watch_seconds,
        count(*) FILTER (WHERE event_type = 'video_pause') AS pause_count, count(*) FILTER (WHERE event_type = 'video_seek') AS seek_count,
        max_by(position_seconds, (event_time, event_id)) AS last_pos, max_by(content_duration_seconds, (event_time, event_id)) AS last_dur,
        min(event_time) AS session_start, max(event_time) AS session_end FROM rich GROUP BY user_id, session_id)"""


@check("t05_play_sessions", PLAY_SESSIONS)
def _(g):
    return sessions.play_sessions(g.events, g.content)


TUMBLING = f"""SELECT date_trunc('minute', event_time) AS window_start, date_trunc('minute', event_time) + INTERVAL 1 MINUTE AS window_end, content_id,
      count(*) AS events_count, {PLAY} AS plays, {xsum("CASE WHEN event_type = 'video_play' THEN playback_seconds ELSE 0.0e0 END")} AS watch_seconds
    FROM stg GROUP BY date_trunc('minute', event_time), content_id"""


@check("t06_tumbling_metrics", TUMBLING)
def _(g):
    return sessions.tumbling_metrics(g.events)


# the streams themselves, run until the table is used up

@check("t01_stream_events", """
    SELECT r.event_id, r.content_id, content_title, r.event_time < max(r.event_time) OVER (PARTITION BY source_partition ORDER BY r.event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND AS is_late FROM rich r""")
def _(g):
    return streams.playback(g, "events").select("event_id", "content_id", "content_title", "is_late")


@check("t02_stream_dead_letters", f"""
    SELECT failure_reason, count(*) AS n FROM (SELECT {REASON} AS failure_reason FROM raw) WHERE failure_reason IS NOT NULL GROUP BY failure_reason""")
def _(g):
    dead = streams.playback(g, "dead_letters")
    # the text of a time drops trailing zeros; write all six digits as the SQL does
    when = F.regexp_extract("failure_reason", r"future: (.*)$", 1)
    full = F.concat(F.lit("Event timestamp is too far in future: "), quality.stamp(F.try_to_timestamp(when)))
    return dead.select(F.when(when != "", full).otherwise(F.col("failure_reason")).alias("failure_reason")).groupBy("failure_reason").agg(F.count(F.lit(1)).alias("n"))


@check("t03_stream_dedup", "SELECT event_id, user_id, event_time FROM stg")
def _(g):
    root = scratch_path(g.spark, "dedup")
    ok, _ = jobs.stream_split(streams.Streamed(g, "events").raw, AS_OF)
    streams.run_to_end(jobs.stream_dedup(ok), sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return sinks.read_batches(g.spark, f"{root}/t").select("event_id", "user_id", "event_time")


CLOSED = "(SELECT max(event_time) - INTERVAL 30 SECOND FROM stg)"


@check("t05_stream_sessions", f"""
    SELECT user_id, session_id, min(event_time) AS segment_start, {xsum("CASE WHEN event_type = 'video_play' THEN playback_seconds ELSE 0.0e0 END")} AS watch_seconds,
      count(*) FILTER (WHERE event_type = 'video_pause') AS pause_count, count(*) FILTER (WHERE event_type = 'video_seek') AS seek_count, max(event_time) AS session_end
    FROM (SELECT *, sum(opens) OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) AS segment FROM (
      SELECT *, CASE WHEN event_time > lag(event_time) OVER (PARTITION BY user_id, session_id ORDER BY event_time, event_id) + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS opens FROM stg))
    GROUP BY user_id, session_id, segment HAVING max(event_time) + INTERVAL 30 MINUTE <= {CLOSED}""")
def _(g):
    units = F.col("watch_units") / F.lit(scalars.UNITS_PER_SECOND)
    return streams.playback(g, "sessions").select(
        "user_id", "session_id", "segment_start", units.alias("watch_seconds"), "pause_count", "seek_count", "session_end")


@check("t06_stream_windows", f"SELECT * FROM ({TUMBLING}) WHERE window_end <= {CLOSED}")
def _(g):
    return streams.playback(g, "windows")


@check("t07_stream_content_hourly", f"SELECT * FROM ({HOURLY}) WHERE window_hour + INTERVAL 1 HOUR <= (SELECT max(event_time) - INTERVAL 30 SECOND FROM raw)")
def _(g):
    return streams.windowed_rollup(g, "content_hourly")


@check("t07_rollup_states", HOURLY)
def _(g):
    return streams.rolled_up(g, "content_hourly")


@check("t08_stream_platform_daily", f"SELECT * FROM ({PLATFORM}) WHERE metric_date + INTERVAL 1 DAY <= (SELECT max(event_time) - INTERVAL 30 SECOND FROM raw)")
def _(g):
    return streams.windowed_rollup(g, "platform_daily")


@check("t08_rollup_states", PLATFORM)
def _(g):
    return streams.rolled_up(g, "platform_daily")


@check("t09_stream_archive", "SELECT event_id, ingestion_time, 'playback' AS category, strftime(event_time, '%Y-%m-%d') AS date, strftime(event_time, '%H') AS hour FROM raw")
def _(g):
    return streams.archived(g)


@check("s05_archive_of_both", "SELECT event_id, ingestion_time, 'playback' AS category, strftime(event_time, '%Y-%m-%d') AS date, strftime(event_time, '%H') AS hour FROM raw")
def _(g):
    return streams.archived(g, by_stream=F.col("event_id") % 2 == 0)


@check("s06_bronze", "SELECT CAST(event_time AS DATE) AS event_day, CAST(date_part('hour', event_time) AS INT) AS event_hour, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS event_ids FROM raw GROUP BY 1, 2")
def _(g):
    root = scratch_path(g.spark, "bronze")
    lake.write_bronze(g.raw, root)
    return g.spark.read.parquet(root).groupBy("event_day", "event_hour").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("event_ids"))


@check("s18_sorted_playback", """
    SELECT event_id, user_id, event_time FROM stg, (SELECT min(event_time) + (max(event_time) - min(event_time)) / 2 AS middle FROM stg)
    WHERE event_time >= date_trunc('day', middle) AND event_time < date_trunc('day', middle) + INTERVAL 9 DAY""")
def _(g):
    root = scratch_path(g.spark, "sorted")
    lake.sorted_playback(g.events, root)
    middle = g.spark.read.parquet(root).agg(F.min("event_time").alias("a"), F.max("event_time").alias("b")).first()
    since = (middle.a + (middle.b - middle.a) / 2).date()
    return lake.read_playback(g.spark, root, str(since), str(since + datetime.timedelta(days=9))).select("event_id", "user_id", "event_time")


@check("s14_stream_changes", """
    SELECT user_id, plan_id, status, updated_at, subscription_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, subscription_id DESC) AS rn FROM subs) WHERE rn = 1 AND op <> 'd'""")
def _(g):
    return streams.changed(g)


@check("s14_keyed_table", """
    SELECT user_id, plan_id, status, updated_at, subscription_id FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, subscription_id DESC) AS rn FROM subs) WHERE rn = 1 AND op <> 'd'""")
def _(g):
    return streams.keyed(g)


DLQ_WINDOWS = """SELECT w AS window_start, count(*) FILTER (WHERE bad) AS dead, count(*) AS total FROM (
      SELECT failure_reason IS NOT NULL AS bad, unnest(range(0, 5)) AS i, date_trunc('minute', ingestion_time) - to_minutes(i) AS w FROM (%s)) GROUP BY w""" % DEAD


DLQ_RATE = f"""
    SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, dead AS dlq_count, total AS ingress_count, dead / 300.0e0 AS dlq_per_second,
      dead / total AS dlq_share, dead / 300.0e0 > 5.0e0 AS rate_breach, dead / total > 0.001e0 AS share_breach FROM ({DLQ_WINDOWS})"""


def marked_deliveries(g):
    return staging.validate_events(g.raw, AS_OF).withColumn(
        "failure_reason", F.when(F.col("content_id") == "ghost_000092", F.lit("Payload is not a valid JSON dictionary")).otherwise(F.col("failure_reason")))


@check("t13_dlq_rate", DLQ_RATE)
def _(g):
    marked = marked_deliveries(g)
    dead = marked.where(F.col("failure_reason").isNotNull()).select(F.col("ingestion_time").alias("failed_at"))
    return monitors.dlq_rate(dead, marked.select(F.col("ingestion_time").alias("received_at")))


@check("t13_stream_dlq_rate", DLQ_RATE)
def _(g):
    return streams.dlq_windows(g, marked_deliveries(g).select("ingestion_time", "failure_reason"))


ALERTS = """
    SELECT 'EventRateHigh' AS alert, 'warning' AS severity, series, min(ts) AS firing_from, max(ts) AS firing_to, count(*) AS samples FROM (
      SELECT *, sum(CASE WHEN prev IS DISTINCT FROM true THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY ts) AS island FROM (
        SELECT *, lag(breach) OVER (PARTITION BY series ORDER BY ts) AS prev FROM (
          SELECT user_id % 6 AS series, date_trunc('hour', ts) AS ts, count(*) > 2 AS breach FROM events GROUP BY 1, date_trunc('hour', events.ts))) WHERE breach)
    GROUP BY series, island HAVING max(ts) - min(ts) >= INTERVAL 2 HOUR"""
EVENT_RATE = monitors.Rule("EventRateHigh", "event_rate", ">", 2.0, 7200, "warning")


def hourly_rates(g):
    ts = F.col("ts").cast("timestamp")
    series = (F.col("user_id") % 6).alias("series")
    hourly = g.read("events").groupBy(series, F.date_trunc("hour", ts).alias("ts")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return hourly.select(F.lit("event_rate").alias("metric"), "series", "ts", "value")


@check("t14_evaluate_alerts", ALERTS)
def _(g):
    return monitors.evaluate_alerts(hourly_rates(g), [EVENT_RATE]).select("alert", "severity", "series", "firing_from", "firing_to", "samples")


@check("t14_stream_alerts", ALERTS)
def _(g):
    return streams.alerts(g, hourly_rates(g), EVENT_RATE).select("alert", "severity", "series", "firing_from", "firing_to", "samples")


# the loss-free stream: the whole event table in five batches, late rows and redeliveries included

ARRIVED = """SELECT * FROM (SELECT *, ingestion_time AS arrived, row_number() OVER (PARTITION BY event_id ORDER BY ingestion_time) AS copy FROM raw
      WHERE event_id IN (SELECT event_id FROM stg)) WHERE copy = 1"""
ARRIVALS = f"""SELECT event_id, user_id, event_time, event_time < max(event_time) OVER (PARTITION BY source_partition ORDER BY epoch_us(arrived) * 2 + event_id % 2
      ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND AS is_late FROM ({ARRIVED})"""


@check("t01_complete_events", f"SELECT a.event_id, a.is_late, content_id, content_title FROM ({ARRIVALS}) a JOIN rich USING (event_id)")
def _(g):
    return complete.stored_events(g.spark, streams.complete_run(g)[0]).select("event_id", "is_late", "content_id", "content_title")


@check("t01_complete_counts", f"""
    SELECT *, received - dead_lettered - stored AS redelivered, received AS observed_received, dead_lettered AS observed_dead_lettered FROM (
      SELECT (SELECT count(*) FROM raw) AS received, (SELECT count(*) FROM (SELECT {REASON} AS r FROM raw) WHERE r IS NOT NULL) AS dead_lettered,
        (SELECT count(*) FROM stg) AS stored, (SELECT count(*) FROM ({ARRIVALS}) WHERE is_late) AS late)""")
def _(g):
    root, seen = streams.complete_run(g)
    counts = complete.stored_counts(g.spark, root)
    return counts.select("*", F.lit(seen.totals["received"]).cast("bigint").alias("observed_received"), F.lit(seen.totals["dead_lettered"]).cast("bigint").alias("observed_dead_lettered"))


@check("t03_complete_dedup", "SELECT event_id, user_id, event_time FROM stg")
def _(g):
    return complete.stored_events(g.spark, streams.complete_run(g)[0]).select("event_id", "user_id", "event_time")


@check("t04_stream_late_flags", """
    SELECT event_id, source_partition, is_late, sum(is_late::BIGINT) OVER (PARTITION BY source_partition ORDER BY event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS late_count FROM (
      SELECT event_id, user_id % 6 AS source_partition, event_time < max(event_time) OVER (PARTITION BY user_id % 6 ORDER BY event_id ROWS UNBOUNDED PRECEDING) - INTERVAL 30 SECOND AS is_late FROM stg)""")
def _(g):
    return streams.late_flags(g).select("event_id", "source_partition", "is_late", "late_count")


@check("t05_complete_sessions", PLAY_SESSIONS)
def _(g):
    return complete.stored_sessions(g.spark, streams.complete_run(g)[0], g.content)


@check("t06_complete_windows", TUMBLING)
def _(g):
    return complete.stored_windows(g.spark, streams.complete_run(g)[0])


@check("t10_stop_and_resume", "SELECT event_id, count(*) AS deliveries, true AS stopped_early, true AS all_counted FROM raw GROUP BY event_id")
def _(g):
    rows, sent, first, second = streams.stopped_and_resumed(g)
    came = [m.totals.get("received", 0) for m in (first, second)]
    early, counted = sent // 2 <= came[0] < sent, set(first.batches).isdisjoint(second.batches) and sum(came) == sent == rows.count()
    return rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("deliveries")).select("*", F.lit(early).alias("stopped_early"), F.lit(counted).alias("all_counted"))


# --- data quality -----------------------------------------------------------


@check("d01_freshness", "SELECT 'freshness' AS \"check\", max_event_time, lag_seconds, CASE WHEN lag_seconds <= 172800 THEN 'PASS' ELSE 'WARN' END AS status FROM fresh")
def _(g):
    return quality.freshness(g.raw, AS_OF)


@check("d02_null_and_duplicate_rates", """
    SELECT 'null_and_duplicate_rates' AS "check", *, CASE WHEN null_user_rate <= 0.01 AND null_content_rate <= 0.05 AND duplicate_rate <= 0.25 THEN 'PASS' ELSE 'FAIL' END AS status FROM rates""")
def _(g):
    return quality.null_and_duplicate_rates(g.raw)


@check("d03_validate_partition", """
    SELECT count(*) AS total_rows, count(*) FILTER (WHERE user_id IS NULL) AS null_users, count(*) FILTER (WHERE coalesce(content_id, '') = '') AS null_contents,
      count(DISTINCT event_id) AS unique_events, count(*) > 0 AND count(*) FILTER (WHERE user_id IS NULL) <= count(*) * 0.05 AS passed
    FROM raw WHERE CAST(event_time AS DATE) <= DATE '2024-01-20'""")
def _(g):
    return quality.validate_partition(g.raw, "2024-01-20")


@check("d04_check_marts", """
    SELECT "check", failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (
      SELECT 'completion_rate_bounded' AS "check", count(*) FILTER (WHERE content_completion_rate < 0 OR content_completion_rate > 100) AS failures FROM churn
      UNION ALL SELECT 'daily_metrics_not_negative', count(*) FILTER (WHERE total_watch_sessions < 0 OR total_watch_hours < 0) FROM daily)""")
def _(g):
    churn = marts.churn_features(g.sessions, staging.stg_search_events(g.searches), g.recs, AS_OF)
    return quality.check_marts(churn, marts.daily_platform_metrics(g.activity))


@check("d05_find_violations", "SELECT * FROM violations")
def _(g):
    return quality.find_violations(g.raw, g.content, AS_OF)


@check("d06_run_suite", """
    SELECT 'freshness' AS "check", CASE WHEN lag_seconds <= 172800 THEN 'PASS' ELSE 'WARN' END AS status, lag_seconds AS value, lag_seconds <= 172800 AS passed FROM fresh
    UNION ALL SELECT 'null_and_duplicate_rates', CASE WHEN null_user_rate <= 0.01 AND null_content_rate <= 0.05 AND duplicate_rate <= 0.25 THEN 'PASS' ELSE 'FAIL' END,
      duplicate_rate, null_user_rate <= 0.01 AND null_content_rate <= 0.05 AND duplicate_rate <= 0.25 FROM rates
    UNION ALL SELECT 'quarantine_routing', CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'QUARANTINED' END, CAST(count(*) AS DOUBLE), true FROM violations""")
def _(g):
    return quality.run_suite(g.raw, g.content, AS_OF)


@check("d06_violation_counts", "SELECT violation_code, count(*) AS n FROM violations GROUP BY violation_code")
def _(g):
    return quality.violation_counts(quality.find_violations(g.raw, g.content, AS_OF))


@check("d07_remediate", """
    SELECT r.event_id, ingestion_time, CASE WHEN f THEN least(event_time, ingestion_time) ELSE event_time END AS event_time,
      CASE WHEN b THEN least(greatest(playback_seconds, 0.0e0), 86400.0e0) ELSE playback_seconds END AS playback_seconds,
      CASE WHEN b THEN greatest(position_seconds, 0.0e0) ELSE position_seconds END AS position_seconds, coalesce(u, false) AS needs_catalog_sync,
      concat_ws(',', CASE WHEN f THEN 'FUTURE_TIMESTAMP' END, CASE WHEN u THEN 'UNKNOWN_CONTENT_ID' END, CASE WHEN b THEN 'IMPOSSIBLE_PLAYBACK_VALUE' END) AS remediation, false AS escalated
    FROM raw r LEFT JOIN (SELECT event_id, bool_or(violation_code = 'FUTURE_TIMESTAMP') AS f, bool_or(violation_code = 'UNKNOWN_CONTENT_ID') AS u,
      bool_or(violation_code = 'IMPOSSIBLE_PLAYBACK_VALUE') AS b FROM violations GROUP BY event_id) v ON v.event_id = r.event_id""")
def _(g):
    return quality.remediate(g.raw, quality.find_violations(g.raw, g.content, AS_OF)).select(
        "event_id", "ingestion_time", "event_time", "playback_seconds", "position_seconds", "needs_catalog_sync", "remediation", "escalated")


@check("d07_remediation_summary", "SELECT count(*) AS records, count(*) AS remediated, CAST(0 AS BIGINT) AS escalated FROM violations")
def _(g):
    return quality.remediation_summary(quality.find_violations(g.raw, g.content, AS_OF))


NOT_NULLS = " UNION ALL ".join(
    f"SELECT '{m}' AS model, '{c}' AS \"column\", 'not_null' AS test, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {t}"
    for m, t, cs in (("stg_playback_events", "stg", ("event_id", "event_type", "user_id", "content_id")), ("int_watch_sessions", "sessions", ("session_id", "user_id")),
                     ("mart_daily_platform_metrics", "daily", ("metric_date",)), ("mart_churn_features", "churn", ("user_id",))) for c in cs)
UNIQUES = " UNION ALL ".join(
    f"SELECT '{m}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {t} GROUP BY {c} HAVING count(*) > 1)"
    for m, t, c in (("stg_playback_events", "stg", "event_id"), ("mart_daily_platform_metrics", "daily", "metric_date"), ("mart_churn_features", "churn", "user_id")))


@check("d08_generic_tests", f"{NOT_NULLS} UNION ALL {UNIQUES} UNION ALL SELECT 'stg_playback_events', 'event_type', 'accepted_values', count(DISTINCT event_type) FROM stg WHERE event_type NOT IN {PLAY_TYPES}")
def _(g):
    churn = marts.churn_features(g.sessions, staging.stg_search_events(g.searches), g.recs, AS_OF)
    return quality.generic_tests(g.events, g.sessions, marts.daily_platform_metrics(g.activity), churn)


@check("d08_unique_failures", "SELECT event_id, count(*) AS n FROM raw GROUP BY event_id HAVING count(*) > 1")
def _(g):
    return quality.test_unique(g.raw, "event_id")


@check("d08_accepted_failures", f"SELECT event_type, count(*) AS n FROM raw WHERE event_type NOT IN {PLAY_TYPES} GROUP BY event_type")
def _(g):
    return quality.test_accepted(g.raw, "event_type", staging.PLAYBACK_TYPES)


@check("d09_completion_bounded", "SELECT session_id, completion_percentage FROM sessions WHERE completion_percentage < 0 OR completion_percentage > 100")
def _(g):
    return quality.assert_completion_bounded(g.sessions)


@check("d10_not_future", f"SELECT event_id, event_time FROM raw WHERE event_time > {NOW} + INTERVAL 2 HOUR")
def _(g):
    return quality.assert_not_future(g.raw, AS_OF)


@check("d12_subscription_states", "SELECT user_id, op AS current_status FROM subs WHERE op NOT IN ('active', 'past_due', 'canceled', 'expired')")
def _(g):
    return quality.assert_subscription_states(g.subs.select("user_id", F.col("op").alias("current_status")))


@check("d13_watch_positive", "SELECT session_id, total_watch_seconds FROM sessions WHERE total_watch_seconds < 0")
def _(g):
    return quality.assert_watch_positive(g.sessions)


# --- governance -------------------------------------------------------------


@check("g01_g03_masks", """
    SELECT user_id, email_masked AS email, phone_masked AS phone, split_part(ip, '.', 1) || '.' || split_part(ip, '.', 2) || '.x.x' AS ip FROM masked_users""")
def _(g):
    return g.users.select("user_id", masking.mask_email(F.col("email")).alias("email"), masking.mask_phone(F.col("phone")).alias("phone"),
                          masking.mask_ip(F.col("ip")).alias("ip"))


@check("g04_pseudonymize", "SELECT user_id, sha256('salt' || CAST(user_id AS VARCHAR)) AS salted, CAST(user_id AS VARCHAR) AS raw_id FROM users")
def _(g):
    uid = F.col("user_id")
    return g.users.select("user_id", masking.pseudonymize(uid, "sha256", "salt").alias("salted"), masking.pseudonymize(uid, "raw").alias("raw_id"))


def hmac_sql(column: str, key: bytes) -> str:
    """Keyed SHA-256 as nested hashes over blobs."""
    inner, outer = (bytes(b ^ pad for b in key.ljust(64, b"\0")).hex() for pad in (0x36, 0x5C))
    return f"sha256(unhex('{outer}') || unhex(sha256(unhex('{inner}') || encode(CAST({column} AS VARCHAR)))))"


@check("g04_hmac", f"SELECT user_id, {hmac_sql('user_id', b'secret')} AS keyed FROM users")
def _(g):
    return g.users.select("user_id", masking.pseudonymize(F.col("user_id"), "hmac", "secret").alias("keyed"))


@check("g05_apply_catalog", f"SELECT {hmac_sql('user_id', b'secret')} AS user_id, email_masked AS email, phone_masked AS phone, country_code FROM masked_users")
def _(g):
    return governance.apply_catalog(g.users, "users", "secret").select("user_id", "email", "phone", "country_code")


# the patterns as RE2 understands them
NAME, DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+"


def masked_sql(column: str) -> str:
    out = f"regexp_replace({column}, '({NAME}){NAME}+({NAME})@({DOMAIN})', '\\1***\\2@\\3', 'g')"
    out = f"regexp_replace({out}, '(^|[^A-Za-z0-9._%+*-])({NAME}){NAME}?@({DOMAIN})', '\\1\\2***@\\3', 'g')"
    out = f"regexp_replace({out}, '{masking._IP_PARTS}', '\\1.\\2.x.x', 'g')"
    return f"regexp_replace({out}, '{masking._PHONE_PARTS}', '+91-XXXXX-\\1', 'g')"


@check("g06_mask_text", f"SELECT doc_id, {masked_sql('text')} AS text FROM documents")
def _(g):
    return governance.mask_text(g.read("documents"), "text").select("doc_id", "text")


FINDS = " UNION ALL ".join(
    f"SELECT source, count(*) AS rows, '{k}' AS kind, CAST(sum(len(regexp_extract_all(text, '{p}'))) AS BIGINT) AS finds FROM documents GROUP BY source"
    for k, p in (("email", f"{NAME}+@{DOMAIN}"), ("ip", masking.IP_PATTERN), ("phone", masking.PHONE_PATTERN)))


@check("g06_pii_report", FINDS)
def _(g):
    return governance.pii_report(g.read("documents"), "text", "source")


REQUESTED = "SELECT user_id FROM subs WHERE status = 'canceled' GROUP BY user_id HAVING count(*) >= 6"


def requested(g):
    gone = g.subs.where(F.col("status") == "canceled").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("updated_at").alias("requested_at"))
    return gone.where("n >= 6").select("user_id", "requested_at")


def erased(g):
    return governance.erase_users({"users": g.users, "subscriptions": g.subs, "raw_playback_events": g.raw, "fact_watch_sessions": g.sessions}, requested(g))


SQL_ERASED, SQL_KEPT = (" UNION ALL ".join(line.format(name=name, t=t) for name, t in (
    ("users", "users"), ("subscriptions", "subs"), ("raw_playback_events", "raw"), ("fact_watch_sessions", "sessions"))) for line in (
    f"SELECT '{{name}}' AS table_name, user_id, count(*) AS rows_erased FROM {{t}} WHERE user_id IN ({REQUESTED}) GROUP BY user_id",
    f"SELECT '{{name}}' AS name, count(*) AS n FROM {{t}} WHERE user_id NOT IN ({REQUESTED})"))


@check("g07_erase_audit", SQL_ERASED)
def _(g):
    return erased(g)[1]


@check("g07_erase_kept", SQL_KEPT)
def _(g):
    return marts.platform_stats(erased(g)[0])


def erased_files(g):
    """(paths of stored tables after the erasure, audit); the tables are written in several files first."""
    root = scratch_path(g.spark, "stored")
    tables = {"users": g.users, "subscriptions": g.subs, "raw_playback_events": g.raw, "fact_watch_sessions": g.sessions}
    files = max(6, g.spark.sparkContext.defaultParallelism)  # a task each, so no core waits
    for name, df in tables.items():
        df.repartitionByRange(files, "user_id").write.parquet(f"{root}/{name}")
    paths = {name: f"{root}/{name}" for name in tables}
    return paths, erasure.erase_stored(g.spark, paths, requested(g))


@check("g07_erase_stored_audit", SQL_ERASED)
def _(g):
    return erased_files(g)[1]


@check("g07_erase_stored_kept", SQL_KEPT)
def _(g):
    paths, _ = erased_files(g)
    return marts.platform_stats({name: g.spark.read.parquet(path) for name, path in paths.items()})


@check("g08_tombstones", f"SELECT CAST(user_id AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS value, 'ott.user.events.v1' AS topic FROM ({REQUESTED})")
def _(g):
    return governance.tombstones(requested(g), "ott.user.events.v1")


@check("g09_enforce_retention", f"SELECT subscription_id, updated_at FROM subs WHERE updated_at > TIMESTAMP '2001-06-01' - INTERVAL 730 DAY")
def _(g):
    return governance.enforce_retention(g.subs, "CONFIDENTIAL_PII", "updated_at", "2001-06-01").select("subscription_id", "updated_at")


@check("g10_erasure_sla", f"""
    SELECT r.user_id, requested_at, CAST(floor((epoch(TIMESTAMP '2000-01-01') - epoch(requested_at)) / 3600.0e0) AS BIGINT) AS hours_open
    FROM (SELECT user_id, min(updated_at) AS requested_at FROM subs WHERE status = 'canceled' GROUP BY user_id HAVING count(*) >= 6) r
    WHERE requested_at < TIMESTAMP '2000-01-01' - INTERVAL 48 HOUR AND user_id NOT IN (SELECT user_id FROM subs WHERE status = 'past_due' AND plan_id = 'plan_3')""")
def _(g):
    audit = g.subs.where((F.col("status") == "past_due") & (F.col("plan_id") == "plan_3")).select("user_id", F.col("updated_at").alias("erased_at"))
    return governance.erasure_sla(requested(g), audit, "2000-01-01")


# --- recommenders -----------------------------------------------------------


def purchase_rules(g, purchases=None):
    """The rules as a stored table, as the lookups below read them."""
    return cut_lineage(rules.association_rules(rules.baskets(g.purchases if purchases is None else purchases)))


@check("r01_baskets", "SELECT user_id, content_id FROM baskets")
def _(g):
    return rules.baskets(g.purchases)


@check("r02_association_rules", "SELECT * FROM rules")
def _(g):
    return rules.association_rules(rules.baskets(g.purchases))


@check("r03_co_watched", "SELECT * FROM co_watch WHERE rank <= 6")
def _(g):
    return rules.co_watched(purchase_rules(g), all_items(g))


@check("r04_implicit_scores", f"SELECT user_id, content_id, {rnd('score', 8)} AS score FROM implicit")
def _(g):
    return factors.implicit_scores(g.events).withColumn("score", scalars.round_half_up(F.col("score"), 8))


def watch_scores(g):
    return factors.implicit_scores(g.events)


@check("r05_svd_recommend")
def _(g):
    return factors.svd_recommend(watch_scores(g))


@check("r06_als_recommend")
def _(g):
    return factors.als_recommend(watch_scores(g), maxIter=5)


# what holds whatever the factors are: as many titles as are left, none seen, ranks without gaps, falling scores
COMPLETE_LISTS = """
    SELECT user_id, n, n AS n_titles, n AS last_rank, 0 AS n_seen, true AS falling FROM (
      SELECT user_id, least(10, (SELECT count(DISTINCT content_id) FROM implicit) - count(DISTINCT content_id)) AS n FROM implicit GROUP BY user_id) WHERE n > 0"""


def list_facts(g, recommend, **options):
    scores = cut_lineage(watch_scores(g))
    got = recommend(scores, **options).join(scores.select("user_id", "content_id", F.lit(1).alias("seen")), ["user_id", "content_id"], "left")
    before = Window.partitionBy("user_id").orderBy("rank")
    got = got.withColumn("ok", F.col("cf_score") <= F.coalesce(F.lag("cf_score").over(before), F.col("cf_score")))
    return got.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("content_id").alias("n_titles"), F.max("rank").cast("bigint").alias("last_rank"),
                                      F.count("seen").cast("int").alias("n_seen"), F.every("ok").alias("falling"))


@check("r05_svd_lists", COMPLETE_LISTS)
def _(g):
    return list_facts(g, factors.svd_recommend)


@check("r06_als_lists", COMPLETE_LISTS)
def _(g):
    return list_facts(g, factors.als_recommend, maxIter=5)


SCORES = """SELECT user_id, content_id, score AS cf_score, rank FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank FROM implicit) WHERE rank <= 10"""


def stored(g):
    ranked = staging.top_k(factors.implicit_scores(g.events), ["user_id"], [scalars.round_half_up(F.col("score"), 8).desc(), F.col("content_id")], 10)
    return ranked.select("user_id", "content_id", scalars.round_half_up(F.col("score"), 8).alias("cf_score"), "rank")


STORED = SCORES.replace("score AS cf_score", rnd("score", 8) + " AS cf_score").replace("ORDER BY score DESC", f"ORDER BY {rnd('score', 8)} DESC")


@check("r07_user_top", f"SELECT * FROM ({STORED}) WHERE rank <= 5")
def _(g):
    return hybrid.user_top(stored(g), 5)


def all_items(g):
    return g.items.select("content_id").unionByName(g.chunks.select("content_id")).distinct()


def vector_hits(g, k=10):
    return vector.knn(g.vector_queries, g.chunks, k)


def item_sims(g, k=10):
    """Hits of each item's first chunk as the item's query."""
    first = g.chunks.groupBy("content_id").agg(F.min("chunk_id").alias("query_id"))
    queries = first.join(g.chunks.select(F.col("chunk_id").alias("query_id"), "vec"), "query_id")
    hits = vector.knn(queries, g.chunks, k)
    names = g.chunks.select("chunk_id", "content_id")
    return hits.join(first.withColumnRenamed("content_id", "item_id"), "query_id").join(names, "chunk_id").select(
        "item_id", "content_id", "similarity_score")


def next_items(g, purchases=None):
    return hybrid.item_hybrid(all_items(g), purchase_rules(g, purchases), item_sims(g), g.items, k=5)


@check("r08_item_hybrid", """
    SELECT h.item_id, h.content_id, i.title, i.release_year, lift, confidence, semantic_score, score, strategy, rank
    FROM item_hybrid h LEFT JOIN items i ON i.content_id = h.content_id""")
def _(g):
    return next_items(g)


RECENT = """SELECT user_id, content_id AS item_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY content_id) AS rn FROM basket_rows) WHERE rn = 1"""
CF = """SELECT user_id, content_id, floor(cnt / 10.0e0 * 10000.0e0 + 0.5e0) / 10000.0e0 AS score, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY cnt DESC, content_id) AS rank FROM (
      SELECT o_custkey AS user_id, p_brand || '/' || p_type AS content_id, count(*) AS cnt FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey GROUP BY 1, 2)) WHERE rank <= 5"""
NEAR = f"""SELECT a.user_id, h.content_id, h.score, h.rank FROM (SELECT u.user_id, coalesce(item_id, 'Brand#1/PROMO') AS item_id FROM users u LEFT JOIN ({RECENT}) l ON l.user_id = u.user_id) a
    JOIN item_hybrid h ON h.item_id = a.item_id WHERE h.rank <= 5"""


@check("r09_personal_shelves", f"""
    SELECT shelf, s.user_id, s.content_id, score, strategy, rank, coalesce(title, '') AS title, coalesce(release_year, 2024) AS release_year,
      coalesce(duration_seconds, 5400) AS duration_seconds, coalesce(maturity_rating, 'PG-13') AS maturity_rating FROM (
      SELECT 'because_you_watched' AS shelf, user_id, content_id, score, 'CO_WATCH_ASSOCIATION' AS strategy, rank FROM ({NEAR})
      UNION ALL SELECT 'collaborative_picks', user_id, content_id, score, 'COLLABORATIVE_SVD', rank FROM ({CF}) WHERE user_id IN (SELECT user_id FROM users)
      UNION ALL SELECT 'hybrid_discoveries', user_id, content_id, score, strategy, rank FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, content_id) AS rank FROM (
          SELECT coalesce(c.user_id, n.user_id) AS user_id, coalesce(c.content_id, n.content_id) AS content_id,
            {rnd(f"coalesce({rnd('c.score * 0.5e0', 4)}, 0.0e0) + coalesce({rnd('n.score * 0.5e0', 4)}, 0.0e0)", 4)} AS score,
            CASE WHEN n.user_id IS NULL THEN 'COLLABORATIVE_SVD' WHEN c.user_id IS NULL THEN 'CO_WATCH_ASSOCIATION' ELSE 'HYBRID_ENSEMBLE' END AS strategy
          FROM (SELECT * FROM ({CF}) WHERE user_id IN (SELECT user_id FROM users)) c FULL JOIN ({NEAR}) n ON c.user_id = n.user_id AND c.content_id = n.content_id)) WHERE rank <= 5) s
    LEFT JOIN items i ON i.content_id = s.content_id""")
def _(g):
    # orders, lines and parts meet once; shelves and rules read the counts
    counted = cut_lineage(g.purchases.repartition("user_id").groupBy("user_id", "content_id").agg(F.count(F.lit(1)).alias("cnt")))
    cf = staging.top_k(counted, ["user_id"], [F.col("cnt").desc(), F.col("content_id")], 5).select(
        "user_id", "content_id", scalars.round_half_up(F.col("cnt") / 10.0, 4).alias("cf_score"), "rank")
    recent = staging.top_k(counted.select("user_id", "content_id"), ["user_id"], [F.col("content_id")], 1)
    return hybrid.personal_shelves(g.users, recent, cf, next_items(g, counted), g.items, k=5, fallback_item="Brand#1/PROMO")


THEME_HITS = """SELECT CASE WHEN label = 0 THEN 'Award winning compelling thriller and drama with high completion rate' ELSE 'Top trending movies and series across all genres' END AS theme,
      h.content_id, 'genre_' || label AS genre, similarity_score, rank FROM hits h JOIN (SELECT label, min(chunk_id) AS query_id FROM chunks WHERE label <= 1 GROUP BY label) q ON q.query_id = h.query_id"""


@check("r10_themed", f"""
    SELECT u.user_id, t.theme, coalesce(genre_watch_minutes_30d, 0.0e0) AS watch_minutes_30d, coalesce(content_completion_rate, 0.0e0) AS completion_rate, content_id, similarity_score, rank,
      genre AS reason_genre, CAST(floor(similarity_score * 100.0e0 + 0.5e0) AS BIGINT) AS reason_match
    FROM users u LEFT JOIN churn c ON c.user_id = u.user_id JOIN ({THEME_HITS}) t
      ON t.theme = CASE WHEN c.user_id IS NOT NULL THEN 'Award winning compelling thriller and drama with high completion rate' ELSE 'Top trending movies and series across all genres' END""")
def _(g):
    churn = marts.churn_features(g.sessions, staging.stg_search_events(g.searches), g.recs, AS_OF)
    theme = F.when(F.col("label") == 0, hybrid.KNOWN_THEME).otherwise(hybrid.NEW_THEME)
    first = g.chunks.where(F.col("label") <= 1).groupBy("label").agg(F.min_by(F.struct("chunk_id", "vec"), "chunk_id").alias("q")).select(
        "label", F.col("q.chunk_id").alias("query_id"), "q.vec")
    hits = vector.knn(first, g.chunks, 10).join(first.select("query_id", "label"), "query_id").join(g.chunks.select("chunk_id", "content_id"), "chunk_id")
    themed = hits.select(theme.alias("theme"), "content_id", F.concat(F.lit("genre_"), F.col("label").cast("string")).alias("genre"), "similarity_score", "rank")
    out = hybrid.themed_recommendations(g.users, churn, themed, k=10)
    return out.select("user_id", "theme", "watch_minutes_30d", "completion_rate", "content_id", "similarity_score", "rank",
                      F.regexp_extract("explain_reason", "in (\\S+) with", 1).alias("reason_genre"),
                      F.regexp_extract("explain_reason", "with (-?\\d+)%", 1).cast("bigint").alias("reason_match"))


# --- text and vectors -------------------------------------------------------

CHUNK_TEXT = """SELECT content_id, 'synopsis' AS chunk_type, 0 AS chunk_index, 'Title: ' || title || ' (' || release_year || '). Genres: ' || array_to_string(genres, ', ') || '. Language: ' || language
      || '. Rating: ' || maturity_rating || '. Synopsis: A story of ' || title AS chunk_text FROM content WHERE NOT is_series
    UNION ALL SELECT content_id, 'cast_and_themes', 1, title || ': Directed by ' || director || '. Starring ' || director || ', Ensemble. Key Themes & Tropes: ' || genres[1] || ', drama.' FROM content WHERE NOT is_series
    UNION ALL SELECT content_id, 'series_overview', 0, 'Series: ' || title || '. Seasons: ' || total_seasons || '. Genres: ' || array_to_string(genres, ', ') || '. Created by: . Starring: ' || director
      || ', Ensemble. Synopsis: A story of ' || title || '. Tropes: .' FROM content WHERE is_series"""
CHUNK_ID = "sha256(content_id || '|' || chunk_type || '|' || CAST(chunk_index AS VARCHAR))"


@check("c01_catalog_chunks", f"SELECT {CHUNK_ID} AS chunk_id, * FROM ({CHUNK_TEXT})")
def _(g):
    return text.catalog_chunks(g.movies, g.series).select("chunk_id", "content_id", "chunk_type", "chunk_index", "chunk_text")


@check("c02_embed")
def _(g):
    rows = text.embed(g.read("documents").select("doc_id", "text"), "text")
    return rows.select("doc_id", F.size("embedding").alias("dim"), scalars.round_half_up(vectors.norm(F.col("embedding")), 3).alias("length"))


@check("c03_embedding_delta", f"SELECT {CHUNK_ID} AS chunk_id, sha256(chunk_text) AS content_hash, chunk_text FROM ({CHUNK_TEXT}) WHERE content_id IN (SELECT content_id FROM content WHERE language = 'hi' OR release_year > 2020)")
def _(g):
    chunks = text.catalog_chunks(g.movies, g.series)
    # the index knows a title by its id; one that is new or changed in any of its rows is so in all of them
    touched = g.content.where("language = 'hi' OR release_year > 2020").select("content_id", F.lit(True).alias("touched")).distinct()
    old = chunks.where("language = 'en' AND content_id IS NOT NULL").join(touched, "content_id", "left")
    existing = old.select("chunk_id", F.sha2(F.when(F.col("touched"), F.lit("older text")).otherwise(F.col("chunk_text")), 256).alias("content_hash"))
    return text.embedding_delta(chunks, existing).select("chunk_id", "content_hash", "chunk_text")


@check("v01_cosine", f"""
    SELECT c.chunk_id, {rnd('list_cosine_similarity(c.vec, f.vec)', 8)} AS similarity, {rnd('1.0e0 - list_cosine_similarity(c.vec, f.vec)', 8)} AS distance
    FROM chunks c JOIN (SELECT label, arg_min(vec, chunk_id) AS vec FROM chunks GROUP BY label) f ON f.label = c.label""")
def _(g):
    first = g.chunks.groupBy("label").agg(F.min_by("vec", "chunk_id").alias("first"))
    rows = g.chunks.join(first, "label")
    return rows.select("chunk_id", scalars.round_half_up(vectors.cosine(F.col("vec"), F.col("first")), 8).alias("similarity"),
                       scalars.round_half_up(vectors.cosine_distance(F.col("vec"), F.col("first")), 8).alias("distance"))


@check("v02_knn", "SELECT query_id, chunk_id, similarity_score, rank FROM hits")
def _(g):
    return vector_hits(g)


@check("v02_knn_genre", f"""
    SELECT query_id, chunk_id, {rnd('s', 4)} AS similarity_score, rank FROM (SELECT n.*, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, n.chunk_id) AS rank
      FROM neighbours n JOIN chunks c ON c.chunk_id = n.chunk_id WHERE label = 3) WHERE rank <= 5""")
def _(g):
    return vector.knn(g.vector_queries, g.chunks, 5, genre="genre_3")


@check("v03_ivf_search")
def _(g):
    index, centres = vector.ivf_build(g.chunks.select("chunk_id", "vec"), lists=16)
    return vector.ivf_search(g.vector_queries, index, centres, 10, nprobe=4)


@check("v03_ivf_all_lists", "SELECT query_id, chunk_id, similarity_score, rank FROM hits")
def _(g):
    index, centres = vector.ivf_build(g.chunks.select("chunk_id", "vec"), lists=16)
    return vector.ivf_search(g.vector_queries, index, centres, 10, nprobe=16)


@check("v02_pivot_knn", "SELECT query_id, chunk_id, similarity_score, rank FROM hits")
def _(g):
    index, centres = vector.ivf_build(g.chunks.select("chunk_id", "vec"), lists=16)
    return pruned.pivot_knn(g.vector_queries, index, centres, 10)[0]


@check("v03_hash_recall", "SELECT count(*) AS exact_hits, true AS found_nine_in_ten FROM hits")
def _(g):
    seen = pruned.recall(pruned.hash_knn(g.vector_queries, g.chunks, 10, tables=16), vector_hits(g))
    return seen.select("exact_hits", (F.col("found") >= 0.9 * F.col("exact_hits")).alias("found_nine_in_ten"))


@check("c03_catalog_diff", f"""
    SELECT chunk_id, CASE WHEN language = 'en' THEN content_hash END AS content_hash,
      CASE WHEN language <> 'en' THEN 'removed' WHEN release_year > 2020 THEN 'changed' ELSE 'new' END AS change
    FROM (SELECT {CHUNK_ID} AS chunk_id, sha256(chunk_text) AS content_hash, content_id FROM ({CHUNK_TEXT})) n JOIN content USING (content_id)
    WHERE language <> 'en' OR release_year > 2020 OR release_year < 2008""")
def _(g):
    chunks = text.catalog_chunks(g.movies, g.series)
    years = chunks.join(g.content.select("content_id", F.col("release_year").alias("year")), "content_id")
    was = F.when((F.col("language") == "en") & (F.col("year") > 2020), F.lit("older text")).otherwise(F.col("chunk_text"))
    existing = years.where((F.col("language") != "en") | (F.col("year") >= 2008)).select("chunk_id", F.sha2(was, 256).alias("content_hash"))
    return text.catalog_diff(chunks.where("language = 'en'"), existing).select("chunk_id", "content_hash", "change")


@check("c03_index_upkeep", "SELECT query_id, chunk_id, similarity_score, rank FROM hits")
def _(g):
    """An index of older vectors brought up to the chunks, all lists probed."""
    rows = g.chunks.select("chunk_id", "vec")
    older = rows.where("chunk_id % 3 > 0").withColumn("vec", F.when(F.col("chunk_id") % 5 == 1, F.reverse("vec")).otherwise(F.col("vec")))
    leaving = older.select((-F.col("chunk_id") - 1).alias("chunk_id"), "vec")
    index, centres = vector.ivf_build(older.unionByName(leaving), lists=8)
    made = vector.list_spread(index, centres)
    fresh = rows.where("chunk_id % 3 = 0 OR chunk_id % 5 = 1")
    index, centres = vector.ivf_update(index, centres, fresh, leaving, made, drift=1.05)
    return vector.ivf_search(g.vector_queries, index, centres, 10, nprobe=1000)


@check("v04_answers", f"""
    SELECT query_id, 'What about ' || query_id AS query_text, 'Based on your interest in ''What about ' || query_id || ''', here are top recommendations from our platform:' || chr(10) || chr(10) || '1. **' || list_extract(t, 1)
      || '** is your closest match (relevance: ' || CAST(floor(s1 * 1000.0e0 + 0.5e0)::BIGINT // 10 AS VARCHAR) || '.' || CAST(floor(s1 * 1000.0e0 + 0.5e0)::BIGINT % 10 AS VARCHAR) || '%). It features: ' || x1
      || chr(10) || chr(10) || 'Other strong contenders in our catalog include **' || list_extract(t, 2) || '**, **' || list_extract(t, 3) || '**.' AS answer, CAST(3 AS INTEGER) AS retrieval_count
    FROM (SELECT query_id, list(title ORDER BY rank) AS t, max(CASE WHEN rank = 1 THEN similarity_score END) AS s1, max(CASE WHEN rank = 1 THEN txt END) AS x1 FROM (
      SELECT h.query_id, rank, similarity_score, coalesce(c.title, 'cnt_' || lpad(CAST(h.chunk_id AS VARCHAR), 6, '0')) AS title, coalesce(d.text, '') AS txt FROM hits h
      LEFT JOIN content c ON c.content_id = 'cnt_' || lpad(CAST(h.chunk_id AS VARCHAR), 6, '0') LEFT JOIN documents d ON d.doc_id = h.chunk_id WHERE rank <= 3) GROUP BY query_id)""")
def _(g):
    cid = F.concat(F.lit("cnt_"), F.lpad(F.col("chunk_id").cast("string"), 6, "0")).alias("content_id")
    docs = g.read("documents").select(F.col("doc_id").alias("chunk_id"), F.col("text").alias("t"))
    hits = vector_hits(g, 3).select("*", cid).join(g.content.select("content_id", "title"), "content_id", "left").join(docs, "chunk_id", "left")
    queries = g.vector_queries.select("query_id", F.concat(F.lit("What about "), F.col("query_id").cast("string")).alias("query_text"))
    return text.answers(queries, hits.withColumn("chunk_text", F.coalesce("t", F.lit("")))).select("query_id", "query_text", "answer", "retrieval_count")


RETENTION_PAIRS = """(SELECT DISTINCT w, min(w) OVER (PARTITION BY user_id) AS c FROM (SELECT DISTINCT user_id, date_trunc('week', activity_date) AS w FROM activity))"""
COUNTED = {
    "stg_playback_events": "stg", "stg_search_events": "searches", "stg_content": "content", "stg_users": "(SELECT DISTINCT user_id, device_type, app_version FROM stg)",
    "int_watch_sessions": "sessions", "int_daily_user_activity": "activity", "int_content_engagement": "engagement",
    "int_subscription_history": "(SELECT DISTINCT user_id FROM sessions)", "mart_daily_platform_metrics": "daily", "mart_content_performance": "engagement",
    "mart_user_retention": RETENTION_PAIRS, "mart_recommendation_performance": "(SELECT DISTINCT CAST(event_time AS DATE), model_version FROM recs)",
    "mart_churn_features": "churn", "ml_user_features": "churn",
}


@check("b01_run_daily", " UNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n FROM {t}" for name, t in COUNTED.items()))
def _(g):
    given = {"raw_playback_events": g.raw, "raw_search_events": g.searches, "raw_recommendation_events": g.recs, "dim_content": g.content}
    return daily.run_daily(g.spark, given, "2024-01-31", AS_OF)


# the daily batch by changed days: a first load, then copies, late and negative events that reach other days

@functools.lru_cache(maxsize=4)
def refreshed(known: tuple, spark, sf_dir: str) -> str:
    g = Given(spark, sf_dir)
    events, root = scratch_path(spark, "bronze"), scratch_path(spark, "marts")
    late = (F.col("schema_version") != "1.0.0") | (F.dayofmonth("ingestion_time") % 9 == 4) & (F.col("event_id") % 2 == 0)
    incremental.write_events(g.raw.where(~late), events)
    incremental.refresh(spark, events, root, g.content, AS_OF, span_days=11)
    incremental.write_events(g.raw.where(late), events)
    incremental.refresh(spark, events, root, g.content, AS_OF, span_days=11)
    return root


def daily_table(g, name):
    # faults move an event by ten days, so a session of a day spans eleven
    root = refreshed((g.spark.sparkContext.applicationId, g.dir), g.spark, g.dir)
    return incremental.stored(g.spark, root, name)


@check("b01_incremental_metrics", "SELECT * FROM daily")
def _(g):
    return daily_table(g, "mart_daily_platform_metrics")


@check("b01_incremental_performance", PERFORMANCE.format(u=units("total_watch_hours"), o="engagement_date RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW"))
def _(g):
    return daily_table(g, "mart_content_performance")


@check("b01_incremental_rollup", PLATFORM.replace("FROM raw", "FROM stg"))
def _(g):
    return daily_table(g, "rollup_platform_daily").select("metric_date", "total_events", "total_plays", "unique_active_users", "total_watch_hours", "avg_session_minutes")
