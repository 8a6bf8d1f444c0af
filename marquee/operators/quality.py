"""Data-quality checks, quarantine and remediation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.scalars import as_time, is_missing, round_half_up, shift
from marquee.operators.staging import PLAYBACK_TYPES, union_all
from marquee.sources.contracts import SUBSCRIPTION_STATES

# Limits of the checks.
MAX_LAG_SECONDS = 48 * 3600
NO_DATA_LAG = 999999.0
MAX_NULL_USERS = 0.01
MAX_NULL_CONTENT = 0.05
MAX_DUPLICATES = 0.25
MAX_NULL_USERS_PARTITION = 0.05
FUTURE_MINUTES = 10
MAX_PLAYBACK = 86400.0

# Violation codes.
FUTURE = "FUTURE_TIMESTAMP"
UNKNOWN = "UNKNOWN_CONTENT_ID"
IMPOSSIBLE = "IMPOSSIBLE_PLAYBACK_VALUE"


def stamp(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def freshness(df: DataFrame, as_of, ts: str = "event_time") -> DataFrame:
    """Lag of the newest event; PASS up to 48 hours."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    latest = df.agg(F.max(ts).alias("max_event_time"))
    lag = F.coalesce((micros(as_time(as_of)) - micros(F.col("max_event_time"))) / F.lit(1e6), F.lit(NO_DATA_LAG))
    return latest.select(
        F.lit("freshness").alias("check"), "max_event_time", lag.alias("lag_seconds"),
        F.when(lag <= MAX_LAG_SECONDS, "PASS").otherwise("WARN").alias("status"),
    )


def null_and_duplicate_rates(df: DataFrame) -> DataFrame:
    """Share of missing users and titles and of repeated event ids.

    Rows are first counted per event id, which combines copies map-side; the
    number of distinct ids is then the number of groups.
    """
    per_id = df.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(is_missing(F.col("user_id"))).alias("u"),
        F.count_if(is_missing(F.col("content_id"))).alias("c"),
    )
    ids = F.count("event_id")
    totals = per_id.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("u"), F.lit(0)).alias("u"),
        F.coalesce(F.sum("c"), F.lit(0)).alias("c"), ids.alias("ids"),
    )
    total = F.greatest(F.col("n"), F.lit(1))
    users, titles, copies = F.col("u") / total, F.col("c") / total, (F.col("n") - F.col("ids")) / total
    passed = (users <= MAX_NULL_USERS) & (titles <= MAX_NULL_CONTENT) & (copies <= MAX_DUPLICATES)
    return totals.select(
        F.lit("null_and_duplicate_rates").alias("check"), total.alias("total_records"),
        round_half_up(users, 4).alias("null_user_rate"), round_half_up(titles, 4).alias("null_content_rate"),
        round_half_up(copies, 4).alias("duplicate_rate"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
    )


def validate_partition(df: DataFrame, ds: str) -> DataFrame:
    """Gate on the data up to a day: some rows, at most 5 % without user."""
    counts = df.where(F.to_date("event_time") <= F.lit(ds).cast("date")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(is_missing(F.col("user_id"))).alias("null_users"),
        F.count_if(is_missing(F.col("content_id"))).alias("null_contents"),
        F.countDistinct("event_id").alias("unique_events"),
    )
    ok = (F.col("total_rows") > 0) & (F.col("null_users") <= F.col("total_rows") * MAX_NULL_USERS_PARTITION)
    return counts.withColumn("passed", ok)


def check_marts(churn: DataFrame, daily: DataFrame) -> DataFrame:
    """Rows with completion outside 0..100, and with negative daily numbers."""
    rate = F.col("content_completion_rate")
    bounds = churn.agg(F.count_if((rate < 0) | (rate > 100)).alias("failures"))
    negative = (F.col("total_watch_sessions") < 0) | (F.col("total_watch_hours") < 0)
    signs = daily.agg(F.count_if(negative).alias("failures"))
    both = union_all([
        bounds.select(F.lit("completion_rate_bounded").alias("check"), "failures"),
        signs.select(F.lit("daily_metrics_not_negative").alias("check"), "failures"),
    ])
    return both.withColumn("status", F.when(F.col("failures") == 0, "PASS").otherwise("FAIL"))


def find_violations(events: DataFrame, content: DataFrame, as_of, source: str = "raw_playback_events") -> DataFrame:
    """One quarantine row per broken rule of every event, in one pass over the events.

    The id is a hash of event, delivery and code, so a rerun yields the same rows.
    """
    known = content.select("content_id").distinct().withColumn("_known", F.lit(True))
    rows = events.join(known, "content_id", "left")
    cid, play, pos = F.col("content_id"), F.col("playback_seconds"), F.col("position_seconds")
    user = F.col("user_id").cast("string").alias("user_id")
    when = stamp(F.col("event_time"))
    # Codes, details and payload of each rule.
    future = F.struct(
        F.lit(FUTURE).alias("code"),
        F.concat(F.lit("event_time "), when, F.lit(" is ahead of current clock")).alias("details"),
        F.to_json(F.struct(user, "content_id", when.alias("event_time"))).alias("payload"),
    )
    unknown = F.struct(
        F.lit(UNKNOWN).alias("code"),
        F.concat(F.lit("content_id "), cid, F.lit(" not present in dim_content")).alias("details"),
        F.to_json(F.struct(user, "content_id")).alias("payload"),
    )
    impossible = F.struct(
        F.lit(IMPOSSIBLE).alias("code"),
        F.concat(F.lit("playback_seconds="), play.cast("string"), F.lit(", position_seconds="), pos.cast("string")).alias("details"),
        F.to_json(F.struct("playback_seconds", "position_seconds")).alias("payload"),
    )
    found = F.array_compact(F.array(
        F.when(F.col("event_time") > shift(as_time(as_of), mins=FUTURE_MINUTES), future),
        F.when(F.col("_known").isNull() & (cid != ""), unknown),
        F.when((play > MAX_PLAYBACK) | (pos < 0), impossible),
    ))
    exploded = rows.select("event_id", "ingestion_time", F.explode(found).alias("v"))
    key = F.concat_ws("|", F.col("event_id").cast("string"), stamp(F.col("ingestion_time")), F.col("v.code"))
    return exploded.select(
        F.sha2(key, 256).alias("quarantine_id"), as_time(as_of).alias("quarantine_time"),
        F.lit(source).alias("source_table"), "event_id", F.col("v.code").alias("violation_code"),
        F.col("v.details").alias("violation_details"), F.col("v.payload").alias("raw_payload"),
    )


def run_suite(events: DataFrame, content: DataFrame, as_of) -> DataFrame:
    """Status of every check; a quarantine still counts as a pass."""
    fresh = freshness(events, as_of).select("check", "status", F.col("lag_seconds").alias("value"))
    rates = null_and_duplicate_rates(events).select("check", "status", F.col("duplicate_rate").alias("value"))
    held = find_violations(events, content, as_of).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("quarantine_routing").alias("check"),
        F.when(F.col("n") == 0, "PASS").otherwise("QUARANTINED").alias("status"),
        F.col("n").cast("double").alias("value"),
    )
    return union_all([fresh, rates, held]).withColumn("passed", F.col("status").isin("PASS", "QUARANTINED"))


def overall(suite: DataFrame) -> DataFrame:
    return suite.agg(F.bool_and("passed").alias("overall_pass"), F.count(F.lit(1)).alias("checks"))


def violation_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("violation_code").agg(F.count(F.lit(1)).alias("n"))


def metric_lines(suite: DataFrame, quarantine: DataFrame, prefix: str = "media") -> DataFrame:
    """Check results in text exposition format, one line per row, in order."""
    # Names and help texts of the two metrics.
    status, total = f"{prefix}_dq_check_status", f"{prefix}_dq_quarantine_total"
    spark = suite.sparkSession
    heads = spark.createDataFrame([
        (0, "", f"# HELP {status} Status of data quality check (1=PASS, 0=FAIL/WARN)"),
        (1, "", f"# TYPE {status} gauge"),
        (3, "", f"# HELP {total} Total records held in data quality quarantine"),
        (4, "", f"# TYPE {total} gauge"),
    ], "o int, k string, value string")
    checks = suite.select(
        F.lit(2).alias("o"), F.col("check").alias("k"),
        F.format_string(status + '{check="%s"} %d', F.col("check"), F.col("passed").cast("int")).alias("value"),
    )
    held = quarantine.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(5).alias("o"), F.lit("").alias("k"), F.format_string(f"{total} %d", F.col("n")).alias("value")
    )
    return union_all([heads, checks, held]).orderBy("o", "k").select("value")


def remediate(events: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Repair quarantined events: cap future times, clamp values, tag unknown titles.

    ``remediation`` lists the codes handled; a code without a rule sets ``escalated``.
    """
    has = lambda code: F.bool_or(F.col("violation_code") == code)
    flags = quarantine.groupBy("event_id").agg(
        has(FUTURE).alias("_future"), has(UNKNOWN).alias("_unknown"), has(IMPOSSIBLE).alias("_bad"),
        F.bool_or(~F.col("violation_code").isin(FUTURE, UNKNOWN, IMPOSSIBLE)).alias("escalated"),
    )
    yes = lambda c: F.coalesce(F.col(c), F.lit(False))
    play, pos, when = F.col("playback_seconds"), F.col("position_seconds"), F.col("event_time")
    handled = F.concat_ws(",", *[F.when(yes(c), F.lit(code)) for c, code in
                                 (("_future", FUTURE), ("_unknown", UNKNOWN), ("_bad", IMPOSSIBLE))])
    return (
        events.join(flags, "event_id", "left")
        .withColumns({
            "event_time": F.when(yes("_future"), F.least(when, F.col("ingestion_time"))).otherwise(when),
            "playback_seconds": F.when(yes("_bad"), F.least(F.greatest(play, F.lit(0.0)), F.lit(MAX_PLAYBACK))).otherwise(play),
            "position_seconds": F.when(yes("_bad"), F.greatest(pos, F.lit(0.0))).otherwise(pos),
            "needs_catalog_sync": yes("_unknown"),
            "remediation": handled,
            "escalated": yes("escalated"),
        })
        .drop("_future", "_unknown", "_bad")
    )


def remediation_summary(quarantine: DataFrame) -> DataFrame:
    handled = F.col("violation_code").isin(FUTURE, UNKNOWN, IMPOSSIBLE)
    return quarantine.agg(
        F.count(F.lit(1)).alias("records"), F.count_if(handled).alias("remediated"), F.count_if(~handled).alias("escalated")
    )


# Tests that return their failing rows.
def test_unique(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def test_accepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    return df.where(~F.col(column).isin(values)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


# keep pytest from collecting the three functions above when imported
for _check in (test_unique, test_not_null, test_accepted):
    _check.__test__ = False


def generic_tests(stg: DataFrame, sessions: DataFrame, daily: DataFrame, churn: DataFrame) -> DataFrame:
    """The declared tests of the models with their number of failing rows."""
    def not_nulls(model, df, columns):
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        return row.select(F.explode(F.array(*[
            F.struct(F.lit(model).alias("model"), F.lit(c).alias("column"), F.lit("not_null").alias("test"), F.col(c).alias("failures"))
            for c in columns])).alias("t")).select("t.*")

    def counted(model, column, test, bad):
        return bad.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(model).alias("model"), F.lit(column).alias("column"), F.lit(test).alias("test"), "failures"
        )

    return union_all([
        not_nulls("stg_playback_events", stg, ["event_id", "event_type", "user_id", "content_id"]),
        counted("stg_playback_events", "event_id", "unique", test_unique(stg, "event_id")),
        counted("stg_playback_events", "event_type", "accepted_values", test_accepted(stg, "event_type", PLAYBACK_TYPES)),
        not_nulls("int_watch_sessions", sessions, ["session_id", "user_id"]),
        not_nulls("mart_daily_platform_metrics", daily, ["metric_date"]),
        counted("mart_daily_platform_metrics", "metric_date", "unique", test_unique(daily, "metric_date")),
        not_nulls("mart_churn_features", churn, ["user_id"]),
        counted("mart_churn_features", "user_id", "unique", test_unique(churn, "user_id")),
    ])


def assert_completion_bounded(sessions: DataFrame) -> DataFrame:
    p = F.col("completion_percentage")
    return sessions.where((p < 0) | (p > 100)).select("session_id", "completion_percentage")


def assert_not_future(events: DataFrame, as_of, hours: int = 2) -> DataFrame:
    return events.where(F.col("event_time") > shift(as_time(as_of), hours=hours)).select("event_id", "event_time")


def unknown_content(events: DataFrame, content: DataFrame) -> DataFrame:
    """Events whose title is missing from the catalog."""
    return events.join(content.select("content_id"), "content_id", "left_anti")


def assert_subscription_states(df: DataFrame) -> DataFrame:
    return df.where(~F.col("current_status").isin(SUBSCRIPTION_STATES)).select("user_id", "current_status")


def assert_watch_positive(sessions: DataFrame) -> DataFrame:
    return sessions.where(F.col("total_watch_seconds") < 0).select("session_id", "total_watch_seconds")
