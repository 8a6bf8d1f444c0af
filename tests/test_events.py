"""Validation, staging, sessions, rollups and the fault cases, with exact expected rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from marquee.functions import scalars
from marquee.operators import rollups, sessions, staging
from marquee.plans import daily, marts
from marquee.sources import events as sources
from marquee.sources.contracts import CONTRACTS
from tests.fixtures import AS_OF, as_json, at, content_df, event, events_df


def test_contracts_cover_five_streams(spark):
    assert sorted(CONTRACTS) == ["playback", "recommendation", "search", "subscription", "user"]
    for spec in CONTRACTS.values():
        assert set(spec.required) <= set(spec.fields)
        assert set(spec.defaults) <= set(spec.fields)
    df = sources.decode_json(spark.createDataFrame([('{"event_id":"1"}',)], "value string"), "recommendation")
    assert df.select("schema_version", "position_index").first() == ("1.0.0", 0)


def test_fault_cases(spark, rows):
    lines = [
        as_json(event("ok")), as_json(event("empty", content="")), as_json(event("type", "video_zap")),
        as_json(event("late", time="2024-02-20 10:00:00")), as_json(event("drift"), schema_version="99.0.0-unauthorized", extra=1),
        as_json(event("soon"), event_time="tomorrow"), as_json(event("future", time="2024-03-09 10:00:00")), "\x00\x01",
        '{"event_id": "few"}',
    ]
    df = sources.decode_json(spark.createDataFrame([(x,) for x in lines], "value string"), "playback")
    got = {r["event_id"]: r["failure_reason"] for r in staging.validate_events(df, AS_OF).collect()}
    assert got == {
        "ok": None, "late": None, "drift": None,
        "empty": "Missing required field: 'content_id'", "type": "Invalid event_type: 'video_zap'",
        "soon": "Invalid event_time format: tomorrow", "future": "Event timestamp is too far in future: 2024-03-09 10:00:00",
        None: "Payload is not a valid JSON dictionary", "few": "Missing required field: 'event_type'"}
    ok, bad = staging.split_valid(staging.validate_events(df, AS_OF))
    assert (ok.count(), bad.count()) == (3, 6)
    dlq = staging.to_dlq(bad, AS_OF, "t")
    assert dlq.columns == ["failed_event", "failure_reason", "failed_at", "source_topic"]
    assert rows(dlq.where("failure_reason like 'Payload%'"), "failed_event", "source_topic") == [("\x00\x01", "t")]


def test_schema_drift(spark, rows):
    lines = [(as_json(event("a")),), (as_json(event("b"), schema_version="99.0.0", extra=1),), ('{"event_id":"c"}',)]
    got = dict(((k, key), n) for k, key, n in rows(sources.schema_drift(spark.createDataFrame(lines, "value string"), "playback")))
    assert got[("unexpected_field", "extra")] == 1
    assert got[("bad_version", "99.0.0")] == 1
    assert got[("missing_field", "user_id")] == 1
    assert ("missing_field", "schema_version") not in got


@pytest.mark.parametrize("text,want", [
    ("2024-03-01T10:00:00Z", "2024-03-01 10:00:00"), ("2024-03-01T10:00:00+05:30", "2024-03-01 04:30:00"),
    ("2024-03-01 10:00:00.250", "2024-03-01 10:00:00.250"), ("2024-03-01 10:00:00 and more", "2024-03-01 10:00:00"),
    ("nope", None), ("", None), (None, None)])
def test_parse_event_time(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(scalars.parse_event_time(F.col("t"))).first()[0]
    assert got == (at(want) if want else None)


def test_minute_boundaries(spark):
    pairs = [("2024-03-01 10:00:59", "2024-03-01 10:01:01", 1), ("2024-03-01 10:00:01", "2024-03-01 10:00:59", 0)]
    df = spark.createDataFrame([(at(a), at(b), n) for a, b, n in pairs], "a timestamp, b timestamp, n bigint")
    assert df.where(scalars.minute_diff(F.col("a"), F.col("b")) != F.col("n")).count() == 0


def test_dedup_keeps_last_delivery(spark, rows):
    raw = events_df(spark, [
        event("e", play=1.0, arrived="2024-03-01 10:00:01"), event("e", play=2.0, arrived="2024-03-01 10:00:05"),
        # the newest delivery is unusable, so an older one survives
        event("f", play=3.0, arrived="2024-03-01 10:00:01"), event("f", content="", play=4.0, arrived="2024-03-01 10:00:09"),
        event("g", "error"), event("h", content=None), event("i", time="2024-03-01 14:00:01")])
    assert rows(staging.stg_playback_events(raw, AS_OF), "event_id", "playback_seconds") == [("e", 2.0), ("f", 3.0)]


def test_hot_event_id_is_cut_before_the_shuffle(spark):
    raw = events_df(spark, [event("hot", play=float(i), arrived=str(at("2024-03-01 10:00:00") + dt.timedelta(seconds=i))) for i in range(300)])
    df = staging.stg_playback_events(raw.repartition(8), AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
    assert [r["playback_seconds"] for r in df.collect()] == [299.0]


SEQUENCE = [
    event("1", "video_play", pos=0.0, play=0.0), event("2", "video_pause", pos=120.5, play=120.5, time="2024-03-01 10:02:00"),
    event("3", "video_play", pos=120.5, play=120.5, time="2024-03-01 10:03:00"),
    event("4", "video_seek", pos=450.0, play=120.5, time="2024-03-01 10:04:00"),
    event("5", "video_complete", pos=7200.0, play=7150.0, time="2024-03-01 12:00:30")]


def test_playback_sequence(spark, rows):
    ev, content = events_df(spark, SEQUENCE), content_df(spark)
    s = sessions.watch_sessions(ev, content)
    assert rows(s, "total_watch_seconds", "pause_count", "seek_count", "completion_percentage", "session_duration_minutes", "content_title") == [
        (7511.5, 1, 1, 100.0, 120, "One")]
    assert rows(sessions.watch_sessions(ev, content, watch_mode="max"), "total_watch_seconds") == [(7150.0,)]
    p = sessions.play_sessions(ev, content)
    assert rows(p, "watch_seconds", "pause_count", "seek_count", "completion_percentage") == [(120.5, 1, 1, 100.0)]


def test_unknown_title_and_defaults(spark, rows):
    ev = events_df(spark, [event("1", content="zz", pos=3600.0, play=None, device=None, version=None)])
    assert rows(sessions.watch_sessions(ev, content_df(spark)), "content_title", "completion_percentage") == [(None, 0.0)]
    assert rows(sessions.play_sessions(ev, content_df(spark)), "watch_seconds", "completion_percentage", "device_type", "app_version") == [
        (30.0, 50.0, "smart_tv", "1.0.0")]
    assert rows(sessions.tumbling_metrics(ev), "plays", "watch_seconds") == [(1, 0.0)]


def naive_late(items, lateness):
    high, out = {}, []
    for n, scope, t in sorted(items):
        if scope not in high or t > high[scope]:
            high[scope] = t
        out.append((n, t < high[scope] - dt.timedelta(seconds=lateness)))
    return sorted(out, key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("scope", [["p"], []])
@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_late_flag_equals_loop(spark, rows, scope, chunk):
    base = at("2024-03-01 10:00:00")
    # one source holds most of the rows
    items = [(i, 0 if i % 10 else 1, base + dt.timedelta(seconds=(i * 37) % 211)) for i in range(200)]
    df = spark.createDataFrame(items, "n bigint, p int, event_time timestamp")
    got = rows(sessions.late_flag(df, "n", 30.0, scope, chunk_rows=chunk), "n", "is_late")
    assert got == naive_late([(n, p if scope else 0, t) for n, p, t in items], 30.0)


def test_late_flag_edges(spark, rows):
    base = at("2024-03-01 10:00:00")
    df = spark.createDataFrame([(1, base), (2, base - dt.timedelta(seconds=30)), (3, base - dt.timedelta(seconds=31))], "n bigint, event_time timestamp")
    assert rows(sessions.late_flag(df, "n"), "n", "is_late") == [(1, False), (2, False), (3, True)]


def test_rollup_states_merge_to_the_exact_result(spark, rows):
    ev = events_df(spark, [event(f"e{i}", ["video_play", "video_complete", "video_pause"][i % 3], user=f"u{i % 17}", content=f"c{i % 3}", play=i / 4,
                                 time=str(at("2024-03-01 00:00:00") + dt.timedelta(minutes=11 * i))) for i in range(300)])
    for grain, exact in (("content_hourly", rollups.content_hourly), ("platform_daily", rollups.platform_daily)):
        parts = [rollups.rollup_partial(ev.where(F.col("event_id").endswith(d)), grain) for d in "0123456789"]
        state = rollups.rollup_merge(rollups.rollup_merge(staging.union_all(parts[:4]), grain).unionByName(staging.union_all(parts[4:])), grain)
        assert rows(rollups.rollup_finish(state, grain)) == rows(exact(ev))


def models(spark, events):
    searches = spark.createDataFrame([("q1", "u1", "s", "d", "web", "x", 1, "c1", at("2024-02-29 10:00:00"), at("2024-02-29 10:00:00")),
                                      ("q2", "u1", "s", "d", "web", "x", 1, None, at("2024-01-01 10:00:00"), at("2024-01-01 10:00:00"))],
                                     "event_id string, user_id string, session_id string, device_id string, device_type string, query_text string,"
                                     " results_count int, selected_content_id string, event_time timestamp, ingestion_time timestamp")
    recs = spark.createDataFrame([("r1", "u1", "recommendation_click", "m", at("2024-02-29 10:00:00")), ("r2", "u1", "recommendation_impression", "m", at("2024-02-29 10:00:00")),
                                  ("r3", "u1", "recommendation_impression", "m", at("2024-02-29 10:00:00"))],
                                 "event_id string, user_id string, event_type string, model_version string, event_time timestamp")
    return {"raw_playback_events": events, "raw_search_events": searches, "raw_recommendation_events": recs, "dim_content": content_df(spark)}


def test_churn_features(spark, rows):
    ev = events_df(spark, [event("a", play=60.0, pos=3600.0, time="2024-02-28 10:00:00"), event("b", session="s2", play=120.0, time="2024-02-10 10:00:00"),
                           event("c", session="s3", play=180.0, time="2023-12-10 10:00:00"), event("d", user="u2", session="s4", play=6.0, time="2024-02-28 10:00:00")])
    t = models(spark, ev)
    m = daily.build_models(t, AS_OF)
    assert rows(m["mart_churn_features"], "user_id", "genre_watch_minutes_7d", "genre_watch_minutes_30d", "content_completion_rate", "search_count_7d",
                "active_days_30d", "recommendation_ctr", "average_session_length") == [
        ("u1", 1.0, 3.0, 16.67, 1, 2, 33.33, 2.0), ("u2", 0.1, 0.1, 0.0, 0, 1, 0.0, 0.1)]


def test_daily_batch(spark, tmp_path, rows):
    ev = events_df(spark, SEQUENCE)
    got = dict(rows(daily.run_daily(spark, models(spark, ev), "2024-03-01", AS_OF, str(tmp_path))))
    assert got["int_watch_sessions"] == 1 and got["mart_churn_features"] == 1 and got["ml_user_features"] == 1
    assert spark.read.parquet(f"{tmp_path}/mart_daily_platform_metrics").count() == 1
    with pytest.raises(daily.GateFailed):
        daily.run_daily(spark, models(spark, ev.limit(0)), "2024-03-01", AS_OF)
    with pytest.raises(daily.GateFailed):
        daily.run_daily(spark, models(spark, ev.withColumn("user_id", F.lit(None).cast("string"))), "2024-03-01", AS_OF)


def test_retention(spark, rows):
    day = lambda d: dt.date.fromisoformat(d)
    act = spark.createDataFrame([("a", day("2024-01-01")), ("a", day("2024-01-02")), ("a", day("2024-01-08")), ("b", day("2024-01-01")),
                                 ("b", day("2024-01-31")), ("c", day("2024-01-08"))], "user_id string, activity_date date")
    d = marts.day_n_retention(act)
    assert rows(d, "cohort_date", "total_cohort_users", "day_1_retained", "day_7_retained", "day_14_retained", "day_30_retained", "day_1_retention_rate") == [
        (day("2024-01-01"), 2, 1, 1, 0, 1, 50.0), (day("2024-01-08"), 1, 0, 0, 0, 0, 0.0)]
    w = marts.weekly_retention(act)
    assert rows(w) == [(day("2024-01-01"), day("2024-01-01"), 0, 2), (day("2024-01-01"), day("2024-01-08"), 1, 1), (day("2024-01-01"), day("2024-01-29"), 4, 1),
                       (day("2024-01-08"), day("2024-01-08"), 0, 1)]


def test_rolling_rows_and_days(spark, rows):
    e = spark.createDataFrame([("c1", "One", dt.date(2024, 1, 1) + dt.timedelta(days=2 * i), 1, 1, 1.0, 50.0, 1) for i in range(9)],
                              "content_id string, content_title string, engagement_date date, total_sessions int, unique_viewers int, total_watch_hours double,"
                              " avg_completion_percentage double, daily_rank int")
    by_rows = [r[0] for r in marts.content_performance(e, content_df(spark)).orderBy("engagement_date").select("rolling_7d_watch_hours").collect()]
    by_days = [r[0] for r in marts.content_performance(e, content_df(spark), range_days=7).orderBy("engagement_date").select("rolling_7d_watch_hours").collect()]
    assert by_rows == [1, 2, 3, 4, 5, 6, 7, 7, 7]
    assert by_days == [1, 2, 3, 4, 4, 4, 4, 4, 4]


def test_continue_watching(spark, rows):
    p = spark.createDataFrame([("u", f"c{i}", 10.0 if i else 0.0, 100.0, 95.0 if i == 1 else 10.0, at("2024-03-01 10:00:00") + dt.timedelta(minutes=i)) for i in range(10)],
                              "user_id string, content_id string, position_seconds double, duration_seconds double, completion_percentage double, updated_at timestamp")
    movies = spark.createDataFrame([(f"c{i}", f"M{i}") for i in range(0, 10, 2)], "content_id string, title string")
    series = spark.createDataFrame([(f"c{i}", f"S{i}") for i in range(1, 9)], "content_id string, title string")
    got = rows(marts.continue_watching(p, movies, series), "rank", "content_id", "title", "type")
    assert got == [(2, "c8", "M8", "movie"), (3, "c7", "S7", "series"), (4, "c6", "M6", "movie"), (5, "c5", "S5", "series"), (6, "c4", "M4", "movie")]
    assert rows(marts.catalog(movies, series, n=3), "content_id", "type") == [("c0", "movie"), ("c2", "movie"), ("c4", "movie")]
    assert marts.catalog(movies, series, content_type="series").count() == 8


def test_alerts(spark, rows):
    from marquee.streaming.monitors import dlq_rate, evaluate_alerts

    base = at("2024-03-01 10:00:00")
    samples = [("kafka_consumer_lag", "t", base + dt.timedelta(seconds=30 * i), v) for i, v in enumerate([600.0] * 5 + [100.0, 900.0, 900.0, 100.0])]
    samples += [("dq_check_status", "freshness", base + dt.timedelta(minutes=i), v) for i, v in enumerate([1.0, 0.0, 0.0, 1.0, 0.0])]
    df = spark.createDataFrame(samples, "metric string, series string, ts timestamp, value double")
    assert rows(evaluate_alerts(df), "alert", "severity", "firing_from", "samples") == [
        ("ConsumerLagHigh", "warning", base, 5), ("DataQualityFailure", "critical", base + dt.timedelta(minutes=1), 2)]
    bad = spark.createDataFrame([(base,)] * 1800, "failed_at timestamp")
    seen = spark.createDataFrame([(base,)] * 2000, "received_at timestamp")
    assert rows(dlq_rate(bad, seen), "dlq_count", "ingress_count", "dlq_per_second", "rate_breach", "share_breach") == [(1800, 2000, 6.0, True, True)] * 5
