"""Sources, sinks, keyed changes, quality and governance."""

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from marquee.functions import masking
from marquee.operators import governance, quality
from marquee.sources import events as sources, lake, tables, upsert
from tests.fixtures import AS_OF, at, content_df, event, events_df


def test_document_defaults(spark, rows):
    docs = spark.read.schema(tables.DOCUMENT_DDL).json(spark.sparkContext.parallelize(['{"content_id":"a"}', '{"content_id":"b","title":"T","genres":["X"],"duration_seconds":60}']))
    assert rows(tables.sync_dim_content(docs)) == [
        ("a", "Untitled", ["General"], "en", 2024, "Unknown", 5400, "U/A 13+"), ("b", "T", ["X"], "en", 2024, "Unknown", 60, "U/A 13+")]
    dev = spark.createDataFrame([(1, "web", "n", None, "")], "device_id int, device_type string, device_name string, os string, app_version string")
    assert rows(tables.sync_dim_device(dev)) == [("1", "web", "n", "Unknown", "1.0.0")]


def test_json_and_parquet_sources(spark, tmp_path, rows):
    df = events_df(spark, [event("a")]).withColumns({c: F.col(c).cast("string") for c in ("event_time", "ingestion_time")})
    df.write.parquet(f"{tmp_path}/p")
    df.write.json(f"{tmp_path}/j")
    assert rows(sources.read_events(spark, f"{tmp_path}/p", "playback"), "event_id") == [("a",)]
    assert rows(sources.read_events(spark, f"{tmp_path}/j", "playback", "json"), "event_id") == [("a",)]
    assert rows(sources.read_events(spark, f"{tmp_path}/j", "playback", "text"), "event_id") == [("a",)]


def test_change_feed(spark, rows):
    row = {"id": 1, "email": "a@b.c", "country": "IN"}
    lines = [json.dumps({"payload": {"before": None, "after": row, "op": "r", "ts_ms": 1}}), json.dumps({"before": row, "after": {**row, "email": "new@b.c"}, "op": "u", "ts_ms": 2}),
             json.dumps({"before": None, "after": {"id": 2, "email": "z@b.c", "country": "US"}, "op": "c", "ts_ms": 3}), json.dumps({"payload": {"before": {"id": 2}, "after": None, "op": "d", "ts_ms": 4}})]
    feed = sources.decode_cdc(spark.createDataFrame([(x,) for x in lines], "value string"), "id int, email string, country string")
    changes = sources.changed_rows(feed, ["id"])
    base = spark.createDataFrame([(1, "old", "IN", 0), (9, "keep", "IN", 0)], "id int, email string, country string, ts_ms bigint")
    once = upsert.apply_changes(base, changes, ["id"], ["ts_ms"])
    assert rows(once, "id", "email") == [(1, "new@b.c"), (9, "keep")]
    # the same feed again, out of order, changes nothing
    assert rows(upsert.apply_changes(once, changes.orderBy(F.col("ts_ms").desc()), ["id"], ["ts_ms"])) == rows(once)


def test_tombstones_clear_a_changelog(spark, rows):
    log = spark.createDataFrame([("u1", "x", 1), ("u2", "y", 2), ("u1", "z", 3)], "key string, value string, offset bigint")
    gone = governance.tombstones(spark.createDataFrame([("u2",)], "user_id string"), "users").select("key", "value", F.lit(9).cast("bigint").alias("offset"))
    assert rows(upsert.compact_changelog(log.unionByName(gone)), "key", "value") == [("u1", "z")]


def test_upsert_and_insert_ignore(spark, rows):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C")], "k int, v string")
    assert rows(upsert.upsert(t, s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(upsert.upsert(upsert.upsert(t, s, ["k"]), s, ["k"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(upsert.insert_ignore(t, s.unionByName(s), ["k"])) == [(1, "a"), (2, "b"), (3, "C")]


def test_lake_round_trip(spark, tmp_path, rows):
    ev = events_df(spark, [event("a", time="2024-03-01 07:10:00"), event("b", time="2024-03-01 19:00:00"), event("c", time="2024-03-02 01:00:00")])
    root = f"{tmp_path}/lake"
    lake.write_lake(ev.withColumn("topic", F.lit("ott.playback.events.v1")), root, AS_OF)
    lake.write_lake(events_df(spark, [event("s", time="2024-03-01 07:00:00")]).withColumn("topic", F.lit("ott.search.events.v1")), root, AS_OF)
    day = lake.read_lake(spark, root, "2024-03-01")
    assert rows(day, "event_id", "category", "hour") == [("a", "playback", "07"), ("b", "playback", "19"), ("s", "search", "all")]
    plan = lake.read_lake(spark, root, "2024-03-01", "playback")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(" in plan and "PushedFilters: []" in plan
    out = sources.replay(day.drop("topic"))
    assert rows(out, "key", "topic") == [("u1", "ott.playback.events.v1"), ("u1", "ott.playback.events.v1"), ("u1", "ott.search.events.v1")]
    assert all(json.loads(r["value"])["is_replayed"] is True for r in out.collect())
    assert {r["topic"] for r in sources.replay(day, "elsewhere").collect()} == {"elsewhere"}


def test_medallion(spark, tmp_path, rows):
    from marquee.operators.sessions import silver_playback
    from marquee.plans.marts import gold_content_daily

    ev = events_df(spark, [event("a", play=60.0), event("b", "video_complete", user="u2", pos=7200.0, time="2024-03-01 11:00:00")]).withColumn("n", F.monotonically_increasing_id())
    lake.write_bronze(ev.drop("n"), f"{tmp_path}/bronze")
    assert rows(spark.read.parquet(f"{tmp_path}/bronze"), "event_id", "event_hour") == [("a", 10), ("b", 11)]
    silver = silver_playback(ev, content_df(spark), AS_OF, "n")
    lake.write_silver(silver, f"{tmp_path}/silver")
    lake.write_silver(silver.withColumn("content_title", F.lit("Renamed")).where("event_id = 'a'"), f"{tmp_path}/silver")
    got = spark.read.parquet(f"{tmp_path}/silver")
    assert rows(got, "event_id", "content_title") == [("a", "Renamed"), ("b", "One")]
    gold = gold_content_daily(got, content_df(spark), AS_OF)
    lake.write_gold(gold, f"{tmp_path}/gold")
    lake.write_gold(gold, f"{tmp_path}/gold")
    assert rows(spark.read.parquet(f"{tmp_path}/gold"), "total_plays", "total_completions", "unique_viewers", "metric_month") == [(1, 1, 2, "2024-03")]
    upsert.reload_table(gold, f"{tmp_path}/r")
    upsert.reload_table(gold, f"{tmp_path}/r")
    assert spark.read.parquet(f"{tmp_path}/r").count() == 1
    lake.sorted_playback(ev, f"{tmp_path}/raw")
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 2


def test_masks(spark, rows):
    df = spark.createDataFrame([("subscriber@example.com", "+919876543210", "192.168.1.105"), ("ab@x.y", "123", "1.2.3"), (None, None, None), ("@x.y", "", "")], "e string, p string, i string")
    got = [tuple(r) for r in df.select(masking.mask_email(F.col("e")), masking.mask_phone(F.col("p")), masking.mask_ip(F.col("i"))).collect()]
    none = masking.NO_EMAIL
    assert got == [("s***r@example.com", "+91-XXXXX-3210", "192.168.x.x"), ("a***@x.y", "+XX-XXXX-XXXX", "x.x.x.x"),
                   (none, "+XX-XXXXX-XXXXX", "0.0.0.0"), (none, "+XX-XXXXX-XXXXX", "0.0.0.0")]


def test_pseudonyms_equal_python(spark):
    df = spark.createDataFrame([("u1",), ("ünï",)], "u string")
    for (u, keyed, salted) in df.select("u", masking.pseudonymize(F.col("u"), "hmac", "k"), masking.pseudonymize(F.col("u"), "sha256", "s")).collect():
        assert keyed == hmac.new(b"k", u.encode(), hashlib.sha256).hexdigest()
        assert salted == hashlib.sha256(b"s" + u.encode()).hexdigest()


def test_keys_stay_out_of_plans(spark):
    df = spark.createDataFrame([(5,)], "user_id bigint")
    masked = governance.apply_catalog(df, "users", "my own key")
    for mode in ("extended", "formatted"):
        plan = masked._jdf.queryExecution().explainString(spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))
        assert "my own key" not in plan and "[B@" not in plan and "5B4F16" not in plan.upper()
    assert masked.first()[0] == hmac.new(b"my own key", b"5", hashlib.sha256).hexdigest()
    for bad in (None, "", "x" * 65):
        with pytest.raises(ValueError):
            governance.apply_catalog(df, "users", bad)


def test_free_text_masks_whole_text(spark):
    text = "Mail jane.roe@mail.example.com, x@y.zz or ab@c.de; host 10.20.30.40; call +1 (743) 555-3824. " + "word " * 5000 + "end@far.away.org"
    got = spark.createDataFrame([(text,)], "t string").select(masking.mask_free_text(F.col("t"))).first()[0]
    assert got.startswith("Mail j***e@mail.example.com, x***@y.zz or a***@c.de; host 10.20.x.x; call +91-XXXXX-3824. ")
    assert got.endswith("e***d@far.away.org")


def test_erasure(spark, rows):
    users = spark.createDataFrame([("u1", 1), ("u2", 2), ("u3", 3)], "user_id string, v int")
    subs = spark.createDataFrame([("u1",), ("u1",), ("u2",)], "owner string")
    gone = spark.createDataFrame([("u1", at("2024-02-20 00:00:00")), ("u9", at("2024-02-29 00:00:00"))], "user_id string, requested_at timestamp")
    kept, audit = governance.erase_users({"users": users, "subs": subs}, gone, {"subs": "owner"})
    assert rows(kept["users"], "user_id") == [("u2",), ("u3",)] and rows(kept["subs"]) == [("u2",)]
    assert rows(audit) == [("subs", "u1", 2), ("users", "u1", 1)]
    done = spark.createDataFrame([], "user_id string, erased_at timestamp")
    assert rows(governance.erasure_sla(gone, done, AS_OF), "user_id", "hours_open") == [("u1", 252)]
    assert rows(governance.apply_catalog(users, "users", "k"), "v") == [(1,), (2,), (3,)]
    assert all(len(r[0]) == 64 for r in governance.apply_catalog(users, "users", "k").select("user_id").collect())


def test_quarantine_and_repair(spark, rows):
    ev = events_df(spark, [event("ok"), event("fut", content="zz", time="2024-03-01 13:00:00", arrived="2024-03-01 10:00:00"), event("neg", pos=-5.0, play=90000.0), event("blank", content="")])
    held = quality.find_violations(ev, content_df(spark), AS_OF)
    assert rows(held, "event_id", "violation_code") == [("fut", "FUTURE_TIMESTAMP"), ("fut", "UNKNOWN_CONTENT_ID"), ("neg", "IMPOSSIBLE_PLAYBACK_VALUE")]
    assert rows(held, "quarantine_id") == rows(quality.find_violations(ev, content_df(spark), AS_OF), "quarantine_id")
    assert json.loads(held.where("event_id = 'neg'").first()["raw_payload"]) == {"playback_seconds": 90000.0, "position_seconds": -5.0}
    odd = held.limit(1).withColumns({"event_id": F.lit("ok"), "violation_code": F.lit("NEW_RULE")})
    fixed = quality.remediate(ev, held.unionByName(odd))
    assert rows(fixed, "event_id", "event_time", "playback_seconds", "position_seconds", "needs_catalog_sync", "remediation", "escalated") == [
        ("blank", at("2024-03-01 10:00:00"), 0.0, 0.0, False, "", False), ("fut", at("2024-03-01 10:00:00"), 0.0, 0.0, True, "FUTURE_TIMESTAMP,UNKNOWN_CONTENT_ID", False),
        ("neg", at("2024-03-01 10:00:00"), 86400.0, 0.0, False, "IMPOSSIBLE_PLAYBACK_VALUE", False), ("ok", at("2024-03-01 10:00:00"), 0.0, 0.0, False, "", True)]
    assert rows(quality.remediation_summary(held.unionByName(odd))) == [(4, 3, 1)]
    suite = quality.run_suite(ev, content_df(spark), AS_OF)
    # one blank title in four events is above the limit of 5 %
    assert rows(suite, "check", "status", "passed") == [("freshness", "PASS", True), ("null_and_duplicate_rates", "FAIL", False), ("quarantine_routing", "QUARANTINED", True)]
    assert rows(quality.overall(suite)) == [(False, 3)]


def test_empty_input(spark, rows):
    none = events_df(spark, [event("x")]).limit(0)
    assert rows(quality.freshness(none, AS_OF), "lag_seconds", "status") == [(999999.0, "WARN")]
    assert rows(quality.null_and_duplicate_rates(none), "total_records", "status") == [(1, "PASS")]
    assert rows(quality.validate_partition(none, "2024-03-01"), "passed") == [(False,)]


@pytest.mark.parametrize("check", [quality.assert_completion_bounded, quality.assert_watch_positive])
def test_singular_assertions_find_bad_rows(spark, check):
    bad = spark.createDataFrame([("s", 101.0, -1.0), ("t", 50.0, 1.0)], "session_id string, completion_percentage double, total_watch_seconds double")
    assert [r["session_id"] for r in check(bad).collect()] == ["s"]
