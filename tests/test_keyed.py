"""Bucketed tables under a change feed: old, repeated and deleted keys, growth, and no shuffle of the base."""

import uuid

import pytest
from pyspark.sql import functions as F

from marquee.sources import keyed

DDL = "k bigint, name string, v bigint, op string"


@pytest.fixture
def name(spark, tmp_path):
    made = "keyed_" + uuid.uuid4().hex
    yield made
    for n in keyed.versions(spark, made):
        spark.sql(f"DROP TABLE {made}__v{n}")


def feed(spark, *rows):
    return spark.createDataFrame(list(rows), DDL)


def test_changes_in_any_order(spark, name, rows):
    first = feed(spark, (1, "a", 1, "c"), (2, "b", 2, "c"), (1, "a2", 5, "u"), (None, "n", 1, "c"), (9, "x", 3, "d"))
    put = lambda df: keyed.apply_keyed(spark, name, df, ["k"], ["v"])
    put(first)
    put(feed(spark, (2, None, 6, "d"), (3, "c", 7, "c"), (None, "n2", 2, "u")))
    put(first)  # old changes again: deleted keys stay deleted, newer rows stay
    put(feed(spark, (9, "old", 1, "c"), (3, "c0", 4, "u")))
    put(feed(spark))
    assert rows(keyed.read_keyed(spark, name)) == [(1, "a2", 5), (3, "c", 7), (None, "n2", 2)]
    assert len(keyed.versions(spark, name)) == 2


def test_two_keys_and_columns_in_other_order(spark, name, rows):
    a = spark.createDataFrame([("x", 1, 1, "c"), ("x", 2, 1, "c")], "p string, q int, v int, op string")
    keyed.apply_keyed(spark, name, a, ["p", "q"], ["v"])
    keyed.apply_keyed(spark, name, a.select("op", "v", "q", "p").withColumn("v", F.col("v") + F.col("q") - 1), ["p", "q"], ["v"])
    assert rows(keyed.read_keyed(spark, name), "p", "q", "v") == [("x", 1, 1), ("x", 2, 2)]


def test_base_is_not_shuffled(spark, name):
    base = spark.range(2000).selectExpr("id AS k", "'n' AS name", "1L AS v", "'c' AS op")
    keyed.apply_keyed(spark, name, base, ["k"], ["v"], buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        stored = keyed.current(spark, name)
        news = spark.range(50).selectExpr("id AS k", "'m' AS name", "2L AS v", "false AS _deleted", "to_json(named_struct('k', id)) AS _key")
        plan = keyed.merged(stored, news.select(*stored.columns), ["v"])._jdf.queryExecution().executedPlan().toString()
        side = plan[:plan.index("Bucketed: true")] if "Bucketed: true" in plan else ""
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning") == 1
        assert "Exchange" not in side[side.rindex("SortMergeJoin"):]
        keyed.apply_keyed(spark, name, news.drop("_deleted", "_key").withColumn("op", F.lit("u")), ["k"], ["v"], buckets=4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert keyed.buckets_of(spark, name) == 4
    got = keyed.read_keyed(spark, name).groupBy("name").count().collect()
    assert {r["name"]: r["count"] for r in got} == {"m": 50, "n": 1950}


def test_buckets_follow_the_size(spark, name, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKET_BYTES", 2000)
    rows = spark.range(3000).selectExpr("id AS k", "sha2(cast(id AS string), 256) AS name", "1L AS v", "'c' AS op")
    keyed.apply_keyed(spark, name, rows, ["k"], ["v"])
    assert keyed.buckets_of(spark, name) == 1
    keyed.apply_keyed(spark, name, rows.limit(5), ["k"], ["v"])
    assert keyed.buckets_of(spark, name) > 2 and keyed.read_keyed(spark, name).count() == 3000
