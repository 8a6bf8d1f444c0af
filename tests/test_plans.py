"""Plans: what is pushed down, pruned, cut before a shuffle or broadcast."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from marquee.operators import rules, sessions, staging, vector
from marquee.plans import marts
from marquee.sources.lake import read_playback, sorted_playback
from tests.fixtures import AS_OF, at, content_df, event, events_df


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("raw"))
    rows = [event(f"e{i}", ["video_play", "video_pause"][i % 2], user=f"u{i % 7}", play=float(i),
                  time=str(at("2024-01-01 00:00:00") + dt.timedelta(hours=12 * i))) for i in range(120)]
    sorted_playback(events_df(spark, rows), root)
    return root


def test_filters_and_columns_reach_the_scan(spark, stored):
    plan = plan_of(marts.recent_play_stats(spark.read.parquet(stored), AS_OF))
    assert "EqualTo(event_type,video_play)" in plan and "GreaterThanOrEqual" in plan.split("PushedFilters")[1]
    assert re.search(r"ReadSchema: struct<event_type:string,playback_seconds:double,event_time:timestamp>", plan)


def test_months_are_pruned(spark, stored):
    df = read_playback(spark, stored, since="2024-02-16 12:00:00")
    assert "month" in plan_of(df).split("PartitionFilters: [")[1].split("]")[0]
    assert df.count() == spark.read.parquet(stored).where("event_time >= '2024-02-16 12:00:00'").count()
    only = read_playback(spark, stored, "2024-01-31 00:00:00", "2024-02-02 00:00:00")
    assert sorted(r[0] for r in only.select("event_time").collect()) == [at("2024-01-31 00:00:00") + dt.timedelta(hours=12 * i) for i in range(4)]


def test_sessions_join_the_catalog_after_aggregation(spark, stored):
    plan = plan_of(sessions.watch_sessions(spark.read.parquet(stored), content_df(spark)))
    assert plan.index("Join") < plan.index("Aggregate(key=") if "Aggregate(key=" in plan else plan.index("Join") < plan.index("Aggregate")


@pytest.mark.parametrize("build", [
    lambda ev: staging.stg_playback_events(ev, AS_OF),
    lambda ev: staging.top_k(ev, ["user_id"], [F.col("event_time").desc()], 5),
    lambda ev: staging.latest_by_key(ev, ["user_id"], ["event_time"]),
])
def test_groups_are_cut_before_the_shuffle(spark, stored, build):
    plan = plan_of(build(spark.read.parquet(stored)))
    assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit .*Partial", plan)


def test_top_users_sort_only_their_head(spark, stored):
    assert "TakeOrderedAndProject" in plan_of(marts.top_active_users(spark.read.parquet(stored)))


def test_no_cartesian_products(spark, stored):
    ev = spark.read.parquet(stored).withColumn("n", F.regexp_extract("event_id", r"\d+", 0).cast("bigint"))
    vecs = spark.range(20).select(F.col("id").alias("chunk_id"), F.array(F.col("id").cast("double"), F.lit(1.0)).alias("vec"))
    plans = [
        plan_of(sessions.late_flag(ev, "n")), plan_of(rules.association_rules(rules.baskets(ev))),
        plan_of(vector.knn(vecs.withColumnRenamed("chunk_id", "query_id"), vecs, 3)),
    ]
    assert not any("CartesianProduct" in p or "NestedLoop" in p for p in plans)
