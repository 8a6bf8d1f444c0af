"""Streams with state of their own, over several micro-batches, against their batch twins."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from checks.streams import in_batches, run_to_end
from marquee.operators import sessions
from marquee.session import scratch_path
from marquee.streaming import meter, monitors, sinks, stateful
from tests.fixtures import at, event, events_df


@pytest.fixture(autouse=True)
def few_partitions(spark):
    """Every state partition starts a Python worker in every batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def collected(spark, df, tmp_path, name="t"):
    run_to_end(df, sinks.foreach_batch_sink({name: lambda d: d}, str(tmp_path)))
    return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")


def test_late_flags_equal_batch(spark, tmp_path, rows):
    stateful.use_state_store(spark)
    minute = lambda n: str(at("2024-03-01 10:00:00") + dt.timedelta(seconds=n * 20))
    steps = [0, 3, 1, 2, 9, 4, 5, 30, 8, 28, 29, 7, 50, 2, 49, 48, 47, 60]
    made = events_df(spark, [event(f"e{i:02}", content=None if i % 5 == 0 else "c1", time=minute(s)) for i, s in enumerate(steps)])
    df = made.withColumn("n", F.substring("event_id", 2, 2).cast("bigint")).withColumn("part", F.when(F.col("n") % 3 > 0, F.col("n") % 3))
    want = sessions.late_flag(df, "n", 30.0, ["part"])
    got = collected(spark, stateful.flag_late(in_batches(df, F.col("n"), 4), "n", 30.0, ["part"]), tmp_path)
    assert rows(got.drop("late_count", "batch_id", "run_id"), *df.columns, "is_late") == rows(want.where("part IS NOT NULL").unionByName(
        sessions.late_flag(df.where("part IS NULL").withColumn("part", F.lit(0).cast("bigint")), "n", 30.0, ["part"]).withColumn(
            "part", F.lit(None).cast("bigint"))), *df.columns, "is_late")
    late = got.groupBy("part").agg(F.max("late_count").alias("n"), F.count_if("is_late").alias("m"))
    assert late.where("n <> m").isEmpty() and late.agg(F.sum("m")).first()[0] >= 2


def test_late_flags_without_scope_and_times(spark, tmp_path, rows):
    stateful.use_state_store(spark)
    path, check = str(tmp_path / "in"), str(tmp_path / "check")
    data = [(1, "2024-01-01 00:10:00"), (2, None), (3, "2024-01-01 00:09:00"), (4, "2024-01-01 00:09:31"), (2, "0001-01-01 00:00:00")]
    spark.createDataFrame(data, "n bigint, t string").selectExpr("n", "cast(t as timestamp) AS event_time").coalesce(1).write.parquet(path)
    flagged = stateful.flag_late(spark.readStream.schema("n bigint, event_time timestamp").parquet(path), "n")
    q = (flagged.writeStream.foreachBatch(sinks.foreach_batch_sink({"t": lambda d: d}, str(tmp_path / "o"))).option("checkpointLocation", check)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/o/t").withColumn("t", F.col("event_time").cast("string"))
    assert rows(got, "n", "t", "is_late", "late_count") == [
        (1, "2024-01-01 00:10:00", False, 0), (2, "0001-01-01 00:00:00", True, 1), (2, None, None, 1), (3, "2024-01-01 00:09:00", True, 2), (4, "2024-01-01 00:09:31", False, 2)]
    assert rows(stateful.late_totals(spark, check).select("late", "events", F.col("high_mark").cast("string"))) == [(2, 5, "2024-01-01 00:10:00")]


def test_alert_timers(spark, tmp_path, rows):
    """Held, healed before the hold, healed at it, out of order within the delay, two rules on a metric, nulls."""
    stateful.use_state_store(spark)
    base = at("2024-03-01 10:00:00")
    values = {"a": [9, 9, 9, 0, 9, 0, 9, 9, 9, 9], "b": [9, 9, 0, 9, 9, 0, None, 9, 9, 0], "c": [0] * 10, "d": [9] * 10}
    data = [("lag", s, base + dt.timedelta(seconds=60 * i + (7 if s == "a" and i == 4 else 0)), float(v) if v is not None else None)
            for s, vs in values.items() for i, v in enumerate(vs)]
    metrics = spark.createDataFrame(data, "metric string, series string, ts timestamp, value double")
    rules = [monitors.Rule("High", "lag", ">", 5.0, 120, "warning"), monitors.Rule("Low", "lag", "<=", 0.0, 60, "critical")]
    end = spark.createDataFrame([("lag", "z", base + dt.timedelta(hours=9), None)], metrics.schema)
    # arrivals out of order by at most two minutes
    jumbled = F.unix_seconds("ts") + F.pmod(F.xxhash64("series", "ts"), F.lit(110))
    got = collected(spark, stateful.stream_alerts(in_batches(metrics, jumbled, 5, end), rules, "3 minutes"), tmp_path)
    want = monitors.evaluate_alerts(metrics, rules)
    columns = ["alert", "severity", "series", "firing_from", "firing_to", "samples"]
    assert rows(stateful.firing_intervals(got), *columns) == rows(want, *columns) != []
    held = rows(got.where("state = 'held'"), "alert", "series", "firing_from")
    fired = {r[:3] for r in rows(want, "alert", "series", "firing_from")}
    assert len(held) == len(set(held)) and fired <= set(held)
    # b's first breach is healed exactly when its hold is over, its others before
    assert not any(r[1] == "b" and r[0] == "High" for r in held)


def test_dlq_rate_stream(spark, tmp_path, rows):
    """Windows of one side only, and none that is not closed."""
    base = at("2024-03-01 10:00:00")
    came = [(base + dt.timedelta(seconds=7 * i),) for i in range(200)] + [(base + dt.timedelta(hours=5),)]
    dead = [(base + dt.timedelta(seconds=31 * i),) for i in range(20)] + [(base + dt.timedelta(hours=1, minutes=3),), (base + dt.timedelta(hours=5),)]
    ingress, dlq = spark.createDataFrame(came, "received_at timestamp"), spark.createDataFrame(dead, "failed_at timestamp")
    got = collected(spark, monitors.stream_dlq_rate(in_batches(dlq, F.unix_seconds("failed_at"), 4), in_batches(ingress, F.unix_seconds("received_at"), 4)), tmp_path)
    want = monitors.dlq_rate(dlq, ingress).where(F.col("window_end") <= F.lit(base + dt.timedelta(hours=5)) - F.expr("INTERVAL 10 SECONDS"))
    assert rows(got, *want.columns) == rows(want)


def test_stop_after_and_resume(spark, tmp_path, rows):
    df = spark.range(900).selectExpr("id", "id % 7 = 0 AS odd")
    src = meter.observed(in_batches(df, F.col("id"), 6), odd=F.col("odd"))
    write = sinks.foreach_batch_sink({"t": lambda d: d}, str(tmp_path / "o"))
    start = lambda **when: lambda: src.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "c")).trigger(**when).start()
    first = meter.run_metered(spark, start(processingTime="2 seconds"), stop_after=200)
    assert 200 <= first.totals["received"] < 900 and first.offset is not None
    second = meter.run_metered(spark, start(availableNow=True))
    assert rows(spark.read.parquet(str(tmp_path / "o/t")), "id") == [(i,) for i in sorted(range(900), key=str)]
    assert min(second.batches) > max(first.batches) and second.offset > first.offset
    assert first.totals["odd"] <= 129 and scratch_path(spark, "x")
    none = meter.run_metered(spark, start(availableNow=True))
    assert none.totals.get("received", 0) == 0


def test_timeout_stops(spark, tmp_path):
    src = meter.observed(in_batches(spark.range(10).toDF("id"), F.col("id"), 2))
    endless = lambda: src.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(processingTime="1 second").start()
    assert meter.run_metered(spark, endless, seconds=3).totals.get("received", 0) <= 10
    assert not spark.streams.active
