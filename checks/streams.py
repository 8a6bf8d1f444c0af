"""Stream jobs run over the whole event table until it is used up, then read back."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from checks.given import AS_OF, Given
from marquee.functions.scalars import PLAYBACK_TOPIC
from marquee.operators import rollups
from marquee.session import scratch_path
from marquee.sources import keyed as keyed_tables
from marquee.sources.contracts import CONTRACTS
from marquee.sources.lake import write_lake
from marquee.sources.upsert import read_changed
from marquee.streaming import complete, jobs, meter, monitors, sinks, stateful

ONCE = {"availableNow": True}


class Streamed(Given):
    """Tables derived from a streaming read of the chosen given table."""

    def __init__(self, g: Given, name: str):
        super().__init__(g.spark, g.dir)
        self.name = name

    def read(self, name: str) -> DataFrame:
        batch = super().read(name)
        if name != self.name:
            return batch
        return self.spark.readStream.schema(batch.schema).option("pathGlobFilter", f"{name}.parquet").parquet(self.dir)


def run_to_end(df: DataFrame, sink, mode: str = "append") -> None:
    spark = df.sparkSession
    query = (df.writeStream.foreachBatch(sink).outputMode(mode).trigger(**ONCE)
             .option("checkpointLocation", scratch_path(spark, "checkpoint")).start())
    query.awaitTermination()


def playback(g: Given, table: str) -> DataFrame:
    """One output of the playback stream."""
    root = scratch_path(g.spark, "playback")
    running = jobs.run_playback_stream(
        Streamed(g, "events").raw, g.content, root, scratch_path(g.spark, "checkpoint"), as_of=AS_OF,
        order_col="event_id", scope=["source_partition"], outputs=(table,), **ONCE)
    jobs.run_until(list(running.values()))
    return sinks.read_batches(g.spark, f"{root}/{table}")


def archived(g: Given, by_stream: Column | None = None) -> DataFrame:
    """The archive of all deliveries: filled by a stream, or the rows not ``by_stream`` by a batch job."""
    root = scratch_path(g.spark, "lake")
    raw = Streamed(g, "events").raw.withColumn("topic", F.lit(PLAYBACK_TOPIC))
    mine = raw if by_stream is None else raw.where(by_stream)
    jobs.write_lake_stream(mine, root, scratch_path(g.spark, "checkpoint"), **ONCE).awaitTermination()
    if by_stream is not None:
        write_lake(g.raw.where(~by_stream).withColumn("topic", F.lit(PLAYBACK_TOPIC)), root, AS_OF)
    return g.spark.read.parquet(root).select(
        "event_id", "ingestion_time", "category", F.col("date").cast("string"), F.lpad(F.col("hour").cast("string"), 2, "0").alias("hour"))


def rolled_up(g: Given, grain: str) -> DataFrame:
    path = scratch_path(g.spark, "rollup")
    run_to_end(Streamed(g, "events").raw.select(*CONTRACTS["playback"].fields), sinks.rollup_sink(grain, path))
    return rollups.rollup_finish(sinks.read_rollup(g.spark, grain, path), grain)


def windowed_rollup(g: Given, grain: str) -> DataFrame:
    """Windows closed by the watermark only."""
    root = scratch_path(g.spark, "windows")
    make = {"content_hourly": jobs.stream_content_hourly, "platform_daily": jobs.stream_platform_daily}[grain]
    stream = Streamed(g, "events").raw.withWatermark("event_time", jobs.LATENESS)
    run_to_end(make(stream), sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return rollups.rollup_finish(sinks.read_batches(g.spark, f"{root}/t"), grain)


def changed(g: Given) -> DataFrame:
    path = scratch_path(g.spark, "changes")
    feed = Streamed(g, "orders").subs.select("user_id", "plan_id", "status", "updated_at", "subscription_id", "op")
    run_to_end(feed, sinks.changes_sink(path, ["user_id"], ["updated_at", "subscription_id"]))
    return read_changed(g.spark, path)


# --- several batches: the whole table cut by a value ------------------------------------

BATCHES = 5


def in_batches(df: DataFrame, at, parts: int = BATCHES, last: DataFrame | None = None) -> DataFrame:
    """A stream of all rows of ``df`` in ``parts`` micro-batches by rising ``at`` (a number, nulls first), and ``last`` as one more.

    The file source takes files in the order in which they were written, one file a batch.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "arrivals")
    df = df.persist()  # derived once, read for the bounds and each part
    try:
        bounds = df.select(F.percentile_approx(at, [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
        for low, high in zip([None, *bounds], [*bounds, None]):
            rows = df if low is None else df.where(at >= low)
            rows = rows if high is None else rows.where(at < high if low is not None else at.isNull() | (at < high))
            rows.repartition(1).write.mode("append").parquet(path)  # all cores choose the rows, one task files them
        if last is not None:
            last.coalesce(1).write.mode("append").parquet(path)
    finally:
        df.unpersist()
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path)


def deliveries(g: Given) -> DataFrame:
    """Deliveries with their arrival number."""
    return g.raw.withColumn("arrival", F.unix_micros("ingestion_time") * 2 + F.pmod("event_id", F.lit(2)))


_RUNS: dict[tuple[str, str], tuple[str, meter.Meter]] = {}


def complete_run(g: Given) -> tuple[str, meter.Meter]:
    """Tables and meter of the loss-free stream over all deliveries; one run serves all queries of a session."""
    known = (g.spark.sparkContext.applicationId, g.dir)
    if known not in _RUNS:
        root, check = scratch_path(g.spark, "complete"), scratch_path(g.spark, "checkpoint")
        src = in_batches(deliveries(g), F.unix_micros("ingestion_time"))
        start = lambda: complete.run_complete_stream(src, g.content, root, check, order_col="arrival", scope=["source_partition"], as_of=AS_OF, **ONCE)
        _RUNS[known] = root, meter.run_metered(g.spark, start)
    return _RUNS[known]


def late_flags(g: Given) -> DataFrame:
    """Late flags and counts of first deliveries, from state, over several batches."""
    stateful.use_state_store(g.spark)
    clean = g.events.withColumn("source_partition", F.col("user_id") % 6).select("event_id", "source_partition", "event_time")
    src = in_batches(clean, F.col("event_id"))
    root = scratch_path(g.spark, "flags")
    run_to_end(stateful.flag_late(src, "event_id", 30.0, ["source_partition"]), sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return sinks.read_batches(g.spark, f"{root}/t")


def alerts(g: Given, metrics: DataFrame, rule: monitors.Rule) -> DataFrame:
    """Firing intervals of a metric stream; a last sample of no rule's series moves the watermark over the end."""
    stateful.use_state_store(g.spark)
    end = metrics.limit(0).unionByName(metrics.agg(F.lit(rule.metric).alias("metric"), F.lit(None).cast(metrics.schema["series"].dataType).alias("series"),
                                                   (F.max("ts") + F.expr("INTERVAL 9 DAYS")).alias("ts"), F.lit(None).cast("double").alias("value")))
    src = in_batches(metrics, F.unix_seconds("ts"), last=end)
    root = scratch_path(g.spark, "alerts")
    told = stateful.stream_alerts(src, [rule], "1 hour")
    run_to_end(told, sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return stateful.firing_intervals(g.spark.read.schema(told.schema).parquet(f"{root}/t"))


def dlq_windows(g: Given, marked: DataFrame) -> DataFrame:
    """Closed windows of dead letters against ingress; a last row moves both watermarks over the end."""
    last = marked.agg((F.max("ingestion_time") + F.expr("INTERVAL 9 DAYS")).alias("ingestion_time"), F.lit("end").alias("failure_reason"))
    src = in_batches(marked, F.unix_micros("ingestion_time"), last=last)
    dead = src.where("failure_reason IS NOT NULL").select(F.col("ingestion_time").alias("failed_at"))
    rates = monitors.stream_dlq_rate(dead, src.select(F.col("ingestion_time").alias("received_at")))
    root = scratch_path(g.spark, "rates")
    run_to_end(rates, sinks.foreach_batch_sink({"t": lambda d: d}, root))
    return sinks.read_batches(g.spark, f"{root}/t")


def stopped_and_resumed(g: Given) -> tuple[DataFrame, int, meter.Meter, meter.Meter]:
    """Deliveries stored by a run that is stopped after half of them and by a second one over its checkpoint, and the number sent."""
    root, check = scratch_path(g.spark, "resumed"), scratch_path(g.spark, "checkpoint")
    rows = deliveries(g).select("event_id", "ingestion_time")
    sent = rows.count()
    src = meter.observed(in_batches(rows, F.unix_micros("ingestion_time"), 8))

    def start(**when):
        return lambda: (src.writeStream.foreachBatch(sinks.foreach_batch_sink({"t": lambda d: d}, root)).outputMode("append")
                        .option("checkpointLocation", check).trigger(**when).start())

    first = meter.run_metered(g.spark, start(processingTime="1 second"), stop_after=sent // 2)
    second = meter.run_metered(g.spark, start(**ONCE))
    return g.spark.read.schema(rows.schema).parquet(f"{root}/t"), sent, first, second


def keyed(g: Given) -> DataFrame:
    """A change feed out of order in several batches, its first third delivered again at the end, in a bucketed table."""
    feed = g.subs.select("user_id", "plan_id", "status", "updated_at", "subscription_id", "op")
    name = "changes_" + uuid.uuid4().hex
    at = F.pmod(F.xxhash64("subscription_id"), F.lit(300))
    stream = in_batches(feed, at, 3, last=feed.where(at < 100))
    run_to_end(stream, keyed_tables.keyed_sink(name, ["user_id"], ["updated_at", "subscription_id"]))
    return keyed_tables.read_keyed(g.spark, name)
