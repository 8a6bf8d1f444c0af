"""The playback stream without loss: each valid event is stored once, however late, flagged and counted.

No step depends on a watermark. Late flags need each scope's largest time so far: a row per scope, filed with every
batch (``high_marks``); within a batch they come from chunks of arrivals, so all cores share a scope. Events are filed
by their own day, so a redelivery is looked up only in the days of its batch. Sessions, windows and counts are
mergeable states per batch, added up on read: a late event joins a later state. All tables are filed by run and batch, and
a run is named in its checkpoint, so a repeated batch replaces itself and a new checkpoint replaces nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.sessions import (
    enrich_events, late_flag, session_finish, session_merge, session_partial, tumbling_finish, tumbling_merge, tumbling_partial,
)
from marquee.operators.staging import event_instant, to_dlq, validate_events
from marquee.sources.upsert import exists, file_system, kept, overwrite_partitions
from marquee.streaming.jobs import trigger, typed
from marquee.streaming.meter import observed
from marquee.streaming.sinks import BATCH, RUN

DAY = "event_day"
CHUNK_ROWS = 100_000  # arrivals that one window takes in order, on average
MAX_ARRIVAL = (1 << 63) - 1


def run_name(spark: SparkSession, checkpoint: str) -> str:
    """The name of the run that owns a checkpoint; a new checkpoint gets a new one."""
    path = f"{checkpoint}/run_name"
    if not exists(spark, path):
        location, fs = file_system(spark, path)
        out = fs.create(location, False)
        out.writeBytes(f"run-{uuid.uuid4().hex}")
        out.close()
    return spark.read.text(path).first()[0]


def file_batch(df: DataFrame, batch_id: int, path: str, run: str, by: tuple[str, ...] = ()) -> None:
    """Write rows below run and batch, ``by`` first; the rows of a folder meet, and busy folders are split."""
    filed = df.withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("bigint")})
    overwrite_partitions(filed.hint("rebalance", *by) if by else filed, path, [*by, RUN, BATCH])


def read_filed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(DAY, RUN, BATCH)


def first_deliveries(events: DataFrame, order_col: str, key: str = "event_id") -> DataFrame:
    """The earliest arrival of every key in one batch."""
    arrivals = Window.partitionBy(key).orderBy(order_col, "event_time")
    return events.withColumn("_n", F.row_number().over(arrivals)).where("_n = 1").drop("_n")


def stored_keys(spark: SparkSession, table: str, days: list[str], run: str, batch_id: int, key: str, kind) -> DataFrame | None:
    """(key, day) of what earlier batches stored for some days; only the folders of these days are listed and read."""
    folders = [f for f in (f"{table}/{DAY}={d}" for d in days) if exists(spark, f)]
    if not folders:
        return None
    schema = f"{key} {kind.simpleString()}, {DAY} date, {RUN} string, {BATCH} bigint"
    stored = spark.read.schema(schema).option("basePath", table).parquet(*folders)
    return stored.where((F.col(RUN) != run) | (F.col(BATCH) != batch_id)).select(key, DAY)


def judged(src: DataFrame, as_of=None) -> DataFrame:
    """A stream's rows with ``failure_reason``; counted as ``received`` and ``dead_lettered``."""
    checked = validate_events(src, F.current_timestamp() if as_of is None else as_of)
    return observed(checked, dead_lettered=F.col("failure_reason").isNotNull())


def marked_late(batch: DataFrame, batch_id: int, root: str, run: str, order_col: str, scope: list[str], lateness_seconds: float) -> DataFrame:
    """A kept batch with ``is_late``: behind the largest valid time that its scope has seen, in all batches of the run so far.

    Copies of an event are flagged too: they raise no maximum that the first had not raised, so no flag depends on them.
    The new maxima are filed under the batch; they hold those of the batches before, so only one is read.
    """
    spark, path = batch.sparkSession, f"{root}/high_marks"
    timed = batch.withColumns({
        "_scope": F.to_json(F.struct(*scope)) if scope else F.lit("{}"), "_arrival": F.coalesce(F.col(order_col).cast("bigint"), F.lit(MAX_ARRIVAL)),
        "_valid_time": F.when(F.col("failure_reason").isNull(), event_instant(batch))})
    high = timed.groupBy("_scope").agg(F.max("_valid_time").alias("high_mark"))
    marks, before = None, f"{path}/{RUN}={run}/{BATCH}={batch_id - 1}"
    if exists(spark, before):
        marks = spark.read.schema(high.schema).parquet(before)
        high = high.unionByName(marks).groupBy("_scope").agg(F.max("high_mark").alias("high_mark"))
    file_batch(high.coalesce(1), batch_id, path, run)
    known = timed.where(F.col("_arrival") < MAX_ARRIVAL)
    seen = known.agg(F.count(F.lit(1)).alias("n"), F.min("_arrival").alias("low"), F.max("_arrival").alias("high")).first()
    width = max(1, (seen.high - seen.low) // -(-seen.n // CHUNK_ROWS) + 1) if seen.n else 1
    return late_flag(timed, "_arrival", lateness_seconds, ["_scope"], "_valid_time", width, marks).drop("_scope", "_arrival", "_valid_time")


def complete_sink(content: DataFrame, root: str, run: str, order_col: str, as_of=None, scope: list[str] = (),
                  lateness_seconds: float = 30.0) -> Callable[[DataFrame, int], None]:
    """Dead letters, new events with title and late flag, and the states of sessions, windows and counts of a judged batch.

    A batch that has ``is_late`` already keeps it.
    """
    now = F.current_timestamp() if as_of is None else as_of
    table, key = f"{root}/events", "event_id"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = kept(batch)
        given = batch.drop("failure_reason", "is_late", "late_count").columns
        flagged = batch if "is_late" in batch.columns else marked_late(batch, batch_id, root, run, order_col, list(scope), lateness_seconds)
        ok = typed(flagged.where("failure_reason IS NULL").select(*given, "is_late")).withColumn(DAY, F.to_date("event_time"))
        days = [str(r[0]) for r in typed(batch.where("failure_reason IS NULL")).select(F.to_date("event_time").alias(DAY)).distinct().toLocalIterator()]  # the days of one batch
        stored = stored_keys(spark, table, days, run, batch_id, key, batch.schema[key].dataType)
        fresh = first_deliveries(ok, order_col, key)
        fresh = kept(fresh if stored is None else fresh.join(stored, [key, DAY], "left_anti"))
        try:
            file_batch(enrich_events(fresh, content), batch_id, table, run, (DAY,))
            file_batch(session_partial(fresh), batch_id, f"{root}/sessions", run)
            file_batch(tumbling_partial(fresh), batch_id, f"{root}/windows", run)
            bad = batch.where("failure_reason IS NOT NULL").select(*given, "failure_reason")
            file_batch(to_dlq(bad, now), batch_id, f"{root}/dead_letters", run)
            zero, n = F.lit(0).cast("bigint"), F.count(F.lit(1))
            came = batch.agg(n.alias("received"), F.count("failure_reason").alias("dead_lettered"), zero.alias("stored"), zero.alias("late"))
            new = fresh.agg(zero.alias("received"), zero.alias("dead_lettered"), n.alias("stored"), F.count_if("is_late").alias("late"))
            file_batch(came.unionByName(new), batch_id, f"{root}/counts", run)
        finally:
            fresh.unpersist()
            batch.unpersist()

    return sink


def run_complete_stream(src: DataFrame, content: DataFrame, root: str, checkpoint: str, *, order_col: str, scope: list[str] = (),
                        lateness_seconds: float = 30.0, as_of=None, **trigger_args) -> StreamingQuery:
    """One query that fills ``dead_letters``, ``events``, ``sessions``, ``windows`` and ``counts`` below ``root``.

    ``order_col`` (with ``scope``) is the arrival number used for the late flag. A redelivery counts as such if it
    carries the event's day, which copies do. Run it by ``meter.run_metered`` to count it on its way or to
    stop it after so many events.
    """
    sink = complete_sink(content, root, run_name(src.sparkSession, checkpoint), order_col, as_of, list(scope), lateness_seconds)
    return (judged(src, as_of).writeStream.foreachBatch(sink).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**(trigger_args or trigger())).start())


def stored_events(spark: SparkSession, root: str) -> DataFrame:
    return read_filed(spark, f"{root}/events")


def stored_dead_letters(spark: SparkSession, root: str) -> DataFrame:
    return read_filed(spark, f"{root}/dead_letters")


def stored_sessions(spark: SparkSession, root: str, content: DataFrame) -> DataFrame:
    """Sessions of all events so far."""
    return session_finish(session_merge(read_filed(spark, f"{root}/sessions")), content)


def stored_windows(spark: SparkSession, root: str) -> DataFrame:
    return tumbling_finish(tumbling_merge(read_filed(spark, f"{root}/windows")))


def stored_counts(spark: SparkSession, root: str) -> DataFrame:
    """One row: ``received``, ``dead_lettered``, ``stored`` and ``late`` (stored) events; what is left are ``redelivered``."""
    sums = read_filed(spark, f"{root}/counts").agg(*[F.sum(c).alias(c) for c in ("received", "dead_lettered", "stored", "late")])
    return sums.withColumn("redelivered", F.col("received") - F.col("dead_lettered") - F.col("stored"))
