"""Playback streams: validation, dedup, late flags, sessions, windows, archive."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.functions.scalars import to_units
from marquee.operators.rollups import GRAINS
from marquee.operators.sessions import (
    count_type, enrich_events, finish_sessions, late_flag, session_measures, tumbling_metrics,
)
from marquee.operators.staging import event_instant, split_valid, stg_playback_events, to_dlq, validate_events
from marquee.sources.contracts import CONTRACTS
from marquee.sources.lake import LAKE_PARTITIONS, file_lake, lake_columns
from marquee.sources.upsert import exists, file_system, kept, overwrite_partitions
from marquee.streaming.sinks import BATCH, RUN, current_run, foreach_batch_sink, write_batch

LATENESS = "30 seconds"
SESSION_TIMEOUT = "30 minutes"
OUTPUTS = ("dead_letters", "events", "sessions", "windows")


def typed(df: DataFrame) -> DataFrame:
    """Text times as timestamps, which watermarks need."""
    return df.withColumns({c: event_instant(df, c) for c in ("event_time", "ingestion_time") if c in df.columns})


def stream_split(df: DataFrame, as_of: Column | str | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, invalid) branches of an event stream."""
    now = F.current_timestamp() if as_of is None else as_of
    return split_valid(validate_events(df, now))


def stream_dedup(df: DataFrame, lateness: str = LATENESS, key: str = "event_id") -> DataFrame:
    """First delivery per event within the watermark; older ids leave the state."""
    return df.withWatermark("event_time", lateness).dropDuplicatesWithinWatermark([key])


def stream_sessions(events: DataFrame, content: DataFrame, timeout: str = SESSION_TIMEOUT) -> DataFrame:
    """Final rows of idle sessions, for append mode.

    Needs a watermark on ``event_time``. A session id idle for longer than the
    timeout yields several segments; :func:`merge_segments` adds them up.
    """
    rich = enrich_events(events, content)
    keys = ["user_id", "session_id", F.session_window("event_time", timeout).alias("w")]
    return rich.groupBy(*keys).agg(*session_measures()).select(
        "user_id", "session_id", F.col("w.start").alias("segment_start"), "content_id", "device_type", "app_version",
        "watch_units", "pause_count", "seek_count", "last", "session_start", "session_end")


def merge_segments(segments: DataFrame) -> DataFrame:
    """Session rows from segments: sums, first attributes, last progress."""
    first = F.col("segment_start")
    merged = segments.groupBy("user_id", "session_id").agg(
        F.min_by("content_id", first).alias("content_id"), F.min_by("device_type", first).alias("device_type"),
        F.min_by("app_version", first).alias("app_version"), F.sum("watch_units").alias("watch_units"),
        F.sum("pause_count").alias("pause_count"), F.sum("seek_count").alias("seek_count"),
        F.max_by("last", first).alias("last"), F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"))
    return finish_sessions(merged)


def stream_rollup(events: DataFrame, grain: str) -> DataFrame:
    """Hourly title or daily platform rollup as a stream of states, one for each key and user."""
    width = {"content_hourly": "1 hour", "platform_daily": "1 day"}[grain]
    keys = [F.window("event_time", width).alias("w")] + [F.col(c) for c in GRAINS[grain] if c == "content_id"] + [F.col("user_id")]
    state = events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("events"), count_type("video_play").alias("plays"),
        count_type("video_complete").alias("completions"), F.sum(to_units(F.col("playback_seconds"))).alias("watch_units"),
        F.count("playback_seconds").alias("watch_n"))
    start = F.col("w.start")
    made = {"content_id": F.col("content_id"), "window_hour": start, "metric_date": F.to_date(start)}
    return state.select(*[made[c].alias(c) for c in GRAINS[grain]], "user_id", "events", "plays", "completions", "watch_units", "watch_n")


def stream_content_hourly(events: DataFrame) -> DataFrame:
    return stream_rollup(events, "content_hourly")


def stream_platform_daily(events: DataFrame) -> DataFrame:
    return stream_rollup(events, "platform_daily")


def late_flag_sink(root: str, lateness_seconds: float, order_col: str, scope: list[str],
                   write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Flag late events of each batch against the largest time seen so far per scope.

    The running maxima of all earlier batches are a tiny table (one row per
    scope) kept per batch number, so a repeated batch starts from the same state.
    """
    path = f"{root}/high_marks"

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = kept(batch)
        try:
            marks = None
            if exists(spark, path):
                if batch.isEmpty():  # a batch that only clears the state; reading it did
                    return
                past = spark.read.parquet(path).where((F.col(RUN) == current_run(spark)) & (F.col(BATCH) < batch_id))
                marks = past.groupBy(*scope).agg(F.max("high_mark").alias("high_mark"))
            high = batch.groupBy(*scope).agg(F.max("event_time").alias("high_mark"))
            flagged = late_flag(batch, order_col, lateness_seconds, scope, start=marks)
            write(flagged, batch_id)
            write_batch(high, batch_id, path)
        finally:
            batch.unpersist()

    return sink


def trigger(interval: str | None = "2 seconds", available_now: bool = False) -> dict:
    """Arguments of ``DataStreamWriter.trigger``.

    The size of a batch is set on the source: ``maxFilesPerTrigger`` or
    ``maxOffsetsPerTrigger``.
    """
    return {"availableNow": True} if available_now else {"processingTime": interval}


def run_until(queries: list[StreamingQuery], seconds: float | None = None) -> bool:
    """Wait for the queries, at most ``seconds``; stops them then. True if all ended by themselves."""
    ended = True
    for q in queries:
        done = q.awaitTermination(seconds) if seconds is not None else (q.awaitTermination() or True)
        if not done:
            ended = False
            q.stop()
    return ended


def write_lake_stream(df: DataFrame, root: str, checkpoint: str, topic: str = "topic", writers: int | None = None,
                      **trigger_args) -> StreamingQuery:
    """Archive a stream by category, day and hour, next to what :func:`write_lake` and other streams add.

    Every batch has files of its own in the folders it reaches, named by run and batch: tried again it
    replaces them. Without ``writers`` every task writes its own files, which costs no shuffle;
    with it the rows of one folder meet in that many tasks, which gives fewer files.
    """
    filed = lake_columns(df, F.current_timestamp(), topic)
    if writers is not None:
        filed = filed.repartition(*LAKE_PARTITIONS, F.pmod(F.xxhash64("event_id"), F.lit(writers)))

    def sink(batch: DataFrame, batch_id: int) -> None:
        file_lake(batch, root, f"{current_run(batch.sparkSession)}-{batch_id}")

    return (filed.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger_args or trigger())).start())


def run_playback_stream(src: DataFrame, content: DataFrame, root: str, checkpoint: str, *, lateness: str = LATENESS,
                        lateness_seconds: float = 30.0, timeout: str = SESSION_TIMEOUT, as_of=None,
                        order_col: str | None = None, scope: list[str] = (), outputs: tuple[str, ...] = OUTPUTS,
                        **trigger_args) -> dict[str, StreamingQuery]:
    """The whole playback stream as four queries with a checkpoint each, or those named in ``outputs``.

    Rows are final once the watermark has passed them, and events behind it are left out:
    ``complete.run_complete_stream`` keeps, flags and counts those.

    dead_letters: invalid events. events: valid first deliveries with title and
    late flag. sessions: segments of idle sessions. windows: minute metrics.
    ``src`` holds decoded playback events; ``order_col`` (with ``scope``) is the
    arrival number used for late flags.
    """
    args = trigger_args or trigger()
    now = F.current_timestamp() if as_of is None else as_of
    ok, bad = stream_split(src, as_of)
    clean = stream_dedup(typed(ok), lateness)

    def start(name: str, df: DataFrame, sink) -> StreamingQuery:
        return (df.writeStream.queryName(name).foreachBatch(sink).outputMode("append")
                .option("checkpointLocation", f"{checkpoint}/{name}").trigger(**args).start())

    def write_events(batch: DataFrame, batch_id: int) -> None:
        write_batch(enrich_events(batch, content), batch_id, f"{root}/events")

    event_sink = write_events
    if order_col is not None:
        event_sink = late_flag_sink(root, lateness_seconds, order_col, list(scope), write_events)
    same = lambda name: foreach_batch_sink({name: lambda d: d}, root)
    tables = {
        "dead_letters": (to_dlq(bad, now), same("dead_letters")),
        "events": (clean, event_sink),
        "sessions": (stream_sessions(clean, content, timeout), same("sessions")),
        "windows": (tumbling_metrics(clean), same("windows")),
    }
    return {name: start(name, *tables[name]) for name in outputs}


def reconcile(spark: SparkSession, lake_root: str, dates: list[str], models: dict[str, Callable[[DataFrame], DataFrame]],
              out_root: str, as_of, day: str = "metric_date") -> None:
    """Rebuild daily models of some days from the lake, late events included.

    Every model maps clean events to rows with a ``day`` column; only the
    partitions of the given days are replaced, and removed if nothing is left.
    The days before and after are read too, so sessions across midnight stay whole.
    """
    around = sorted({(date.fromisoformat(d) + timedelta(days=n)).isoformat() for d in dates for n in (-1, 0, 1)})
    lake = spark.read.parquet(lake_root).where((F.col("category") == "playback") & F.col("date").cast("string").isin(around))
    events = stg_playback_events(typed(lake).select(*CONTRACTS["playback"].fields), as_of).persist()
    try:
        for name, build in models.items():
            rows = build(events).where(F.col(day).cast("string").isin(dates))
            overwrite_partitions(rows, f"{out_root}/{name}", [day])
            filled = {str(r[0]) for r in rows.select(day).distinct().collect()}  # at most the given days
            for emptied in set(dates) - filled:
                location, fs = file_system(spark, f"{out_root}/{name}/{day}={emptied}")
                fs.delete(location, True)
    finally:
        events.unpersist()

