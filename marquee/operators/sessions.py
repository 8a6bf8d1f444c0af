"""Session tables built from playback events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.scalars import UNITS_PER_SECOND, as_time, completion_pct, exact_sum, minute_diff, to_units
from marquee.operators.staging import stg_playback_events
from marquee.sources.contracts import CONTRACTS

UNKNOWN_TITLE = "Unknown Title"
DEFAULT_DURATION = 7200
DEFAULT_PLAY_SECONDS = 30.0
DEFAULT_DEVICE = "smart_tv"
DEFAULT_VERSION = "1.0.0"


def count_type(name: str):
    return F.count_if(F.col("event_type") == name)


def watch_sessions(events: DataFrame, content: DataFrame, watch_mode: str = "sum") -> DataFrame:
    """One row per (user, session, title) over all its events.

    Events are aggregated before the catalog join, so the join sees sessions
    rather than events. ``watch_mode="max"`` reads ``playback_seconds`` as a
    running total instead of an increment.
    """
    seconds = F.col("playback_seconds")
    watched = exact_sum(seconds) if watch_mode == "sum" else F.max(seconds)
    grouped = events.groupBy("user_id", "session_id", "content_id").agg(
        F.min("device_type").alias("device_type"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
        watched.alias("total_watch_seconds"),
        count_type("video_pause").alias("pause_count"),
        count_type("video_seek").alias("seek_count"),
        F.max("position_seconds").alias("max_position_seconds"),
    )
    info = content.select("content_id", F.col("title").alias("content_title"), "duration_seconds")
    return grouped.join(info, "content_id", "left").select(
        "user_id", "session_id", "content_id", "content_title", "device_type", "session_start", "session_end",
        "total_watch_seconds", "pause_count", "seek_count",
        completion_pct(F.col("max_position_seconds"), F.col("duration_seconds")).alias("completion_percentage"),
        minute_diff(F.col("session_start"), F.col("session_end")).alias("session_duration_minutes"),
    )


def watch_partial(events: DataFrame, *by: str) -> DataFrame:
    """Mergeable state of :func:`watch_sessions` from some of the events, apart for each value of ``by``."""
    return events.groupBy(*by, "user_id", "session_id", "content_id").agg(
        F.min("device_type").alias("device_type"), F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"),
        F.sum(to_units(F.col("playback_seconds"))).alias("watch_units"), count_type("video_pause").alias("pause_count"),
        count_type("video_seek").alias("seek_count"), F.max("position_seconds").alias("max_position_seconds"))


def watch_merge(parts: DataFrame) -> DataFrame:
    """Add states together; the result is again a state."""
    sums = [F.sum(c).alias(c) for c in ("watch_units", "pause_count", "seek_count")]
    return parts.groupBy("user_id", "session_id", "content_id").agg(
        F.min("device_type").alias("device_type"), F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
        *sums, F.max("max_position_seconds").alias("max_position_seconds"))


def watch_finish(state: DataFrame, content: DataFrame) -> DataFrame:
    """The rows of :func:`watch_sessions` from a merged state."""
    info = content.select("content_id", F.col("title").alias("content_title"), "duration_seconds")
    return state.join(info, "content_id", "left").select(
        "user_id", "session_id", "content_id", "content_title", "device_type", "session_start", "session_end",
        (F.col("watch_units") / F.lit(UNITS_PER_SECOND)).alias("total_watch_seconds"), "pause_count", "seek_count",
        completion_pct(F.col("max_position_seconds"), F.col("duration_seconds")).alias("completion_percentage"),
        minute_diff(F.col("session_start"), F.col("session_end")).alias("session_duration_minutes"),
    )


def enrich_events(events: DataFrame, content: DataFrame) -> DataFrame:
    """Title and length of the watched item, with defaults for unknown ones."""
    info = content.select(
        "content_id", F.col("title").alias("_title"), F.col("duration_seconds").cast("double").alias("_duration")
    )
    return (
        events.join(info, "content_id", "left")
        .withColumns({
            "content_title": F.coalesce("_title", F.lit(UNKNOWN_TITLE)),
            "content_duration_seconds": F.coalesce("_duration", F.lit(float(DEFAULT_DURATION))),
        })
        .drop("_title", "_duration")
    )


def play_seconds(default: float = DEFAULT_PLAY_SECONDS):
    """Seconds that count as watched: those of play events only."""
    value = F.coalesce(F.col("playback_seconds"), F.lit(default))
    return F.when(F.col("event_type") == "video_play", value).otherwise(F.lit(0.0))


def session_measures() -> list:
    """Aggregates of one playback session; mergeable, so batch and stream share them."""
    first = F.struct("event_time", "event_id")
    return [
        F.min_by("content_id", first).alias("content_id"),
        F.coalesce(F.min_by("device_type", first), F.lit(DEFAULT_DEVICE)).alias("device_type"),
        F.coalesce(F.min_by("app_version", first), F.lit(DEFAULT_VERSION)).alias("app_version"),
        F.sum(to_units(play_seconds())).alias("watch_units"),
        count_type("video_pause").alias("pause_count"),
        count_type("video_seek").alias("seek_count"),
        F.max_by(F.struct("position_seconds", "content_duration_seconds"), first).alias("last"),
        F.min("event_time").alias("session_start"),
        F.max("event_time").alias("session_end"),
    ]


def finish_sessions(df: DataFrame, extra: list[str] = ()) -> DataFrame:
    duration = F.greatest(F.col("last.content_duration_seconds"), F.lit(1.0))
    position = F.coalesce(F.col("last.position_seconds"), F.lit(0.0))
    return df.select(
        "user_id", "session_id", *extra, "content_id", "device_type", "app_version",
        (F.col("watch_units") / F.lit(UNITS_PER_SECOND)).alias("watch_seconds"), "pause_count", "seek_count",
        completion_pct(position, duration).alias("completion_percentage"), "session_start", "session_end",
    )


def session_partial(events: DataFrame) -> DataFrame:
    """Mergeable state of sessions from some of their events; the catalog is not needed yet."""
    begin = F.struct("event_time", "event_id", "content_id", "device_type", "app_version")
    end = F.struct("event_time", "event_id", "content_id", "position_seconds")
    return events.groupBy("user_id", "session_id").agg(
        F.min(begin).alias("first"), F.max(end).alias("final"), F.sum(to_units(play_seconds())).alias("watch_units"),
        count_type("video_pause").alias("pause_count"), count_type("video_seek").alias("seek_count"),
        F.min("event_time").alias("session_start"), F.max("event_time").alias("session_end"))


def session_merge(parts: DataFrame) -> DataFrame:
    """Add states together; the result is again a state."""
    sums = [F.sum(c).alias(c) for c in ("watch_units", "pause_count", "seek_count")]
    return parts.groupBy("user_id", "session_id").agg(
        F.min("first").alias("first"), F.max("final").alias("final"), *sums,
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"))


def session_finish(state: DataFrame, content: DataFrame) -> DataFrame:
    """Session rows from a state: first title and device, progress in the last title."""
    info = content.select(F.col("content_id").alias("_title_id"), F.col("duration_seconds").cast("double").alias("_duration"))
    rows = state.join(info, F.col("final.content_id") == F.col("_title_id"), "left").select(
        "user_id", "session_id", F.col("first.content_id").alias("content_id"),
        F.coalesce("first.device_type", F.lit(DEFAULT_DEVICE)).alias("device_type"),
        F.coalesce("first.app_version", F.lit(DEFAULT_VERSION)).alias("app_version"), "watch_units", "pause_count", "seek_count",
        F.struct(F.col("final.position_seconds").alias("position_seconds"),
                 F.coalesce("_duration", F.lit(float(DEFAULT_DURATION))).alias("content_duration_seconds")).alias("last"),
        "session_start", "session_end")
    return finish_sessions(rows)


def play_sessions(events: DataFrame, content: DataFrame) -> DataFrame:
    """One row per (user, session): play time, pauses, seeks and last progress."""
    return session_finish(session_partial(events), content)


def tumbling_metrics(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """Events, plays and play seconds per window and title."""
    return tumbling_finish(tumbling_partial(events, width))


def tumbling_partial(events: DataFrame, width: str = "1 minute") -> DataFrame:
    """Mergeable state of the windows that some events fall into."""
    return events.groupBy(F.window("event_time", width).alias("w"), "content_id").agg(
        F.count(F.lit(1)).alias("events_count"), count_type("video_play").alias("plays"),
        F.sum(to_units(play_seconds(0.0))).alias("watch_units"),
    ).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "content_id", "events_count", "plays", "watch_units")


def tumbling_merge(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("events_count", "plays", "watch_units")]
    return parts.groupBy("window_start", "window_end", "content_id").agg(*sums)


def tumbling_finish(state: DataFrame) -> DataFrame:
    return state.withColumn("watch_seconds", F.col("watch_units") / F.lit(UNITS_PER_SECOND)).drop("watch_units")


def late_flag(df: DataFrame, order_col: str, lateness_seconds: float = 30.0, scope: list[str] = (),
              ts: str = "event_time", chunk_rows: int = 1_000_000, start: DataFrame | None = None) -> DataFrame:
    """Add ``is_late``: event time below the running maximum minus the lateness.

    ``order_col`` is the arrival number within ``scope`` (a stream offset).
    Arrival numbers are cut into chunks; the maximum before each chunk comes
    from a small table of chunk maxima, the one inside it from a window over
    that chunk alone. No task ever holds more than one chunk, however uneven
    the scopes are. ``start`` gives each scope's maximum before the first row
    (scope columns, ``high_mark``).
    """
    scope = list(scope)
    chunked = df.withColumn("_chunk", F.floor(F.col(order_col) / F.lit(chunk_rows)).cast("bigint"))
    chunk_max = chunked.groupBy(*scope, "_chunk").agg(F.max(ts).alias("_m"))
    # chunk maxima are themselves summed up in blocks before the last running maximum
    block = F.floor(F.col("_chunk") / F.lit(100_000)).cast("bigint")
    before = Window.partitionBy(*scope, "_block").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = chunk_max.withColumn("_block", block)
    block_max = blocks.groupBy(*scope, "_block").agg(F.max("_m").alias("_bm"))
    across = Window.partitionBy(*scope).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    block_prev = block_max.select(*scope, "_block", F.max("_bm").over(across).alias("_bprev"))
    prefix = (
        blocks.withColumn("_cprev", F.max("_m").over(before))
        .join(block_prev, [*scope, "_block"])
        .select(*scope, "_chunk", F.greatest("_cprev", "_bprev").alias("_prev"))
    )
    if start is not None:
        if scope:
            given = prefix.join(start, scope, "left")
        else:
            given = prefix.withColumn("high_mark", start.agg(F.max("high_mark")).scalar())
        prefix = given.withColumn("_prev", F.greatest("_prev", "high_mark")).drop("high_mark")
    inside = Window.partitionBy(*scope, "_chunk").orderBy(order_col, ts).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.greatest(F.max(ts).over(inside), F.col("_prev"))
    limit = F.expr(f"INTERVAL {lateness_seconds} SECONDS")
    return (
        chunked.join(prefix, [*scope, "_chunk"], "left")
        .withColumn("is_late", F.col(ts) < seen - limit)
        .drop("_chunk", "_prev")
    )


def silver_playback(events: DataFrame, content: DataFrame, as_of, order_col: str,
                    lateness_seconds: float = 30.0, scope: list[str] = ()) -> DataFrame:
    """Clean events with catalog data, progress of each event and the late flag."""
    arrival = [c for c in (order_col, *scope) if c not in CONTRACTS["playback"].fields]
    clean = stg_playback_events(events, as_of, keep=arrival)
    rich = enrich_events(late_flag(clean, order_col, lateness_seconds, scope), content)
    progress = completion_pct(F.col("position_seconds"), F.greatest("content_duration_seconds", F.lit(1.0)))
    return rich.select(
        "event_id", "event_type", "user_id", "session_id", "device_id", "device_type", "app_version", "content_id",
        "content_title", F.col("content_duration_seconds").cast("int").alias("content_duration_seconds"),
        "position_seconds", "playback_seconds", progress.alias("completion_percentage"),
        F.col("is_late").alias("is_late_arriving"), "event_time", as_time(as_of).alias("processed_time"),
    )
