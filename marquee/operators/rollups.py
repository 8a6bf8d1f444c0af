"""Hourly and daily rollups, exact and as mergeable partial states."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.functions.scalars import (
    UNITS_PER_SECOND, exact_avg, exact_sum, round_half_up, to_day, to_hour, to_units,
)
from marquee.operators.sessions import count_type


def content_hourly(events: DataFrame) -> DataFrame:
    """Plays, completions, seconds and viewers per title and hour."""
    return events.groupBy("content_id", to_hour(F.col("event_time")).alias("window_hour")).agg(
        count_type("video_play").alias("total_plays"),
        count_type("video_complete").alias("total_completions"),
        exact_sum(F.col("playback_seconds")).alias("total_watch_seconds"),
        F.countDistinct("user_id").alias("unique_viewers_count"),
    )


def platform_daily(events: DataFrame) -> DataFrame:
    """Events, plays, users and hours per day."""
    seconds = F.col("playback_seconds")
    return events.groupBy(to_day(F.col("event_time")).alias("metric_date")).agg(
        F.count(F.lit(1)).alias("total_events"),
        count_type("video_play").alias("total_plays"),
        F.countDistinct("user_id").alias("unique_active_users"),
        round_half_up(exact_sum(seconds) / 3600.0, 2).alias("total_watch_hours"),
        round_half_up(exact_avg(seconds) / 60.0, 2).alias("avg_session_minutes"),
    )


STATE = ("events", "plays", "completions", "watch_units", "watch_n")
# Grain of each rollup: how its key columns come from an event.
GRAINS = {
    "content_hourly": {"content_id": lambda: F.col("content_id"), "window_hour": lambda: to_hour(F.col("event_time"))},
    "platform_daily": {"metric_date": lambda: to_day(F.col("event_time"))},
}


def rollup_partial(events: DataFrame, grain: str) -> DataFrame:
    """Partial state of one slice of events: counts and unit sums for each key and user, so users merge exactly."""
    keys = [make().alias(name) for name, make in GRAINS[grain].items()]
    return events.groupBy(*keys, "user_id").agg(
        F.count(F.lit(1)).alias("events"),
        count_type("video_play").alias("plays"),
        count_type("video_complete").alias("completions"),
        F.sum(to_units(F.col("playback_seconds"))).alias("watch_units"),
        F.count("playback_seconds").alias("watch_n"),
    )


def rollup_merge(parts: DataFrame, grain: str) -> DataFrame:
    """Add partial states together; the result is again a partial state."""
    return parts.groupBy(*GRAINS[grain], "user_id").agg(*[F.sum(c).alias(c) for c in STATE])


def rollup_finish(state: DataFrame, grain: str) -> DataFrame:
    """Readable numbers from a merged state, which has one row per key and user."""
    state = state.groupBy(*GRAINS[grain]).agg(*[F.sum(c).alias(c) for c in STATE], F.count("user_id").alias("users"))
    seconds = F.col("watch_units") / F.lit(UNITS_PER_SECOND)
    users = F.col("users")
    if grain == "content_hourly":
        return state.select(
            "content_id", "window_hour", F.col("plays").alias("total_plays"),
            F.col("completions").alias("total_completions"), seconds.alias("total_watch_seconds"),
            users.alias("unique_viewers_count"),
        )
    return state.select(
        "metric_date", F.col("events").alias("total_events"), F.col("plays").alias("total_plays"),
        users.alias("unique_active_users"), round_half_up(seconds / 3600.0, 2).alias("total_watch_hours"),
        round_half_up(seconds / F.col("watch_n") / 60.0, 2).alias("avg_session_minutes"),
    )
