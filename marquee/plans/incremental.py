"""The daily batch without its history: only days whose files changed, and what follows from them, are computed again.

Events are kept by day (``event_day``). A day is known by a fingerprint of its files' names, sizes and
times, so nothing is read to find the changed ones. From the events of a changed day come additive states; sessions, activity and
marts are rebuilt for the days that these can reach, out of states and small tables of the neighbouring days.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from marquee.functions.scalars import to_day
from marquee.operators.rollups import rollup_finish, rollup_merge, rollup_partial
from marquee.operators.sessions import watch_finish, watch_merge, watch_partial
from marquee.operators.staging import stg_playback_events
from marquee.plans import marts
from marquee.sources.upsert import exists, file_system, overwrite_partitions

DAY = "event_day"
ROLLING_DAYS = 7
GRAINS = {"rollup_content_hourly": "content_hourly", "rollup_platform_daily": "platform_daily"}


def write_events(events: DataFrame, root: str) -> None:
    """Append raw events by the day of their time; a null time has no day and is filed apart."""
    rows = events.withColumn(DAY, F.to_date("event_time"))
    rows.hint("rebalance", DAY).write.mode("append").partitionBy(DAY).parquet(root)


def fingerprints(spark: SparkSession, root: str) -> DataFrame:
    """(day, files, bytes, print) from the listing alone; no file is opened."""
    if not exists(spark, root):
        return spark.createDataFrame([], "day string, files bigint, bytes bigint, print bigint")
    listed = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(root)
              .select(F.regexp_extract("path", f"{DAY}=([^/]+)/", 1).alias("day"), F.regexp_extract("path", "([^/]+)$", 1).alias("name"), "length", "modificationTime"))
    # sums of hashes do not depend on the order of the listing
    one = F.xxhash64("name", "length", "modificationTime") % F.lit(1 << 40)
    return listed.groupBy("day").agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(one).alias("print"))


def changed_days(now: DataFrame, before: DataFrame | None) -> list[str]:
    """Days that are new, gone or have other files; days are few, so their names are brought to the driver."""
    if before is None:
        days = now.select("day")
    else:
        old = before.select("day", F.struct("files", "bytes", "print").alias("old"))
        both = now.select("day", F.struct("files", "bytes", "print").alias("new")).join(old, "day", "full")
        days = both.where(~F.col("new").eqNullSafe(F.col("old"))).select("day")
    return sorted(r[0] for r in days.collect() if r[0] and not r[0].startswith("__"))


def around(days: list[str], back: int, ahead: int) -> list[str]:
    """The days with those up to ``back`` before and ``ahead`` after them."""
    known = {date.fromisoformat(d) for d in days}
    return sorted({(d + timedelta(days=n)).isoformat() for d in known for n in range(-back, ahead + 1)})


def read_days(spark: SparkSession, root: str, days: list[str]) -> DataFrame | None:
    """The rows of some days; other folders are not even listed."""
    folders = [f for f in (f"{root}/{DAY}={d}" for d in days) if exists(spark, f)]
    return spark.read.option("basePath", root).parquet(*folders).drop(DAY) if folders else None


def replace_days(rows: DataFrame | None, root: str, days: list[str], day: str) -> None:
    """Put ``rows`` in place of what ``days`` held; ``day`` is their column. A day without rows loses its folder, after the write."""
    filled = set()
    if rows is not None:
        seen = Observation()
        filed = rows.withColumn(DAY, F.col(day).cast("date")).drop(*[c for c in rows.columns if c.startswith("_")])
        filed = filed.hint("rebalance", DAY).observe(seen, F.collect_set(F.col(DAY).cast("string")).alias("days"))
        overwrite_partitions(filed, root, [DAY])
        filled = set(seen.get["days"])
        spark = rows.sparkSession
        for empty in sorted(set(days) - filled):
            drop_day(spark, root, empty)


def drop_day(spark: SparkSession, root: str, day: str) -> None:
    location, fs = file_system(spark, f"{root}/{DAY}={day}")
    fs.delete(location, True)


def refresh(spark: SparkSession, events_root: str, root: str, content: DataFrame, as_of, span_days: int = 1) -> dict[str, list[str]]:
    """Bring all tables below ``root`` up to the events; returns the days read or rebuilt, by table.

    Tables by day: ``session_parts`` and the states of the rollups (by event day), ``int_watch_sessions``,
    ``int_daily_user_activity``, ``int_content_engagement``, ``mart_daily_platform_metrics`` (by the session's first day) and
    ``mart_content_performance`` (rolling over calendar days).

    ``span_days``: no session has events further apart than so many days; sessions that start within it of
    a changed day are merged again from the parts of twice that span. Copies of an event must carry its day. A changed catalog
    or ``as_of`` is not seen by fingerprints: start with an empty ``root`` then. The new fingerprints are written last, so a
    failed run is repeated as a whole.
    """
    now, marks = fingerprints(spark, events_root), f"{root}/fingerprints"
    days = changed_days(now, spark.read.parquet(marks) if exists(spark, marks) else None)
    if not days:
        return {}
    told = now.collect()  # a row per day

    def renew(name: str, source: DataFrame | None, build: Callable[[DataFrame], DataFrame], at: list[str], day: str) -> None:
        if source is None:  # no day left: all of them go
            for d in at:
                drop_day(spark, f"{root}/{name}", d)
        else:
            replace_days(build(source), f"{root}/{name}", at, day)

    raw = read_days(spark, events_root, days)
    # three tables come from the clean events, so they are ordered by id and freed of copies once
    events = None if raw is None else stg_playback_events(raw, as_of).withColumn("_day", F.to_date("event_time")).persist()
    try:
        renew("session_parts", events, lambda e: watch_partial(e, "_day"), days, "_day")
        renew("rollup_content_hourly", events, lambda e: rollup_partial(e, "content_hourly"), days, "window_hour")
        renew("rollup_platform_daily", events, lambda e: rollup_partial(e, "platform_daily"), days, "metric_date")
    finally:
        if events is not None:
            events.unpersist()

    starts = around(days, span_days, span_days)
    merged = lambda parts: watch_finish(watch_merge(parts), content).withColumn("_day", to_day(F.col("session_start"))).where(
        F.col("_day").cast("string").isin(starts))
    renew("int_watch_sessions", read_days(spark, f"{root}/session_parts", around(days, 2 * span_days, 2 * span_days)), merged, starts, "_day")
    fresh = read_days(spark, f"{root}/int_watch_sessions", starts)
    renew("int_daily_user_activity", fresh, marts.daily_user_activity, starts, "activity_date")
    renew("int_content_engagement", fresh, marts.content_engagement, starts, "engagement_date")
    activity = read_days(spark, f"{root}/int_daily_user_activity", starts)
    renew("mart_daily_platform_metrics", activity, marts.daily_platform_metrics, starts, "metric_date")
    rolling = around(starts, 0, ROLLING_DAYS - 1)
    window = read_days(spark, f"{root}/int_content_engagement", around(rolling, ROLLING_DAYS - 1, 0))
    rolled = lambda e: marts.content_performance(e, content, range_days=ROLLING_DAYS).where(
        F.col("engagement_date").cast("string").isin(rolling))
    renew("mart_content_performance", window, rolled, rolling, "engagement_date")
    spark.createDataFrame(told, now.schema).coalesce(1).write.mode("overwrite").parquet(marks)
    return {"events": days, "int_watch_sessions": starts, "mart_content_performance": rolling}


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of :func:`refresh`; rollups are finished from their states."""
    df = spark.read.parquet(f"{root}/{name}").drop(DAY)
    return rollup_finish(rollup_merge(df, GRAINS[name]), GRAINS[name]) if name in GRAINS else df
