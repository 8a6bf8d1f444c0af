"""Validation, staging projections and latest-version selection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.scalars import PLAYBACK_TOPIC, as_time, parse_event_time, shift
from marquee.session import cut_lineage
from marquee.sources.contracts import CONTRACTS, CORRUPT

PLAYBACK_TYPES = list(CONTRACTS["playback"].event_types)
FUTURE_HOURS = 2


def event_instant(df: DataFrame, column: str = "event_time") -> Column:
    """The event time as a timestamp, whether it arrives as text or typed."""
    kind = df.schema[column].dataType.typeName()
    return parse_event_time(F.col(column)) if kind == "string" else F.col(column).cast("timestamp")


def validate_events(df: DataFrame, as_of, contract: str = "playback") -> DataFrame:
    """Add ``failure_reason``: the first rule an event breaks, else null."""
    spec = CONTRACTS[contract]
    when = event_instant(df)
    kind = F.coalesce(F.col("event_type").cast("string"), F.lit(""))
    shown = F.coalesce(F.col("event_time").cast("string"), F.lit(""))
    # The reasons written to the dead-letter table.
    rules = []
    if CORRUPT in df.columns:
        rules.append((F.col(CORRUPT).isNotNull(), F.lit("Payload is not a valid JSON dictionary")))
    for name in spec.required:
        empty = F.coalesce(F.col(name).cast("string"), F.lit("")) == ""
        rules.append((empty, F.lit(f"Missing required field: '{name}'")))
    rules.append((~kind.isin(*spec.event_types), F.concat(F.lit("Invalid event_type: '"), kind, F.lit("'"))))
    rules.append((when.isNull(), F.concat(F.lit("Invalid event_time format: "), shown)))
    too_late = shift(as_time(as_of), hours=FUTURE_HOURS)
    rules.append((when > too_late, F.concat(F.lit("Event timestamp is too far in future: "), shown)))
    reason = F.coalesce(*[F.when(broken, text) for broken, text in rules])
    return df.withColumn("failure_reason", reason)


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason, invalid rows with it)."""
    ok = df.where(F.col("failure_reason").isNull()).drop("failure_reason")
    return ok, df.where(F.col("failure_reason").isNotNull())


def to_dlq(invalid: DataFrame, as_of, source_topic: str = PLAYBACK_TOPIC) -> DataFrame:
    """Dead-letter records: the failed event as JSON, why, when and from where."""
    event = [c for c in invalid.columns if c not in ("failure_reason", CORRUPT)]
    payload = F.to_json(F.struct(*event))
    if CORRUPT in invalid.columns:
        payload = F.coalesce(F.col(CORRUPT), payload)
    return invalid.select(
        payload.alias("failed_event"),
        "failure_reason",
        as_time(as_of).alias("failed_at"),
        F.lit(source_topic).alias("source_topic"),
    )


def top_k(df: DataFrame, group: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First ``k`` rows of every group.

    ``row_number() <= k`` lets Spark keep only k rows per group and map task
    before the shuffle, so a group holding a third of all rows stays harmless.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w).cast("bigint")).where(F.col(rank) <= k)


def dense_rank_by_range(df: DataFrame, group: str, value: str, rank: str = "rank", ranges: int | None = None) -> DataFrame:
    """Dense rank by falling ``value`` within ``group`` without a task per group.

    The distinct values are dealt by ranges of (group, value), numbered inside each range, and moved on by the number
    of values in the earlier ranges of their group, a table of a row per range and group. Rows get the rank of their value by a
    join, which Spark splits where a value is frequent. Nulls rank last, a null group is a group.
    """
    values = df.select(group, value).distinct()
    dealt = [F.col(group).asc(), F.col(value).desc_nulls_last()]
    by_range = values.repartitionByRange(ranges, *dealt) if ranges else values.repartitionByRange(*dealt)
    placed = cut_lineage(by_range.withColumn("_range", F.spark_partition_id()))  # the ranges must not be drawn anew
    inside = Window.partitionBy("_range", group).orderBy(F.col(value).desc_nulls_last())
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_n"))
    moved = sizes.select("_range", F.col(group).alias("_g"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = placed.withColumn("_at", F.row_number().over(inside))
    ranked = local.join(moved, (local["_range"] == moved["_range"]) & local[group].eqNullSafe(moved["_g"])).select(
        F.col("_g"), F.col(value).alias("_v"), (F.col("_at") + F.col("_before")).cast("bigint").alias(rank))
    return df.join(ranked, df[group].eqNullSafe(ranked["_g"]) & df[value].eqNullSafe(ranked["_v"])).drop("_g", "_v")


def row_hash(df: DataFrame) -> Column:
    """Tie-break that does not depend on arrival order."""
    return F.xxhash64(*df.columns)


def latest_by_key(df: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """Newest version of every key."""
    order = [F.col(v).desc() for v in version] + [row_hash(df)]
    return top_k(df, keys, order, 1, "_n").drop("_n")


def stg_playback_events(raw: DataFrame, as_of, keep: list[str] = ()) -> DataFrame:
    """Usable playback events, one per ``event_id``: the last ingested delivery.

    ``keep`` names further columns to carry along.

    The filter comes first on purpose: it decides which delivery survives.
    """
    usable = raw.where(
        (F.col("content_id") != "")
        & F.col("event_type").isin(PLAYBACK_TYPES)
        & (F.col("event_time") <= shift(as_time(as_of), hours=FUTURE_HOURS))
    )
    return latest_by_key(usable, ["event_id"], ["ingestion_time"]).select(*CONTRACTS["playback"].fields, *keep)


def has_click(selected: Column) -> Column:
    return F.when(F.coalesce(selected, F.lit("")) != "", F.lit(1)).otherwise(F.lit(0))


def stg_search_events(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "user_id", "session_id", "device_id", "query_text", "results_count",
        "selected_content_id", has_click(F.col("selected_content_id")).alias("has_click"),
        "event_time", "ingestion_time",
    )


def fact_searches(raw: DataFrame) -> DataFrame:
    return raw.select(
        "event_id", "user_id", "session_id", "device_type", "query_text", "results_count",
        "selected_content_id", has_click(F.col("selected_content_id")).alias("has_click"), "event_time",
    )


def fact_content_engagement(events: DataFrame) -> DataFrame:
    return events.select(
        "content_id", "user_id", "device_type", "event_type", "position_seconds", "playback_seconds", "event_time"
    )


def stg_content(content: DataFrame) -> DataFrame:
    return content.select(
        "content_id", "title", "genres", "language", "release_year", "director", "duration_seconds", "maturity_rating"
    )


def stg_users(events: DataFrame) -> DataFrame:
    """First and last sighting of every user, device type and app version."""
    return events.groupBy("user_id", "device_type", "app_version").agg(
        F.date_trunc("second", F.min("event_time")).alias("first_seen_at"),
        F.date_trunc("second", F.max("event_time")).alias("last_seen_at"),
    )


def apply_ttl(df: DataFrame, ts: str, days: int, as_of) -> DataFrame:
    """Rows not older than ``days``."""
    return df.where(F.col(ts) > shift(as_time(as_of), days=-days))


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
