"""Parquet lake: raw archive by category, day and hour, and the medallion tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.scalars import category_of, partition_time
from marquee.operators.staging import event_instant
from marquee.sources.upsert import exists, kept, overwrite_partitions, upsert_path

LAKE_PARTITIONS = ["category", "date", "hour"]
# who wrote a file: one batch of a stream, or one call
WRITER = "written_by"
# hour of the categories that are filed by day only
NO_HOUR = "all"


def lake_columns(df: DataFrame, as_of, topic: str = "topic") -> DataFrame:
    """Add category, date and hour; only playback is filed by the hour."""
    event, arrival = event_instant(df, "event_time"), event_instant(df, "ingestion_time")
    when = partition_time(event, arrival, as_of)
    category = category_of(F.col(topic))
    return df.withColumns({
        "category": category,
        "date": F.date_format(when, "yyyy-MM-dd"),
        "hour": F.when(category == "playback", F.date_format(when, "HH")).otherwise(F.lit(NO_HOUR)),
    })


def write_lake(df: DataFrame, root: str, as_of, topic: str = "topic", writer: str | None = None) -> None:
    """Add to the archive; with the name of an earlier ``writer`` its files in the folders reached are replaced.

    The rebalance hint brings the rows of one folder together and splits the
    folders of busy hours, so files are neither tiny nor written by one task.
    """
    filed = lake_columns(df, as_of, topic)
    file_lake(filed.hint("rebalance", *LAKE_PARTITIONS), root, writer or f"batch-{uuid.uuid4().hex}")


def file_lake(filed: DataFrame, root: str, writer: str) -> None:
    """Write filed rows under their writer's name, below category, day and hour."""
    rows = filed.withColumn(WRITER, F.lit(writer))
    (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
     .partitionBy(*LAKE_PARTITIONS, WRITER).parquet(root))


def read_lake(spark: SparkSession, root: str, date: str, category: str | None = None, schema=None) -> DataFrame:
    """Records of one day; the filters prune folders."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(root).where(F.col("date") == F.lit(date)).drop(WRITER)
    if category is not None:
        df = df.where(F.col("category") == category)
    # folder names made of digits are read as numbers; hours are text
    hour = F.col("hour").cast("string")
    return df.withColumn("hour", F.when(hour == NO_HOUR, hour).otherwise(F.lpad(hour, 2, "0")))


def write_bronze(events: DataFrame, root: str) -> None:
    """Raw events by day and hour."""
    ts = F.col("event_time")
    rows = events.withColumns({"event_day": F.to_date(ts), "event_hour": F.hour(ts)})
    (rows.hint("rebalance", "event_day", "event_hour").write.mode("append").option("compression", "zstd")
     .partitionBy("event_day", "event_hour").parquet(root))


def write_silver(silver: DataFrame, root: str) -> None:
    """Upsert of clean events by event id within their day."""
    rows = silver.withColumn("event_day", F.to_date("event_time"))
    upsert_path(silver.sparkSession, root, rows, ["event_id"], ["event_day"])


def write_gold(mart: DataFrame, root: str) -> None:
    """Daily mart by month; the days written replace their former rows."""
    spark = mart.sparkSession
    rows = kept(mart.withColumn("metric_month", F.date_format("metric_date", "yyyy-MM")))
    try:
        whole = rows
        if exists(spark, root):
            old = spark.read.schema(rows.schema).parquet(root).join(rows.select("metric_month").distinct(), "metric_month", "left_semi")
            whole = old.join(rows.select("metric_date").distinct(), "metric_date", "left_anti").unionByName(rows)
        overwrite_partitions(whole, root, ["metric_month"])
    finally:
        rows.unpersist()


def sorted_playback(events: DataFrame, root: str) -> None:
    """Raw playback table by month, sorted for min/max skipping on type, user and time."""
    rows = events.withColumn("month", F.date_format("event_time", "yyyyMM"))
    (rows.hint("rebalance", "month").sortWithinPartitions("month", "event_type", "user_id", "event_time")
     .write.mode("append").partitionBy("month").parquet(root))


def read_playback(spark: SparkSession, root: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Events of a time span from :func:`sorted_playback`; the span also prunes months."""
    df = spark.read.parquet(root)
    month = F.col("month").cast("string")
    if since is not None:
        df = df.where((F.col("event_time") >= F.lit(since).cast("timestamp")) & (month >= since[:7].replace("-", "")))
    if until is not None:
        df = df.where((F.col("event_time") < F.lit(until).cast("timestamp")) & (month <= until[:7].replace("-", "")))
    return df.drop("month")
