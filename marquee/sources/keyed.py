"""Tables kept by key: a change feed is merged into a bucketed, sorted table, and only the changes are shuffled.

A table is a series of versions in the catalog, ``name__v1``, ``name__v2`` and so on; the newest that is complete counts.
Buckets are made by the key's text and their number follows the table's size, so a merge reads the base where it lies.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.staging import latest_by_key
from marquee.sources.upsert import DELETED, file_system

KEY = "_key"
BUCKET_BYTES = 128 << 20
MAX_BUCKETS = 100_000


def versions(spark: SparkSession, name: str) -> list[int]:
    found = spark.sql(f"SHOW TABLES LIKE '{name}__v*'").collect()
    return sorted(int(m[1]) for r in found if (m := re.fullmatch(rf"{re.escape(name.lower())}__v(\d+)", r.tableName.lower())))


def current(spark: SparkSession, name: str) -> DataFrame | None:
    """The newest version with its marks of deleted keys."""
    known = versions(spark, name)
    return spark.table(f"{name}__v{known[-1]}") if known else None


def read_keyed(spark: SparkSession, name: str) -> DataFrame:
    """The rows that are not deleted."""
    return current(spark, name).where(~F.col(DELETED)).drop(DELETED, KEY)


def buckets_of(spark: SparkSession, name: str) -> int | None:
    known = versions(spark, name)
    if not known:
        return None
    rows = spark.sql(f"DESCRIBE EXTENDED {name}__v{known[-1]}").where("col_name = 'Num Buckets'").collect()
    return int(rows[0].data_type)


def wanted_buckets(spark: SparkSession, name: str) -> int:
    """As many as the newest version's bytes ask for."""
    location = spark.sql(f"DESCRIBE EXTENDED {name}__v{versions(spark, name)[-1]}").where("col_name = 'Location'").first().data_type
    path, fs = file_system(spark, location)
    return max(1, min(MAX_BUCKETS, math.ceil(fs.getContentSummary(path).getLength() / BUCKET_BYTES)))


def merged(base: DataFrame, news: DataFrame, version: list[str]) -> DataFrame:
    """Base and newest changes by key: of each key the row of the higher version, the change if both are equal."""
    columns = [c for c in base.columns if c != KEY]
    a, b = base.alias("a"), news.alias("b")
    order = lambda side: F.struct(*[F.col(f"{side}.{c}") for c in version])
    newer = F.col(f"b.{KEY}").isNotNull() & (F.col(f"a.{KEY}").isNull() | (order("b") >= order("a")))
    pick = lambda c: F.when(newer, F.col(f"b.{c}")).otherwise(F.col(f"a.{c}")).alias(c)
    return a.join(b, KEY, "full").select(F.coalesce(f"a.{KEY}", f"b.{KEY}").alias(KEY), *[pick(c) for c in columns])


def key_text(keys: list[str]) -> Column:
    """One text for the key columns, nulls included."""
    return F.to_json(F.struct(*keys))


def apply_keyed(spark: SparkSession, name: str, changes: DataFrame, keys: list[str], version: list[str], op: str = "op", buckets: int | None = None) -> int:
    """Merge a change feed into the table ``name``; returns the number of the version it made.

    ``changes``: the table's columns and ``op`` (c, u, r or d). The newest change of a key by ``version`` counts, and only if
    it is not older than the stored row. Deleted keys stay as marked rows, so old or repeated changes bring none back: the same
    feed may come again and in any order. A null key is a key. The merge joins the stored buckets in place and writes them anew; if
    the table has outgrown its buckets twofold, that one merge deals them anew. The version before the newest is
    kept for its readers, older ones go.
    """
    marked = changes.withColumn(DELETED, F.col(op) == "d").drop(op).withColumn(KEY, key_text(keys))
    news = latest_by_key(marked, [KEY], version)
    known, base = versions(spark, name), current(spark, name)
    if base is None:
        count, rows = buckets or 1, news
    else:
        count, rows = buckets_of(spark, name), merged(base, news.select(*base.columns), version)
        need = buckets or wanted_buckets(spark, name)
        count = need if need > 2 * count or (buckets and buckets != count) else count
    number = (known[-1] if known else 0) + 1
    (rows.repartition(count, KEY) if base is None or count != buckets_of(spark, name) else rows).write.format("parquet").mode("overwrite").bucketBy(
        count, KEY).sortBy(KEY).saveAsTable(f"{name}__v{number}")
    for old in known[:-1]:
        spark.sql(f"DROP TABLE IF EXISTS {name}__v{old}")
    return number


def keyed_sink(name: str, keys: list[str], version: list[str], op: str = "op"):
    """Every micro-batch of a change feed into a keyed table; a batch that comes again changes nothing."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        apply_keyed(batch.sparkSession, name, batch, keys, version, op)

    return sink
