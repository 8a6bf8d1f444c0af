"""Keyed table changes without a table format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.operators.staging import latest_by_key


def apply_changes(base: DataFrame, changes: DataFrame, keys: list[str], version: list[str], op: str = "op") -> DataFrame:
    """Newest version per key of base and change feed; deleted keys drop out.

    Applying a feed twice gives the same table. ``changes`` has the columns of
    ``base`` plus ``op`` (c, u, r or d).
    """
    rows = base.withColumn(op, F.lit("r")).unionByName(changes.select(*base.columns, op))
    return latest_by_key(rows, keys, version).where(F.col(op) != "d").drop(op)


def compact_changelog(log: DataFrame, key: str = "key", value: str = "value", version: list[str] = ("offset",)) -> DataFrame:
    """Last value per key; a null value is a tombstone and removes the key."""
    return latest_by_key(log, [key], list(version)).where(F.col(value).isNotNull())


def upsert(target: DataFrame, src: DataFrame, keys: list[str], version: list[str] | None = None) -> DataFrame:
    """Target with the rows of ``src`` replacing those of equal key."""
    new = latest_by_key(src, keys, version) if version else src
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new)


def insert_ignore(target: DataFrame, src: DataFrame, keys: list[str]) -> DataFrame:
    """Target plus the rows of ``src`` whose key is new; one row per new key."""
    fresh = src.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(latest_by_key(fresh, keys, []))


def kept(df: DataFrame) -> DataFrame:
    """Cache rows that are read several times.

    A micro-batch out of a session window claims an order by columns its plan no
    longer has, and caching such a plan fails; sorting each partition by a
    column it does have replaces that claim.
    """
    return df.sortWithinPartitions(df.columns[0]).persist()


def upsert_path(spark: SparkSession, path: str, src: DataFrame, keys: list[str], partitions: list[str],
                schema=None, version: list[str] | None = None) -> None:
    """Upsert into Parquet, rewriting only the partitions ``src`` touches.

    With ``version`` the newest row of a key stays, whether it is stored or new.
    A key must stay in its partition. The dynamic overwrite is staged by the
    committer, so a failed job leaves the old partitions in place.
    """
    src = kept(src)
    try:
        if exists(spark, path):
            reader = spark.read.schema(schema or src.schema)
            touched = src.select(*partitions).distinct()
            old = reader.parquet(path).join(touched, partitions, "left_semi")
            rows = upsert(old, src, keys) if version is None else old.select(*src.columns).unionByName(src)
        else:
            rows = src
        if version is not None:
            rows = latest_by_key(rows, keys, version)
        overwrite_partitions(rows, path, partitions)
    finally:
        src.unpersist()


def overwrite_partitions(df: DataFrame, path: str, partitions: list[str], codec: str = "zstd",
                         spread: list[Column] = ()) -> None:
    """Replace just the partitions present in ``df``."""
    if spread:
        df = df.repartition(*spread)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", codec)
     .partitionBy(*partitions).parquet(path))


def reload_table(df: DataFrame, path: str) -> None:
    """Truncate and load."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


BUCKET, DELETED = "_bucket", "_deleted"


def apply_changes_path(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], version: list[str],
                       op: str = "op", buckets: int = 64) -> None:
    """Apply a change feed to a Parquet table, rewriting only the key buckets it touches.

    Deleted keys stay as marked rows with their version, so a change delivered
    again or out of order cannot bring them back. Read with :func:`read_changed`.
    """
    marked = changes.withColumn(DELETED, F.col(op) == "d").drop(op)
    new = marked.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    new = kept(new)
    try:
        rows = new
        if exists(spark, path):
            touched = new.select(BUCKET).distinct()
            rows = spark.read.schema(new.schema).parquet(path).join(touched, BUCKET, "left_semi").unionByName(new)
        overwrite_partitions(latest_by_key(rows, keys, version), path, [BUCKET])
    finally:
        new.unpersist()


def read_changed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).where(~F.col(DELETED)).drop(DELETED, BUCKET)


def file_system(spark: SparkSession, path: str):
    """(Hadoop path, its file system)."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location, location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    location, fs = file_system(spark, path)
    return fs.exists(location)
