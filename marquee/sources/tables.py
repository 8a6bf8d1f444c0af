"""Relational and document sources, and the dimensions made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, path: str | None = None, fmt: str = "parquet", **options: str) -> DataFrame:
    """A table from files, or by ``fmt="jdbc"`` with the usual options (url, dbtable, partitionColumn …)."""
    reader = spark.read.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


# Defaults of catalog documents and devices.
DOCUMENT_DEFAULTS = {
    "title": "Untitled", "genres": ["General"], "language": "en", "release_year": 2024, "director": "Unknown",
    "duration_seconds": 5400, "maturity_rating": "U/A 13+",
}
DEVICE_DEFAULTS = {"os": "Unknown", "app_version": "1.0.0"}

DOCUMENT_DDL = (
    "content_id string, title string, genres array<string>, language string, release_year int, director string,"
    " duration_seconds int, maturity_rating string"
)


def read_documents(spark: SparkSession, path: str, ddl: str = DOCUMENT_DDL) -> DataFrame:
    return spark.read.schema(ddl).json(path)


def _default(value):
    return F.array(*[F.lit(v) for v in value]) if isinstance(value, list) else F.lit(value)


def sync_dim_content(docs: DataFrame) -> DataFrame:
    """Catalog dimension; a missing field or column takes its default."""
    def value(name, default):
        return F.coalesce(F.col(name), _default(default)) if name in docs.columns else _default(default)

    columns = [value(c, v).alias(c) for c, v in DOCUMENT_DEFAULTS.items()]
    return docs.select("content_id", *columns).withColumns(
        {c: F.col(c).cast("int") for c in ("release_year", "duration_seconds")})


def sync_dim_device(devices: DataFrame) -> DataFrame:
    """Device dimension; empty text counts as missing."""
    filled = {c: F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit(v)) for c, v in DEVICE_DEFAULTS.items()}
    return devices.select(
        F.col("device_id").cast("string").alias("device_id"), "device_type", "device_name",
        *[e.alias(c) for c, e in filled.items()])
