"""Sinks for micro-batches: a batch delivered twice leaves one copy, and a new checkpoint replaces nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.rollups import rollup_merge, rollup_partial
from marquee.sources.upsert import apply_changes_path, exists, kept, upsert_path

RUN, BATCH = "run_id", "batch_id"
BY_HAND = "by_hand"


def current_run(spark: SparkSession) -> str:
    """The id of the stream whose batch is being written. It is kept in the checkpoint, so batch
    numbers that start anew with a new checkpoint belong to another run."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or BY_HAND


def write_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write the rows of one batch under its run and number, replacing an earlier try."""
    rows = df.withColumns({RUN: F.lit(current_run(df.sparkSession)), BATCH: F.lit(batch_id)})
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(RUN, BATCH).parquet(path)


def foreach_batch_sink(tables: dict[str, Callable[[DataFrame], DataFrame]], root: str) -> Callable[[DataFrame, int], None]:
    """One source batch into several tables below ``root``, each by its own function."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if len(tables) == 1:  # read once only, so nothing to keep
            for name, make in tables.items():
                write_batch(make(batch), batch_id, f"{root}/{name}")
            return
        batch = kept(batch)
        try:
            for name, make in tables.items():
                write_batch(make(batch), batch_id, f"{root}/{name}")
        finally:
            batch.unpersist()

    return sink


def upsert_sink(path: str, keys: list[str], partitions: list[str],
                version: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """Keep one row per key; for results that are sent again when they change.

    With ``version`` it is the newest by those columns. Without, the last batch wins and
    a batch must hold a key once.
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        upsert_path(batch.sparkSession, path, batch, keys, partitions, version=version)

    return sink


def changes_sink(path: str, keys: list[str], version: list[str], op: str = "op") -> Callable[[DataFrame, int], None]:
    """Apply every batch of a change feed to a table."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        apply_changes_path(batch.sparkSession, path, batch, keys, version, op)

    return sink


def rollup_sink(grain: str, path: str) -> Callable[[DataFrame, int], None]:
    """Partial rollup state of every batch; late events simply join a later state."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        write_batch(rollup_partial(batch, grain), batch_id, path)

    return sink


def read_rollup(spark: SparkSession, grain: str, path: str) -> DataFrame:
    """The merged state of all batches."""
    return rollup_merge(spark.read.parquet(path).drop(RUN, BATCH), grain)


def read_batches(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.parquet(path).drop(RUN, BATCH) if exists(spark, path) else None
