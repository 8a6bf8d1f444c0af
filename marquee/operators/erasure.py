"""Erasure in stored tables: only files that hold a requested user are rewritten."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.staging import union_all
from marquee.session import cut_lineage
from marquee.sources.upsert import exists, file_system

JOURNAL = "_erasures"


def erase_stored(spark: SparkSession, tables: dict[str, str], requests: DataFrame, user_columns: dict[str, str] | None = None) -> DataFrame:
    """Remove the requested users from Parquet tables (name to path); returns the rows removed per table and user.

    One scan of a table's user column finds both its touched files and the audit. Their remaining rows are written
    beside the table, a journal names old and new files, then the new ones take their places and the old ones go. A run that
    was cut off is completed by the next: with a journal the swap is finished, without one nothing had changed. Files without a
    requested user keep their names and bytes. A null user is never requested; repeated requests count once. Readers
    that are under way while files are swapped should be run again.
    """
    columns, audits = user_columns or {}, []
    wanted = cut_lineage(requests.select(F.col("user_id")).where("user_id IS NOT NULL").distinct())
    for name, path in tables.items():
        finish_swaps(spark, path)
        column = columns.get(name, "user_id")
        ids = wanted.select(F.col("user_id").alias(column))
        rows = spark.read.parquet(path).select(column, F.col("_metadata.file_path").alias("file"))
        found = cut_lineage(rows.join(ids, column, "left_semi").groupBy(F.col(column).alias("user_id"), "file").agg(F.count(F.lit(1)).alias("n")))
        touched = [r[0] for r in found.select("file").distinct().orderBy("file").collect()]  # names of files, not rows
        if touched:
            _rewrite(spark, path, touched, ids, column)
        audits.append(found.groupBy("user_id").agg(F.sum("n").alias("rows_erased")).select(F.lit(name).alias("table_name"), "user_id", "rows_erased"))
    return union_all(audits)


def _rewrite(spark: SparkSession, path: str, touched: list[str], ids: DataFrame, column: str) -> None:
    work = f"{path}/{JOURNAL}/{uuid.uuid4().hex}"
    numbered = spark.createDataFrame(list(enumerate(touched)), "file_no long, file string")
    old = spark.read.parquet(*touched)  # without a base path: folder columns stay in the folders
    kept = old.withColumn("file", F.col("_metadata.file_path")).join(ids, column, "left_anti").join(F.broadcast(numbered), "file").drop("file")
    kept.hint("rebalance", "file_no").write.partitionBy("file_no").parquet(f"{work}/new")
    made: dict[int, list[str]] = {}
    base, fs = file_system(spark, f"{work}/new")
    for folder in fs.listStatus(base):
        where = folder.getPath()
        if where.getName().startswith("file_no="):
            parts = [f.getPath().toString() for f in fs.listStatus(where) if f.getPath().getName().endswith(".parquet")]
            made[int(where.getName().split("=")[1])] = parts
    swaps = [{"old": f, "new": made.get(i, [])} for i, f in enumerate(touched)]
    journal, fs = file_system(spark, f"{work}/swap.json.tmp")
    out = fs.create(journal, True)
    out.write(bytearray(json.dumps(swaps).encode()))
    out.close()
    fs.rename(journal, file_system(spark, f"{work}/swap.json")[0])
    finish_swaps(spark, path)


def finish_swaps(spark: SparkSession, path: str) -> None:
    """Complete the swaps that a journal names; leave nothing of those without one."""
    if not exists(spark, f"{path}/{JOURNAL}"):
        return
    top, fs = file_system(spark, f"{path}/{JOURNAL}")
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for work in [s.getPath() for s in fs.listStatus(top)]:
        swap = f"{work.toString()}/swap.json"
        if exists(spark, swap):
            for entry in json.loads(spark.read.text(swap, wholetext=True).first()[0]):
                old = hadoop(entry["old"])
                for i, new in enumerate(entry["new"]):
                    target = hadoop(old.getParent(), f"part-{i:05}-{work.getName()}-{old.getName()}")
                    if fs.exists(hadoop(new)):
                        fs.rename(hadoop(new), target)
                if fs.exists(old):
                    fs.delete(old, False)
        fs.delete(work, True)
    fs.delete(top, True)
