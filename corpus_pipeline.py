"""The corpus pipeline: quality rules, near-duplicate removal, benchmark decontamination, pseudonyms, BPE ids.

Every stage is written as Parquet in the cluster's shared folder and read back as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.common import stage, table
from marquee.llm.pipeline import STAGES

# Keyed permutations and merges are beyond SQL; the tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
