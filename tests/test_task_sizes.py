"""Work of single tasks and steps that are run once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.given import Given
from checks.registry import QUERIES
from marquee.operators import vector
from marquee.streaming import jobs


@pytest.mark.parametrize("width,k", [(5, 7), (100, 3), (1000, 3), (1000, 10), (64 * 11, 10)])
def test_best_scores_of_rows(width, k):
    r = np.random.default_rng(width + k)
    scores = np.round(r.normal(size=(40, width)), 2) + r.choice([0, 3e-11], size=(40, width))
    scores[3], scores[4, 1:], scores[5, ::2] = -np.inf, -np.inf, np.nan
    rows, cols = vector._best(scores.copy(), k)
    found = [set(cols[rows == i].tolist()) for i in range(40)]
    for i, row in enumerate(vector._rounded(scores)):
        known = np.flatnonzero(np.isfinite(row))
        floor = np.sort(row[known])[::-1][: k][-1:]
        assert set(known[row[known] >= floor].tolist() if len(floor) else []) <= found[i] <= set(known.tolist()), i


def test_every_pair_of_blocks_has_a_task(spark, capsys):
    rows = spark.range(64).select(F.col("id").alias("chunk_id"), F.array(F.col("id") % 7 + 1.0, F.col("id") % 5 - 2.0).alias("vec"))
    hits = vector.knn(rows.withColumnRenamed("chunk_id", "query_id"), rows, 2, block_rows=16)
    hits.explain()
    assert "hashpartitioning(_l" in (plan := capsys.readouterr().out) and plan.count("REPARTITION_BY_NUM") == 2
    assert hits.count() == 128


def test_purchases_are_joined_once(spark, tmp_path, monkeypatch):
    tables = {
        "part": ("p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
                 [(i, f"p{i}", f"Brand#{i % 3 + 1}", "PROMO", i, 9.0) for i in range(6)]),
        "orders": ("o_orderkey long, o_custkey long", [(i, i % 4) for i in range(12)] + [(12, None)]),
        "lineitem": ("l_orderkey long, l_partkey long", [(i % 13, i % 6) for i in range(60)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_acctbal double", [(i, f"c{i}", 1, 5.0) for i in (0, 1, 1, 2, 9)]),
        "embeddings": ("vec_id long, embedding array<float>, label int", [(i, [1.0, float(i)], i % 3) for i in range(8)]),
    }
    for name, (schema, given) in tables.items():
        spark.createDataFrame(given, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    reads, read = [], Given.read
    monkeypatch.setattr(Given, "read", lambda self, name: reads.append(name) or read(self, name))
    shelves = QUERIES["r09_personal_shelves"](spark, str(tmp_path)).collect()
    assert reads.count("lineitem") == 1
    assert {r.shelf for r in shelves} == {"because_you_watched", "collaborative_picks", "hybrid_discoveries"}
    assert {r.user_id for r in shelves} == {0, 1, 2, 9} and {r.user_id for r in shelves if r.shelf == "collaborative_picks"} == {0, 1, 2}


def test_a_batch_that_only_clears_state_is_not_written(spark, tmp_path):
    written = []
    sink = jobs.late_flag_sink(str(tmp_path), 30.0, "event_id", ["p"], lambda d, n: written.append((n, d.count())))
    rows = spark.range(5).select(F.col("id").alias("event_id"), F.lit(1).alias("p"), F.timestamp_seconds("id").alias("event_time"))
    sink(rows, 0)
    sink(rows.limit(0), 1)
    sink(rows, 2)
    assert written == [(0, 5), (2, 5)]
