"""Pruned search, index upkeep, ranks by range and erasure in files."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import erasure, pruned, staging, text, vector

DDL = "{} bigint, vec array<double>"


def clustered(n, seed, groups=6, dims=10, spread=0.15):
    centres = np.random.default_rng(99).normal(size=(groups, dims))
    r = np.random.default_rng(seed)
    return (centres[r.integers(0, groups, n)] + r.normal(size=(n, dims)) * spread).tolist()


def brute(queries, chunks, k):
    out = []
    for q, a in queries:
        if a is None:
            continue
        scored = []
        for c, b in chunks:
            if b is not None:
                a_, b_ = np.array(a), np.array(b)
                scored.append((-round(float(a_ @ b_) / max(np.linalg.norm(a_) * np.linalg.norm(b_), 1e-300), 9), c))
        out += [(q, c, i + 1) for i, (_, c) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_pivots_find_all_and_leave_pairs_out(spark):
    chunks = list(enumerate(clustered(500, 1))) + [(500 + i, [0.0] * 10) for i in range(9)] + [(600, None)]
    chunks += [(700 + i, chunks[3][1]) for i in range(40)]  # equal vectors
    queries = list(enumerate(clustered(60, 2))) + [(60, [0.0] * 10), (61, None), (62, [-x for x in chunks[3][1]])]
    q, c = spark.createDataFrame(queries, DDL.format("query_id")), spark.createDataFrame(chunks, DDL.format("chunk_id"))
    index, centres = vector.ivf_build(c.where("vec IS NOT NULL"), lists=12)
    hits, work = pruned.pivot_knn(q, index.select("chunk_id", "vec", "list_id").unionByName(spark.createDataFrame([(600, None, 0)], "chunk_id bigint, vec array<double>, list_id int")),
                                  centres, 7, block_rows=512)
    assert sorted(tuple(r) for r in hits.select("query_id", "chunk_id", "rank").collect()) == brute(queries, chunks, 7)
    row = work.first()
    assert row.pairs == 62 * 549 and row.left_out > 0.5
    none, _ = pruned.pivot_knn(q.limit(0), index, centres, 3)
    assert none.collect() == []


def test_hash_tables(spark):
    queries, chunks = list(enumerate(clustered(50, 3))), list(enumerate(clustered(800, 4))) + [(900, None), (901, [0.0] * 10)]
    q, c = spark.createDataFrame(queries, DDL.format("query_id")), spark.createDataFrame(chunks, DDL.format("chunk_id"))
    found = pruned.hash_knn(q, c, 5, tables=10, bits=4, probes=2, block_rows=100)
    got = sorted(tuple(r) for r in found.select("query_id", "chunk_id").collect())
    assert len(got) == len(set(got)) <= 250
    exact = spark.createDataFrame([r[:2] for r in brute(queries, chunks, 5)], "query_id bigint, chunk_id bigint")
    seen = pruned.recall(found, exact).first()
    assert seen.exact_hits == 250 and seen.found >= 225
    assert pruned.hash_knn(q, c.limit(0), 5).collect() == []
    assert pruned.hash_bits(100) == 1 and pruned.hash_bits(256 * 1000) == 10


def test_index_upkeep(spark):
    rows = list(enumerate(clustered(300, 5)))
    index, centres = vector.ivf_build(spark.createDataFrame(rows, DDL.format("chunk_id")), lists=6)
    made = vector.list_spread(index, centres)
    new = [(1000 + i, v) for i, v in enumerate(clustered(150, 6, spread=1.5))] + [(7, rows[8][1]), (2000, None)]
    gone = spark.createDataFrame([(i,) for i in range(0, 300, 3)] + [(5555,)], "chunk_id bigint")
    after, heads = vector.ivf_update(index, centres, spark.createDataFrame(new, DDL.format("chunk_id")), gone, made, drift=1.5)
    want = {i: v for i, v in rows if i % 3} | {i: v for i, v in new if v is not None}
    assert {r.chunk_id: r.vec for r in after.collect()} == want and after.count() == len(want)
    assert heads.count() > centres.count()
    queries = list(enumerate(clustered(20, 7)))
    got = vector.ivf_search(spark.createDataFrame(queries, DDL.format("query_id")), after, heads, 5, nprobe=100)
    assert sorted(tuple(r) for r in got.select("query_id", "chunk_id", "rank").collect()) == brute(queries, sorted(want.items()), 5)
    same, heads2 = vector.ivf_update(after, heads, spark.createDataFrame([], DDL.format("chunk_id")), gone, vector.list_spread(after, heads))
    assert {tuple(r) for r in same.select("chunk_id", "list_id").collect()} == {tuple(r) for r in after.select("chunk_id", "list_id").collect()}
    assert heads2.count() == heads.count()


def test_catalog_diff(spark, rows):
    chunks = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "three"), ("n", None)], "chunk_id string, chunk_text string")
    sha = lambda t: F.sha2(F.lit(t), 256)
    existing = spark.createDataFrame([("a",), ("b",), ("z",)], "chunk_id string").withColumn(
        "content_hash", F.when(F.col("chunk_id") == "a", sha("one")).otherwise(sha("older")))
    assert rows(text.catalog_diff(chunks, existing), "chunk_id", "change") == [("b", "changed"), ("c", "new"), ("n", "new"), ("z", "removed")]


@pytest.mark.parametrize("ranges", [1, 3, 9])
def test_rank_by_range(spark, ranges):
    r = np.random.default_rng(8)
    data = [(str(g) if g else None, float(v) if v % 11 else None, i) for i, (g, v) in enumerate(zip(r.integers(0, 4, 500), r.integers(0, 40, 500)))]
    df = spark.createDataFrame(data + [("hot", 5.0, 1000 + i) for i in range(300)], "day string, v double, id int")
    got = {r.id: r["rank"] for r in staging.dense_rank_by_range(df, "day", "v", "rank", ranges).collect()}
    want = {}
    for g in {d[0] for d in data}:
        values = sorted({d[1] for d in data if d[0] == g}, key=lambda x: (x is None, -(x or 0)))
        want |= {d[2]: values.index(d[1]) + 1 for d in data if d[0] == g}
    assert got == want | {1000 + i: 1 for i in range(300)}


def test_erasure_in_files(spark, tmp_path, rows):
    root = str(tmp_path / "t")
    df = spark.range(400).selectExpr("id", "id div 40 AS user_id", "CASE WHEN id < 200 THEN 'a' ELSE 'b' END AS part", "CAST(NULL AS string) AS note")
    for user in range(10):
        df.where(f"user_id = {user}").coalesce(1).write.mode("append").partitionBy("part").parquet(root)
    spark.createDataFrame([(900, None, "b", None)], "id bigint, user_id bigint, part string, note string").coalesce(1).write.mode("append").partitionBy("part").parquet(root)
    mixed = df.where("id IN (5, 45)").withColumn("id", F.col("id") + 1000).coalesce(1)
    mixed.write.mode("append").partitionBy("part").parquet(root)
    before = {f: os.path.getsize(f) for f in glob.glob(f"{root}/*/*.parquet")}
    asked = spark.createDataFrame([(1,), (1,), (7,), (77,), (None,)], "user_id bigint")
    audit = erasure.erase_stored(spark, {"t": root}, asked)
    assert rows(audit) == [("t", 1, 41), ("t", 7, 40)]
    after = {f: os.path.getsize(f) for f in glob.glob(f"{root}/*/*.parquet")}
    # three files held the users, two of them nothing else; all others keep name and bytes
    assert len(set(before) - set(after)) == 3 and len(set(after) - set(before)) == 1
    assert all(before[f] == after[f] for f in set(before) & set(after))
    left = spark.read.parquet(root)
    assert rows(left, "id") == sorted(((i,) for i in [*range(40), *range(80, 280), *range(320, 400), 900, 1005]), key=str)
    assert left.where("part = 'a'").count() == 161 and not os.path.exists(f"{root}/{erasure.JOURNAL}")
    assert rows(erasure.erase_stored(spark, {"t": root}, asked)) == []


def test_cut_off_erasure_is_completed(spark, tmp_path, rows, monkeypatch):
    root = str(tmp_path / "t")
    spark.range(20).selectExpr("id", "id % 2 AS user_id").coalesce(1).write.parquet(root)
    asked = spark.createDataFrame([(1,)], "user_id bigint")
    whole = erasure.finish_swaps

    def dies(s, path):
        if os.path.exists(f"{path}/{erasure.JOURNAL}"):
            raise RuntimeError("lost")

    monkeypatch.setattr(erasure, "finish_swaps", dies)
    with pytest.raises(RuntimeError):
        erasure.erase_stored(spark, {"t": root}, asked)
    assert spark.read.parquet(root).count() == 20  # the journal is hidden from readers
    monkeypatch.setattr(erasure, "finish_swaps", whole)
    assert rows(erasure.erase_stored(spark, {"t": root}, asked)) == []
    assert rows(spark.read.parquet(root), "id") == sorted(((i,) for i in range(0, 20, 2)), key=str)
