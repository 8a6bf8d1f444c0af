"""Exact top-k by inner product: branch and bound over vertically stored blocks of vectors.

Every block holds its vectors dimension block by dimension block. A batch of queries
accumulates products one dimension block after the other; after each, a candidate whose
product so far plus the most the remaining mass allows is below the k-th score is dropped, and
the survivors are compacted. No vector is lost to a bound: scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import map_batches, stage

SCALE = 256
DIMS = 16  # in a dimension block
BLOCK_ROWS, QUERY_ROWS = 4096, 512  # vectors in a block of candidates, of queries
BLOCK_BYTES = 4 << 20  # of a block; one vector alone may be larger
ROUND_BYTES = 64 << 20  # of the blocks of queries broadcast at once
EXACT = float(1 << 52)  # doubles add whole numbers below this without error

BLOCK = "n int, width int, ids array<bigint>, vertical array<binary>"


def whole_vectors(df: DataFrame, vec_id: str, embedding: str, query_every: int) -> DataFrame:
    """(vec_id, is_query, v): components as floor(256 x); vectors with a null, NaN or infinite part go."""
    x = F.col(embedding)
    fine = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = df.where(F.coalesce(fine, F.lit(False)))
    return rows.select(F.col(vec_id).cast("bigint").alias("vec_id"),
                       F.coalesce(F.col(vec_id) % query_every == 0, F.lit(False)).alias("is_query"),
                       F.transform(x, lambda c: F.floor(c.cast("double") * SCALE).cast("bigint")).alias("v"))


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Rows of equal length; shorter vectors end in zeros."""
    ends = vectors.offsets.to_numpy()
    sizes = np.diff(ends)
    flat = vectors.values.to_numpy(zero_copy_only=False)
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(ends[0], ends[-1]) - np.repeat(ends[:-1], sizes)] = flat[ends[0]:ends[-1]]
    return out


def vertical(vectors: DataFrame, rows: int) -> DataFrame:
    """Blocks of at most ``rows`` vectors: per dimension block a run of bytes, one dimension after the other."""

    def pack(ids, parts):
        dims = max(p.shape[1] for p in parts)
        m = np.concatenate([np.pad(p, ((0, 0), (0, dims - p.shape[1]))) for p in parts])
        width = next(w for w in (2, 4, 8) if w == 8 or max(int(m.max()), -int(m.min())) < 1 << (8 * w - 1))
        cut = [np.ascontiguousarray(m[:, d:d + DIMS].T.astype(f"i{width}")).tobytes() for d in range(0, dims, DIMS)]
        return pa.RecordBatch.from_pylist([{"n": len(m), "width": width, "ids": ids, "vertical": cut}], schema=_BLOCK)

    def pieces(batch):
        sizes = np.diff(batch.column("v").offsets.to_numpy())
        if batch.num_rows > 1 and (batch.num_rows > rows or batch.num_rows * int(sizes.max()) * 8 > BLOCK_BYTES):
            half = batch.num_rows // 2
            yield from pieces(batch.slice(0, half))
            yield from pieces(batch.slice(half))
        elif batch.num_rows:
            yield batch.column("vec_id").to_pylist(), _matrix(batch.column("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts = [], []
        for batch in batches:
            for some, m in pieces(batch):
                dims = max([m.shape[1], *(p.shape[1] for p in parts)])
                if ids and (len(ids) + len(some) > rows or (len(ids) + len(some)) * dims * 8 > BLOCK_BYTES):
                    yield pack(ids, parts)
                    ids, parts = [], []
                ids, parts = ids + some, [*parts, m]
        if ids:
            yield pack(ids, parts)

    return map_batches(vectors, BLOCK, run)


_BLOCK = pa.schema([("n", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.int64())), ("vertical", pa.list_(pa.binary()))])
_FOUND = pa.schema([("query_id", pa.int64()), ("block", pa.int64()), ("row", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _parts(n: int, width: int, runs: list[bytes], blocks: int) -> list[np.ndarray]:
    """The dimension blocks, (dimensions, vectors) each, padded with zeros to ``blocks`` of DIMS."""
    out = []
    for i in range(blocks):
        part = np.zeros((DIMS, n), np.int64)
        if i < len(runs):
            have = np.frombuffer(runs[i], f"i{width}").reshape(-1, n)
            part[:len(have)] = have
        out.append(part)
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: higher score, then smaller id (nulls are the largest)."""
    if len(scores) > 4 * k:
        kth = np.partition(scores, -k)[-k]
        keep = np.flatnonzero(scores >= kth)
        return keep[np.lexsort((ids[keep], -scores[keep]))[:k]]
    return np.lexsort((ids, -scores))[:k]


def search_block(q: list[np.ndarray], q_ids: np.ndarray, c: list[np.ndarray], c_ids: np.ndarray, kth: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its (place, rows, scores) in the block that may be among its k best.

    ``q`` and ``c`` are dimension blocks, ``kth`` the k-th score known of each query, or the
    least integer. Own rows (equal ids) are no candidates. Mass is the 2-norm of what is left,
    so by Cauchy and Schwarz no product can exceed the product so far by more than the two
    masses' product; blocks of more mass in the queries come first.
    """
    order = np.argsort([-float((x.astype(float) ** 2).sum()) for x in q], kind="stable")
    fq, fc = [q[i].astype(float) for i in order], [c[i].astype(float) for i in order]

    def masses(parts):
        squares = np.array([(x ** 2).sum(axis=0) for x in parts])
        return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])

    q_mass, c_mass = masses(fq), masses(fc)
    exact = q_mass[0].max(initial=0) * c_mass[0].max(initial=0) < EXACT
    if not exact:  # whole numbers of any size, without bounds
        for j in range(len(q_ids)):
            rows = np.flatnonzero(c_ids != q_ids[j])
            whole = sum((q[i][:, j].astype(object) @ c[i][:, rows].astype(object) for i in range(len(q))), np.zeros(len(rows), object))
            yield j, rows, np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in whole], np.int64)
        return
    first = fq[0].T @ fc[0]
    for j in range(len(q_ids)):
        rows = np.flatnonzero(c_ids != q_ids[j])
        if not len(rows):
            continue
        sums, least = first[j, rows], float(kth[j])
        for i in range(1, len(fq)):
            rest = q_mass[i, j] * c_mass[i, rows]
            if len(rows) >= k:
                least = max(least, np.partition(sums - rest, -k)[-k] - 1)
            alive = sums + rest + 1 >= least
            if not alive.all():
                rows, sums = rows[alive], sums[alive]
            if not len(rows):
                break
            sums = sums + fq[i][:, j] @ fc[i][:, rows]
        alive = sums >= least
        if alive.any():
            yield j, rows[alive], np.rint(sums[alive]).astype(np.int64)


def nearest(df: DataFrame, k: int = 5, query_every: int = 50, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """Per query row its ``k`` best other rows: ``query_id rank vec_id score``.

    Queries are the rows whose id is divisible by ``query_every``; every row is a candidate but
    those with the query's id. Vectors that are null or hold a null, NaN or infinite component
    take no part. A vector shorter than another counts as followed by zeros. Equal scores go to
    the smaller id, a null id (never a query) counts as the largest; equal rows each take a
    rank. The largest 64-bit integer as an id stands for null. A repeated query row is searched
    once more and has its ranks twice. Components beyond 64 bits are cut to them, and so are
    scores, before they are ranked. Other columns are not read; an empty table or one without
    queries gives no rows.

    Blocks of queries, ROUND_BYTES at a time, are broadcast to the stored blocks; each task keeps
    k rows per query over all blocks it reads, so what is shuffled does not grow with the pairs.
    """
    vectors = stage(whole_vectors(df, vec_id, embedding, query_every), "vectors")
    blocks = stage(vertical(vectors.select("vec_id", "v"), BLOCK_ROWS), "vector-blocks")
    queries = vertical(vectors.where("is_query").select("vec_id", "v"), QUERY_ROWS)
    queries = stage(queries.withColumn("block", F.monotonically_increasing_id()), "query-blocks")
    found = None
    for batch in _rounds(queries):
        part = _round(blocks, batch, k)
        found = part if found is None else found.unionByName(part)
    by_query = Window.partitionBy("block", "row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _rounds(queries: DataFrame) -> list[DataFrame]:
    """The blocks of queries in parts of at most ROUND_BYTES (or of one block)."""
    size = F.aggregate("vertical", F.lit(0).cast("bigint"), lambda a, x: a + F.octet_length(x))
    sized = queries.select("block", size.alias("bytes"))
    rounds = 1
    while True:
        by = F.pmod(F.xxhash64("block"), F.lit(rounds))
        largest = sized.groupBy(by.alias("round")).agg(F.sum("bytes").alias("bytes"), F.count("*").alias("n")).where("n > 1").agg(F.max("bytes")).first()[0]
        if (largest or 0) <= ROUND_BYTES:
            return [queries.where(by == i) if rounds > 1 else queries for i in range(rounds)]
        rounds *= 2


def _round(blocks: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k best rows of every query in each task's blocks; every pair of blocks is met once."""
    pairs = blocks.join(F.broadcast(queries.select("block", *(F.col(c).alias(f"q_{c}") for c in ("n", "width", "ids", "vertical")))))
    none = np.zeros(0, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple] = {}  # block of queries: its ids and, per query, (ids, scores) so far
        for batch in batches:
            for r in batch.to_pylist():
                c_ids = np.array([_NULL_ID if i is None else i for i in r["ids"]], np.int64)
                q_ids, top = best.setdefault(r["block"], (np.array(r["q_ids"], np.int64), [(none, none)] * r["q_n"]))
                kth = np.array([s[-1] if len(s) >= k else np.iinfo(np.int64).min for _, s in top], np.int64)
                n = max(len(r["vertical"]), len(r["q_vertical"]))
                q, c = _parts(r["q_n"], r["q_width"], r["q_vertical"], n), _parts(r["n"], r["width"], r["vertical"], n)
                for j, rows, scores in search_block(q, q_ids, c, c_ids, kth, k):
                    ids, scores = np.concatenate([top[j][0], c_ids[rows]]), np.concatenate([top[j][1], scores])
                    keep = _best(ids, scores, k)
                    top[j] = ids[keep], scores[keep]
        for block, (q_ids, top) in best.items():
            sizes = [len(s) for _, s in top]
            ids, scores = (np.concatenate(x) for x in zip(*top))
            yield pa.RecordBatch.from_arrays([
                pa.array(np.repeat(q_ids, sizes)), pa.array(np.full(len(ids), block, np.int64)),
                pa.array(np.repeat(np.arange(len(top), dtype=np.int32), sizes)), pa.array(ids, mask=ids == _NULL_ID), pa.array(scores)], schema=_FOUND)

    return map_batches(pairs, "query_id bigint, block bigint, row int, vec_id bigint, score bigint", run)


_NULL_ID = np.iinfo(np.int64).max  # sorts behind every other id


SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT * FROM r WHERE rank <= 5"""
