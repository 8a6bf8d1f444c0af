"""Cosine search: exact top-k over blocks, and list probing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, DoubleType

from marquee.functions.scalars import round_half_up
from marquee.operators.staging import top_k
from marquee.session import cut_lineage

SCORE_DIGITS = 10


def _matrix(table: pa.Table, name: str) -> np.ndarray:
    column = table.column(name).combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


GROUP = 64  # scores of a row of which the best is looked at first
MOST_TASKS = 20_000


def _best(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k best scores per row once rounded, ties included, and perhaps some more.

    The k-th of the groups' best scores is a floor that k scores reach, so rows need no sorting.
    """
    groups = scores.shape[1] // GROUP
    tops = scores[:, : groups * GROUP].reshape(len(scores), GROUP, groups).max(axis=1) if groups > k else scores
    if not (tops.max(axis=1) < np.inf).all():  # scores that are no numbers are none of the best
        tops = scores = np.where(np.isfinite(scores), scores, -np.inf)
    last = max(tops.shape[1] - k, 0)
    floor = np.partition(tops, last, axis=1)[:, last]
    floor = floor - 2 * 10.0**-SCORE_DIGITS - 1e-15 * np.abs(floor)  # what rounds to the same counts as a tie
    rows, cols = np.divmod(np.flatnonzero(scores >= floor[:, None]), scores.shape[1])
    known = np.isfinite(scores[rows, cols])
    return rows[known], cols[known]


def _rounded(scores: np.ndarray) -> np.ndarray:
    return np.floor(scores * 10**SCORE_DIGITS + 0.5) / 10**SCORE_DIGITS


def _score_block(k: int, metric: str, left_id: str, right_id: str, slice_cells: int = 1_000_000):
    """Task that scores one block of left vectors against one block of right vectors, ``slice_cells`` scores at a time."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {left_id: [], right_id: [], "score": []}
        vectors = left.filter(pc.is_valid(left.column("vec")))
        right = right.filter(pc.is_valid(right.column("vec")))
        if vectors.num_rows and right.num_rows:
            right = right.sort_by(right_id)
            a, b = _matrix(vectors, "vec"), _matrix(right, "vec")
            if metric == "cosine":
                for m in (a, b):
                    m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)
            hide = _hidden(left, vectors, right)
            step = max(1, slice_cells // right.num_rows)
            for start in range(0, vectors.num_rows, step):
                scores = a[start:start + step] @ b.T
                if hide is not None:
                    inside = (hide[0] >= start) & (hide[0] < start + step)
                    scores[hide[0][inside] - start, hide[1][inside]] = -np.inf
                rows, cols = _best(scores, k)
                found = _rounded(scores[rows, cols])
                order = np.lexsort((cols, -found, rows))
                rows, cols, found = rows[order], cols[order], found[order]
                first = np.searchsorted(rows, rows, side="left")
                kept = np.arange(len(rows)) - first < k
                rows, cols, found = rows[kept], cols[kept], found[kept]
                out[left_id].append(vectors.column(left_id).take(pa.array(rows + start)))
                out[right_id].append(right.column(right_id).take(pa.array(cols)))
                out["score"].append(pa.array(found))
        kinds = {left_id: left.schema.field(left_id).type, right_id: right.schema.field(right_id).type, "score": pa.float64()}
        flat = lambda parts: [c for p in parts for c in (p.chunks if isinstance(p, pa.ChunkedArray) else [p])]
        return pa.table({name: pa.chunked_array(flat(out[name]), type=kind) for name, kind in kinds.items()})

    def _hidden(left, vectors, right):
        pairs = left.filter(pc.is_valid(left.column("_not")))
        if not pairs.num_rows:
            return None
        rows = pc.index_in(pairs.column(left_id), vectors.column(left_id).combine_chunks())
        cols = pc.index_in(pairs.column("_not"), right.column(right_id).combine_chunks())
        known = pc.and_(pc.is_valid(rows), pc.is_valid(cols))
        pick = lambda c: c.filter(known).to_numpy().astype(np.int64)
        return pick(rows), pick(cols)

    return run


def block_top_k(left: DataFrame, right: DataFrame, k: int, left_id: str, right_id: str, *, bucket: str | None = None,
                exclude: DataFrame | None = None, metric: str = "cosine", block_rows: int = 32_768,
                min_blocks: int | None = None) -> DataFrame:
    """The k best right rows of every left row: (left_id, right_id, score).

    Both sides (id, ``vec``) are cut into blocks of about ``block_rows``; every
    pair of blocks is one task-sized group multiplied as two matrices, and
    leaves at most k rows per left row. With ``bucket`` only rows of equal
    bucket meet, and a crowded bucket simply gets more blocks. ``exclude``
    names (left_id, right_id) pairs that must not be returned.
    """
    spark = left.sparkSession
    spread = min_blocks or spark.sparkContext.defaultParallelism
    key = bucket or "_b"
    # fresh column ids, so both sides may come from one DataFrame
    fresh = lambda df: df.select(*[F.col(c).alias(c) for c in df.columns])
    left, right = fresh(left), fresh(right)
    # block counts; small inputs are still cut fine enough to use all cores
    blocks = lambda n, most: F.greatest(
        F.ceil(n / F.lit(block_rows)), F.least(F.ceil(n / F.lit(256)), F.lit(most)), F.lit(1)).cast("int")
    count = F.count(F.lit(1))
    pairs = None
    if bucket is None:
        n_left, n_right = left.count(), right.count()
        n_blocks = lambda n, most: max(-(-n // block_rows), min(-(-n // 256), most), 1)
        lb, rb = n_blocks(n_left, spread), n_blocks(n_right, 1)
        sizes = {key: F.lit(0), "_lb": F.lit(lb), "_rb": F.lit(rb)}
        sized = lambda df: df.withColumns(sizes)
        pairs = min(lb * rb, MOST_TASKS)
    else:
        n_left = left.groupBy(key).agg(count.alias("_nl"))
        n_right = right.groupBy(key).agg(count.alias("_nr"))
        grid = n_left.join(n_right, key).select(key, blocks(F.col("_nl"), 1).alias("_lb"), blocks(F.col("_nr"), 1).alias("_rb"))
        # one row per list, and lists are few
        sized = lambda df: df.join(F.broadcast(grid), key)
    place = lambda c, n: F.pmod(F.xxhash64(F.col(c)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    nothing = F.lit(None).cast(right.schema[right_id].dataType)
    no_vec = F.lit(None).cast(left.schema["vec"].dataType)
    lefts = sized(left).select(
        key, place(left_id, "_lb").alias("_l"), every("_rb").alias("_r"), left_id, "vec", nothing.alias("_not"))
    if exclude is not None:
        if bucket is not None:
            raise ValueError("exclude works without bucket only")
        gone = sized(fresh(exclude.select(left_id, right_id))).select(
            key, place(left_id, "_lb").alias("_l"), place(right_id, "_rb").alias("_r"), left_id,
            no_vec.alias("vec"), F.col(right_id).alias("_not"))
        lefts = lefts.unionByName(gone)
    rights = sized(right).select(
        key, place(right_id, "_rb").alias("_r"), every("_lb").alias("_l"), right_id, "vec")
    schema = StructType([
        StructField(left_id, left.schema[left_id].dataType), StructField(right_id, right.schema[right_id].dataType),
        StructField("score", DoubleType()),
    ])
    cell = [key, "_l", "_r"]
    if pairs is not None:
        # as many tasks as pairs of blocks: a pair has few bytes but much work, and partitions would be merged by their bytes
        cell = cell[1:]
        lefts, rights = lefts.repartition(pairs, *cell), rights.repartition(pairs, *cell)
    scored = lefts.groupBy(*cell).cogroup(rights.groupBy(*cell)).applyInArrow(
        _score_block(k, metric, left_id, right_id), schema)
    return top_k(scored, [left_id], [F.col("score").desc(), F.col(right_id)], k)


def knn(queries: DataFrame, chunks: DataFrame, k: int, genre: str | None = None, **blocks) -> DataFrame:
    """Exact cosine top-k of every query over all chunks.

    queries: query_id, vec. chunks: chunk_id, vec, optional genres array.
    """
    if genre is not None:
        chunks = chunks.where(F.array_contains("genres", genre))
    hits = block_top_k(queries.select("query_id", "vec"), chunks.select("chunk_id", "vec"), k, "query_id", "chunk_id", **blocks)
    return hits.select("query_id", "chunk_id", round_half_up(F.col("score"), 4).alias("similarity_score"), "rank")


def ivf_build(chunks: DataFrame, lists: int = 100, seed: int = 7, max_iter: int = 10) -> tuple[DataFrame, DataFrame]:
    """(chunks with their list number, list centres) from k-means on unit vectors; a zero vector stays zero."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    unit = chunks.withColumn("_unit", array_to_vector(F.transform("vec", lambda x: F.when(size > 0, x / size).otherwise(F.lit(0.0)))))
    model = KMeans(k=lists, seed=seed, maxIter=max_iter, featuresCol="_unit", predictionCol="list_id").fit(unit)
    centres = chunks.sparkSession.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())], "list_id int, vec array<double>")
    return model.transform(unit).drop("_unit"), centres


def ivf_search(queries: DataFrame, index: DataFrame, centres: DataFrame, k: int, nprobe: int = 10, **blocks) -> DataFrame:
    """Cosine top-k within the ``nprobe`` nearest lists of every query."""
    probes = block_top_k(
        queries.select("query_id", "vec"), centres, nprobe, "query_id", "list_id", min_blocks=1
    ).select("query_id", "list_id")
    routed = queries.join(probes, "query_id").select("query_id", "vec", "list_id")
    hits = block_top_k(routed, index.select("chunk_id", "vec", "list_id"), k, "query_id", "chunk_id", bucket="list_id", **blocks)
    return hits.select("query_id", "chunk_id", round_half_up(F.col("score"), 4).alias("similarity_score"), "rank")


def list_spread(index: DataFrame, centres: DataFrame) -> DataFrame:
    """(list_id, n, spread): vectors of a list and their mean squared distance to its centre, on unit length."""
    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    named = centres.select("list_id", F.col("vec").alias("_centre"))
    gap = F.aggregate(F.zip_with("vec", "_centre", lambda x, y: F.when(F.col("_size") > 0, x / F.col("_size")).otherwise(F.lit(0.0)) - y),
                      F.lit(0.0), lambda s, d: s + d * d)
    rows = index.where("vec IS NOT NULL").withColumn("_size", size).join(F.broadcast(named), "list_id")
    return rows.groupBy("list_id").agg(F.count(F.lit(1)).alias("n"), F.avg(gap).alias("spread"))


def ivf_update(index: DataFrame, centres: DataFrame, upserts: DataFrame, removed: DataFrame, spread: DataFrame | None = None,
               drift: float = 1.5, seed: int = 7) -> tuple[DataFrame, DataFrame]:
    """(index, centres) after a change of the catalog: removed ids gone, new and changed vectors (chunk_id, vec) in their nearest list.

    ``spread`` is :func:`list_spread` of the index when its centres were made. A list whose spread has grown beyond ``drift`` times that
    is split in two by k-means over its own vectors; all other lists and centres stay as they are. Updates of no change
    change nothing, and a chunk is in one list.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    gone = upserts.select("chunk_id").unionByName(removed.select("chunk_id")).distinct()
    kept = index.select("chunk_id", "vec", "list_id").join(gone, "chunk_id", "left_anti")
    usable = upserts.select("chunk_id", "vec").where("vec IS NOT NULL")
    placed = block_top_k(usable.withColumnRenamed("chunk_id", "query_id"), centres, 1, "query_id", "list_id", min_blocks=1)
    added = usable.join(placed.select(F.col("query_id").alias("chunk_id"), "list_id"), "chunk_id")
    now = cut_lineage(kept.unionByName(added.select("chunk_id", "vec", F.col("list_id").cast("int").alias("list_id"))))
    if spread is None:
        return now, centres
    was = spread.select("list_id", F.col("spread").alias("_was"))
    wide = list_spread(now, centres).join(was, "list_id").where((F.col("n") > 1) & (F.col("spread") > drift * F.col("_was") + 1e-12))
    drifted = sorted(r[0] for r in wide.select("list_id").collect())  # lists are few
    made = {r["list_id"]: list(r["vec"]) for r in centres.collect()}
    fresh = max(made, default=-1) + 1
    size = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    for number in drifted:
        unit = now.where(F.col("list_id") == number).withColumn(
            "_unit", array_to_vector(F.transform("vec", lambda x: F.when(size > 0, x / size).otherwise(F.lit(0.0)))))
        model = KMeans(k=2, seed=seed, featuresCol="_unit", predictionCol="_half").fit(unit)
        halves = model.transform(unit).select("chunk_id", "vec", F.when(F.col("_half") == 0, number).otherwise(fresh).cast("int").alias("list_id"))
        now = cut_lineage(now.where(F.col("list_id") != number).unionByName(halves))
        for at, centre in zip((number, fresh), model.clusterCenters()):
            made[at] = [float(x) for x in centre]
        fresh += 1
    return now, index.sparkSession.createDataFrame(sorted(made.items()), "list_id int, vec array<double>")
