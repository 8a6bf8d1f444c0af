"""Collaborative scores: implicit ratings, truncated SVD and ALS."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.scalars import round_half_up
from marquee.operators.vector import block_top_k
from marquee.session import cut_lineage

# Lengths that count as a whole watch.
FULL_POSITION = 5400.0
FULL_PLAYBACK = 3600.0

# largest set of title vectors sent to every executor
BROADCAST_BYTES = 64 * 2**20


def implicit_scores(events: DataFrame) -> DataFrame:
    """ratio × log1p(play + 1) from the largest position and play time of each pair.

    Missing positions and times count as 0; events without user or title belong to no pair.
    """
    pairs = events.where(F.col("user_id").isNotNull() & F.col("content_id").isNotNull())
    best = pairs.groupBy("user_id", "content_id").agg(
        F.coalesce(F.max("position_seconds"), F.lit(0)).alias("pos"), F.coalesce(F.max("playback_seconds"), F.lit(0)).alias("play"))
    ratio = F.when(F.col("pos") > 0, F.least(F.col("pos") / FULL_POSITION, F.lit(1.0))).otherwise(
        F.least(F.col("play") / FULL_PLAYBACK, F.lit(1.0)))
    return best.select("user_id", "content_id", (ratio * F.log1p(F.col("play") + 1.0)).alias("score"))


def _gram(df: DataFrame, width: int) -> np.ndarray:
    """Sum of vecᵀvec over all rows: one width×width block per task, then summed."""

    def partial(batches):
        total = np.zeros((width, width))
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            m = flat.reshape(-1, width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width * width, dtype=np.int32)), pa.array(total.ravel())], ["cell", "x"])

    cells = df.select("vec").mapInArrow(partial, "cell int, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    out = np.zeros(width * width)
    for row in cells.collect():  # width² numbers, whatever the data size
        out[row["cell"]] = row["x"]
    return out.reshape(width, width)


def _times(df: DataFrame, matrix: np.ndarray, key: str) -> DataFrame:
    """Every vector multiplied by one small matrix."""
    width = matrix.shape[0]

    def apply(batches):
        for batch in batches:
            m = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) @ matrix
            offsets = pa.array(np.arange(0, m.size + 1, matrix.shape[1], dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(m.ravel()))], [key, "vec"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, "vec").mapInArrow(apply, f"{key} {kind}, vec array<double>")


def _spread(scores: DataFrame, vectors: DataFrame, on: str, to: str, width: int) -> DataFrame:
    """Σ score × vec of the joined side, per key of the other side."""
    sums = [F.sum(F.col("score") * F.col("vec")[j]).alias(f"v{j}") for j in range(width)]
    rows = scores.join(vectors, on).groupBy(to).agg(*sums)
    return rows.select(to, F.array(*[f"v{j}" for j in range(width)]).alias("vec"))


def _sent(vectors: DataFrame, rows: int, width: int) -> DataFrame:
    """Broadcast the vectors if they are known to be small; else leave the join to Spark."""
    return F.broadcast(vectors) if rows * width * 8 <= BROADCAST_BYTES else vectors


def _whiten(gram: np.ndarray) -> np.ndarray:
    """Matrix that makes the columns orthonormal; directions without weight are left out."""
    values, vectors = np.linalg.eigh(gram)
    keep = values > max(values.max(), 0.0) * 1e-13
    return vectors[:, keep] / np.sqrt(values[keep])


def svd_factors(scores: DataFrame, k: int = 16, oversample: int = 10, iterations: int = 5, seed: int = 42
                ) -> tuple[DataFrame, DataFrame]:
    """(user vectors U·Σ, title vectors V) of the best rank-k approximation.

    Randomized subspace iteration. Scores are laid out by user once; while the
    title vectors are small enough to broadcast, a pass sums user vectors in
    place and shuffles only partial sums per title. The driver only sees
    matrices of (k + oversample)² numbers.
    """
    scores = cut_lineage(scores.select("user_id", "content_id", "score").repartition("user_id"))
    size = scores.agg(F.countDistinct("content_id").alias("i"), F.countDistinct("user_id").alias("u")).first()
    k = max(min(k, size["i"] - 1, size["u"] - 1), 2)
    width = min(k + oversample, size["i"], size["u"])
    start = F.array(*[F.xxhash64("content_id", F.lit(seed * 1000 + j)) / F.lit(2.0**63) for j in range(width)])
    basis = scores.select("content_id").distinct().select("content_id", start.alias("vec"))
    for _ in range(iterations):
        users = _spread(scores, _sent(basis, size["i"], width), "content_id", "user_id", width)
        items = cut_lineage(_spread(scores, users, "user_id", "content_id", width))
        turn = _whiten(_gram(items, width))
        basis, width = _times(items, turn, "content_id"), turn.shape[1]
    users = cut_lineage(_spread(scores, _sent(basis, size["i"], width), "content_id", "user_id", width))
    values, vectors = np.linalg.eigh(_gram(users, width))
    top = vectors[:, np.argsort(values)[::-1][:k]]
    return _times(users, top, "user_id"), _times(basis, top, "content_id")


def svd_recommend(scores: DataFrame, k: int = 16, top: int = 10, **options) -> DataFrame:
    """Top unseen titles per user by the rank-k scores."""
    scores = cut_lineage(scores)
    users, items = svd_factors(scores, k, **options)
    best = block_top_k(users, items, top, "user_id", "content_id", exclude=scores, metric="dot")
    return best.select("user_id", "content_id", round_half_up(F.col("score"), 4).alias("cf_score"), "rank")


def als_recommend(scores: DataFrame, rank: int = 16, top: int = 10, seed: int = 42, **options) -> DataFrame:
    """The same from implicit-feedback ALS; ids are numbered by the distributed indexer."""
    from pyspark.ml.recommendation import ALS

    scores = cut_lineage(scores)
    users = _numbered(scores, "user_id")
    items = _numbered(scores, "content_id")
    coded = scores.join(users, "user_id").join(items, "content_id")
    als = ALS(rank=rank, implicitPrefs=True, userCol="user_id_n", itemCol="content_id_n", ratingCol="score", seed=seed,
              **options)
    model = als.fit(coded)
    u = model.userFactors.withColumnRenamed("id", "user_id_n").join(users, "user_id_n").select(
        "user_id", F.col("features").alias("vec"))
    i = model.itemFactors.withColumnRenamed("id", "content_id_n").join(items, "content_id_n").select(
        "content_id", F.col("features").alias("vec"))
    best = block_top_k(u, i, top, "user_id", "content_id", exclude=scores, metric="dot")
    return best.select("user_id", "content_id", round_half_up(F.col("score"), 4).alias("cf_score"), "rank")


def _numbered(scores: DataFrame, column: str) -> DataFrame:
    """Distinct ids with an int number each: their place in their partition after those of the earlier partitions."""
    place = F.monotonically_increasing_id()
    ids = cut_lineage(scores.select(column).distinct().select(column, F.shiftright(place, 33).alias("_part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("_at")))
    sizes = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return ids.join(F.broadcast(starts), "_part").select(column, (F.col("_at") + F.col("_start")).cast("int").alias(f"{column}_n"))
