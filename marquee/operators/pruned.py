"""Vector search that leaves most pairs out: exact by pivots and triangle inequality, approximate by hash tables."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, LongType, IntegerType

from marquee.functions.scalars import round_half_up
from marquee.operators.staging import top_k
from marquee.operators.vector import _matrix, block_top_k

SLACK = 1e-7  # angles and stored scores are rounded


def _size(vec: str = "vec") -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0), lambda s, x: s + x * x))


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)


def list_angles(index: DataFrame, centres: DataFrame) -> DataFrame:
    """(list_id, near, far, n): the least and largest angle between a list's vectors and its centre."""
    named = centres.select("list_id", F.col("vec").alias("_centre"))
    cosine = _dot("vec", "_centre") / (_size("vec") * _size("_centre"))
    # one row per list
    angles = index.join(F.broadcast(named), "list_id").select("list_id", F.acos(F.least(F.greatest(cosine, F.lit(-1.0)), F.lit(1.0))).alias("a"))
    return angles.groupBy("list_id").agg(F.min("a").alias("near"), F.max("a").alias("far"), F.count(F.lit(1)).alias("n"))


def pivot_knn(queries: DataFrame, index: DataFrame, centres: DataFrame, k: int, nprobe: int = 2, **blocks) -> tuple[DataFrame, DataFrame]:
    """(exact cosine top-k, work) of every query over an index in lists, as ``vector.ivf_build`` makes it.

    Each query first searches its ``nprobe`` nearest lists; its k-th score there is a floor. A vector of list p
    stands at an angle of at least max(a - far, near - a) from a query at angle a from p's centre, so a list whose best possible
    cosine is below the floor holds no hit and is not met. All other lists are searched. Vectors without length score 0 with
    everything: of those only the k smallest ids are kept, for all queries alike, and a query without length gets the k
    smallest ids of all. Vectors that are null take no part. ``work`` is one row: all pairs, pairs met, share left out.
    """
    spark = queries.sparkSession
    asked = queries.where("vec IS NOT NULL").select("query_id", "vec", (_size() > 0).alias("_long"))
    known = index.where("vec IS NOT NULL").select("chunk_id", "vec", "list_id", (_size() > 0).alias("_long"))
    long, rows = asked.where("_long").drop("_long"), known.where("_long").drop("_long")
    angles = list_angles(rows, centres)
    lists = centres.join(angles, "list_id").orderBy("list_id").collect()  # one row per list, as many as were asked for
    parts = []
    met = F.lit(0).cast("bigint")
    if lists:
        probes = block_top_k(long, centres.join(angles.select("list_id"), "list_id", "left_semi"), nprobe, "query_id", "list_id", min_blocks=1).select("query_id", "list_id")
        first = block_top_k(long.join(probes, "query_id"), rows, k, "query_id", "chunk_id", bucket="list_id", **blocks).drop("rank")
        floors = first.groupBy("query_id").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("_floor"))
        probed = probes.groupBy("query_id").agg(F.collect_list("list_id").alias("_seen"))
        routed = _route(long.join(floors, "query_id", "left").join(probed, "query_id", "left"), lists)
        second = block_top_k(long.join(routed, "query_id"), rows, k, "query_id", "chunk_id", bucket="list_id", **blocks).drop("rank")
        parts += [first, second]
        met = probes.unionByName(routed).join(F.broadcast(angles), "list_id").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    few = lambda df: df.select("chunk_id").orderBy("chunk_id").limit(k).withColumn("score", F.lit(0.0))  # noqa: E731  k rows
    parts.append(long.select("query_id").join(F.broadcast(few(known.where("NOT _long")))))
    parts.append(asked.where("NOT _long").select("query_id").join(F.broadcast(few(known))))
    hits = parts[0]
    for p in parts[1:]:
        hits = hits.unionByName(p)
    best = top_k(hits, ["query_id"], [F.col("score").desc(), F.col("chunk_id")], k)
    pairs = asked.agg(F.count(F.lit(1))).scalar() * known.agg(F.count(F.lit(1))).scalar()
    work = spark.range(1).select(pairs.alias("pairs"), met.alias("met")).withColumn("left_out", 1 - F.col("met") / F.greatest("pairs", F.lit(1)))
    return best.select("query_id", "chunk_id", round_half_up(F.col("score"), 4).alias("similarity_score"), "rank"), work


def _route(queries: DataFrame, lists: list) -> DataFrame:
    """(query_id, list_id) of the lists that may hold a hit and have not been searched."""
    centres = np.array([r["vec"] for r in lists])
    centres /= np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-300)
    ids, near, far = (np.array([r[c] for r in lists]) for c in ("list_id", "near", "far"))
    schema = StructType([StructField("query_id", queries.schema["query_id"].dataType), StructField("list_id", IntegerType())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(pa.Table.from_batches([batch]), "vec")
            q /= np.linalg.norm(q, axis=1, keepdims=True)
            angle = np.arccos(np.clip(q @ centres.T, -1, 1))
            least = np.maximum(np.maximum(angle - far, near - angle), 0)
            floor = np.array([-2.0 if x is None else x for x in batch.column("_floor").to_pylist()])
            open_ = np.cos(least) + SLACK >= floor[:, None]
            for i, seen in enumerate(batch.column("_seen").to_pylist()):
                open_[i, np.isin(ids, seen or [])] = False
            at, which = np.nonzero(open_)
            yield pa.RecordBatch.from_arrays([batch.column("query_id").take(pa.array(at)), pa.array(ids[which].astype(np.int32))], names=["query_id", "list_id"])

    return queries.select("query_id", "vec", "_floor", "_seen").mapInArrow(run, schema)


# --- random projections ---------------------------------------------------------------


def hash_bits(rows: int, bucket_rows: int = 256) -> int:
    """Bits that leave some ``bucket_rows`` vectors in a bucket."""
    return max(1, min(24, math.ceil(math.log2(max(2, rows) / bucket_rows)))) if rows > bucket_rows else 1


def _codes(df: DataFrame, id_col: str, dims: int, tables: int, bits: int, probes: int, seed: int) -> DataFrame:
    """(id, vec, bucket): a vector's bucket in every table, and those reached by turning its ``probes`` least certain bits."""
    planes = np.random.default_rng(seed).normal(size=(dims, tables * bits))
    weights = 1 << np.arange(bits)
    schema = StructType([StructField(id_col, df.schema[id_col].dataType), StructField("vec", df.schema["vec"].dataType), StructField("bucket", LongType())])

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = (_matrix(pa.Table.from_batches([batch]), "vec") @ planes).reshape(batch.num_rows, tables, bits)
            own = (sides > 0) @ weights
            turned = np.argsort(np.abs(sides), axis=2, kind="stable")[:, :, :probes]
            codes = np.concatenate([own[:, :, None], own[:, :, None] ^ weights[turned]], axis=2) if probes else own[:, :, None]
            buckets = codes + (np.arange(tables) << bits)[None, :, None]
            per = buckets.shape[1] * buckets.shape[2]
            at = pa.array(np.repeat(np.arange(batch.num_rows), per))
            yield pa.RecordBatch.from_arrays([batch.column(id_col).take(at), batch.column("vec").take(at), pa.array(buckets.reshape(-1).astype(np.int64))],
                                             names=[id_col, "vec", "bucket"])

    return df.where("vec IS NOT NULL").select(id_col, "vec").mapInArrow(run, schema)


def hash_knn(queries: DataFrame, chunks: DataFrame, k: int, tables: int = 8, bits: int | None = None, probes: int = 2, seed: int = 7, **blocks) -> DataFrame:
    """Cosine top-k among vectors that share a bucket with the query in any of ``tables`` tables, scored exactly.

    A bucket is the side of ``bits`` random planes; each query also looks into the buckets behind its ``probes``
    nearest planes. A crowded bucket is split into more blocks, never cut. More tables and probes find more; ``recall`` measures it.
    """
    dims = chunks.where("vec IS NOT NULL").select(F.size("vec")).first()
    if dims is None:
        return queries.select("query_id").limit(0).join(chunks.select("chunk_id")).select("query_id", "chunk_id", F.lit(0.0).alias("similarity_score"), F.lit(0).cast("bigint").alias("rank"))
    bits = bits or hash_bits(chunks.count())
    args = (dims[0], tables, bits)
    # a vector lies in one bucket of a table, so a table's hits are distinct; the same hit may come out of several tables
    probe = F.struct("query_id", F.shiftright("bucket", bits).alias("table")).alias("probe")
    probed = _codes(queries, "query_id", *args, min(probes, bits), seed).select(probe, "vec", "bucket")
    filed = _codes(chunks, "chunk_id", *args, 0, seed)
    hits = block_top_k(probed, filed, k, "probe", "chunk_id", bucket="bucket", **blocks)
    best = top_k(hits.select("probe.query_id", "chunk_id", "score").distinct(), ["query_id"], [F.col("score").desc(), F.col("chunk_id")], k)
    return best.select("query_id", "chunk_id", round_half_up(F.col("score"), 4).alias("similarity_score"), "rank")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: exact hits, and how many of them were found."""
    both = exact.select("query_id", "chunk_id").join(found.select("query_id", "chunk_id", F.lit(1).alias("_f")).distinct(), ["query_id", "chunk_id"], "left")
    return both.agg(F.count(F.lit(1)).alias("exact_hits"), F.count("_f").alias("found"))
