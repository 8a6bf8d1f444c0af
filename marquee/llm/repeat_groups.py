"""Groups of maximal repeats with all their places, from the interval trees of ``repeats``.

Work is done on distinct texts. Anchors are counted by hash with partial sums, and equal contexts
are one class, so a passage that stands in many documents is one row until its places are joined
back. A tree is built for the classes of one string around an anchor; where these are more than
``HOT``, the string is first grown as far as all agree, by least and greatest contexts that Spark
aggregates, and its classes go on by the next byte to the right and by the next one to the left.
"""

from __future__ import annotations

from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import map_batches, stage, texts
from marquee.llm.repeats import BUCKET_ANCHORS, GRAM, LEFT, LENGTH, RIGHT, Occurrence, anchors, maximal_repeats

HOT = 20_000  # classes of one string in one tree; beyond, they go on by one more byte


def maximal_groups(docs: DataFrame) -> DataFrame:
    """A row per place of each group: ``group_id length n_places doc_id start``, starts and lengths in bytes.

    A group is a string of ``LENGTH`` bytes or more with all its places, two at least, in all texts.
    Every string of ``LENGTH`` bytes with several places lies in a group that has just its places.
    A group cannot grow to a side in all its places, with one exception: a stretch of ``LEFT + RIGHT``
    bytes or more that has further places, and so is in a group itself, may part what lies before it
    from what lies after. Long periodic texts are such stretches.

    Null texts are empty, and shorter ones than ``LENGTH`` hold nothing. Each row is a document of
    its own: rows that repeat a text, or id and text, are places apart, and a null id comes out as
    null. An empty table gives no rows; other columns are not read.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), data.alias("data")).where(F.octet_length("data") >= LENGTH)
    rows = rows.withColumn("text", F.unhex(F.md5("data")))
    bodies = stage(rows.groupBy("text").agg(F.first("data").alias("data"), F.count("*").alias("n_docs")), "bodies")
    found = stage(_anchors(bodies), "anchors")
    again = found.groupBy("anchor").agg(F.sum("n_docs").alias("n")).where("n > 1").select("anchor")
    around = stage(_contexts(bodies, found.join(again, "anchor", "left_semi")), "around")
    kind = F.unhex(F.md5(F.concat("left", F.lit(b"\xff"), "right"))).alias("kind")
    classes = around.groupBy(kind, "left", "right").agg(F.sum("n_docs").alias("n_docs"))
    members = stage(_members(stage(classes, "classes")), "members")
    at = around.select(kind, "text", "place", "n_docs")
    places = members.join(at, "kind").select("piece", "length", "text", (F.col("place") - F.col("reach")).alias("start"), "n_docs")
    places = stage(places, "places")
    leaders = stage(_joined(places), "leaders")
    spots = places.select("piece", "text", "start").join(leaders, "piece")
    return spots.join(rows.select("doc_id", "text"), "text").select("group_id", "length", "n_places", "doc_id", "start")


def _anchors(bodies: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for key, n_docs, body in zip(batch.column("text").to_pylist(), batch.column("n_docs").to_pylist(), texts(batch, "data")):
                places, hashes = anchors(np.frombuffer(body, np.uint8))
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.binary()), pa.array([n_docs] * n, pa.int64()), pa.array(places, pa.int64()), pa.array(hashes.view(np.int64), pa.int64())],
                    names=["text", "n_docs", "place", "anchor"])

    return map_batches(bodies, "text binary, n_docs bigint, place bigint, anchor bigint", run)


def _contexts(bodies: DataFrame, found: DataFrame) -> DataFrame:
    """``text n_docs place left right``: the bytes before each anchor, nearest first, and those from it on."""
    listed = found.groupBy("text").agg(F.collect_list("place").alias("places"))

    def run(batches):
        for batch in batches:
            for key, n_docs, body, places in zip(batch.column("text").to_pylist(), batch.column("n_docs").to_pylist(), texts(batch, "data"),
                                                 batch.column("places").to_pylist()):
                n = len(places)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * n, pa.binary()), pa.array([n_docs] * n, pa.int64()), pa.array(places, pa.int64()),
                     pa.array([body[max(0, p - LEFT):p][::-1] for p in places], pa.binary()),
                     pa.array([body[p:p + RIGHT] for p in places], pa.binary())], names=["text", "n_docs", "place", "left", "right"])

    return map_batches(bodies.join(listed, "text"), "text binary, n_docs bigint, place bigint, left binary, right binary", run)


MEMBERS = "piece binary, length bigint, reach int, kind binary"


def _members(classes: DataFrame) -> DataFrame:
    """``piece length reach kind``: the classes each maximal string stands in, ``reach`` bytes before their anchor."""
    open_ = classes.withColumns({"l": F.lit(0), "r": F.lit(GRAM)})
    out, levels = None, 0
    while True:
        keyed = open_.withColumn("key", F.concat(_head("left", "l"), F.lit(b"\xff"), _head("right", "r")))
        hot = stage(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key"), "hot")
        trees = _trees(keyed.join(hot, "key", "left_anti"))
        out = trees if out is None else out.unionByName(trees)
        if hot.isEmpty():
            return out.distinct() if levels else out
        crowd = keyed.join(hot, "key", "left_semi")
        ends = [f(c).alias(f"{n}_{c}") for c in ("left", "right") for n, f in (("least", F.min), ("most", F.max))]
        grown = crowd.drop("l", "r").join(stage(_grown(crowd.groupBy("key").agg(*ends)), "grown"), "key")
        out = out.unionByName(grown.where("piece IS NOT NULL").select("piece", (F.col("l") + F.col("r")).cast("bigint").alias("length"), F.col("l").alias("reach"), "kind"))
        grown = grown.select("kind", "left", "right", "n_docs", "l", "r")
        further = grown.where(F.octet_length("right") > F.col("r")).withColumn("r", F.col("r") + 1).unionByName(
            grown.where(F.octet_length("left") > F.col("l")).withColumn("l", F.col("l") + 1))
        # a string is reached by several orders of growing
        open_ = stage(further.dropDuplicates(["kind", "l", "r"]), "further")
        levels += 1


def _head(name: str, n: str) -> Column:
    return F.substring(F.col(name), F.lit(1), F.col(n))


def _piece(left: bytes, right: bytes) -> bytes | None:
    """The key of a string around an anchor, or none if another of its anchors stands for it.

    Only anchors that the string itself makes so are ones in all its places; the least of those
    whose context holds the string stands for it.
    """
    string = left[::-1] + right
    places, hashes = anchors(np.frombuffer(string, np.uint8))
    own = (places <= LEFT) & (len(string) - places <= RIGHT)
    if not own.any() or places[own][np.argmin(hashes[own])] != len(left):
        return None
    return md5(string).digest()


def _grown(ends: DataFrame) -> DataFrame:
    """``key l r piece``: how far all classes of a key agree, from their least and greatest contexts."""

    def agreed(a: bytes, b: bytes) -> int:
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            l = [agreed(r["least_left"], r["most_left"]) for r in rows]
            r_ = [agreed(r["least_right"], r["most_right"]) for r in rows]
            pieces = [_piece(r["least_left"][:a], r["least_right"][:b]) for r, a, b in zip(rows, l, r_)]
            yield pa.RecordBatch.from_arrays([pa.array([r["key"] for r in rows], pa.binary()), pa.array(l, pa.int32()), pa.array(r_, pa.int32()),
                                              pa.array(pieces, pa.binary())], names=["key", "l", "r", "piece"])

    return map_batches(ends, "key binary, l int, r int, piece binary", run)


def _trees(keyed: DataFrame) -> DataFrame:
    buckets = max(12, -(-keyed.count() // BUCKET_ANCHORS))

    def run(table):
        groups: dict[bytes, list[int]] = {}
        columns = {c: table.column(c).to_pylist() for c in ("key", "kind", "left", "right", "n_docs", "l", "r")}
        for i, key in enumerate(columns["key"]):
            groups.setdefault(key, []).append(i)
        out = []
        for rows in groups.values():
            # a class of several places is entered twice: it is a repeat by itself
            entries = []
            for i in rows:
                left, right = columns["left"][i], columns["right"][i]
                entries += [Occurrence(i, i, left[::-1] + right, len(left), len(right)) for _ in range(min(columns["n_docs"][i], 2))]
            if len(entries) < 2:
                continue
            least = (columns["l"][rows[0]], columns["r"][rows[0]])
            for a, b, some in maximal_repeats(entries):
                i = some[0].row
                if a >= least[0] and b >= least[1] and (piece := _piece(columns["left"][i][:a], columns["right"][i][:b])):
                    out += [(piece, a + b, a, columns["kind"][j]) for j in {o.row for o in some}]
        parts = list(zip(*out)) if out else [()] * 4
        kinds = (pa.binary(), pa.int64(), pa.int32(), pa.binary())
        return pa.table({n.split()[0]: pa.array(c, k) for n, c, k in zip(MEMBERS.split(", "), parts, kinds)})

    return keyed.groupBy(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket")).applyInArrow(run, MEMBERS)


def _joined(places: DataFrame) -> DataFrame:
    """``piece group_id length n_places``: strings that overlap and have the same places, moved, are one; its first piece leads."""
    firsts = places.groupBy("piece", "length").agg(F.min(F.struct("text", "start")).alias("first"), F.sum("n_docs").alias("n_places"))
    moved = places.drop("length").join(firsts, "piece").withColumn("moved", F.col("start") - F.col("first.start"))
    same = moved.groupBy("piece", "length", "first", "n_places").agg(
        F.bit_xor(F.xxhash64("text", "moved")).alias("mark"), F.bit_xor(F.xxhash64("moved", F.lit(1), "text")).alias("mark2"))
    same = same.select("*", F.col("first.text").alias("at"), F.col("first.start").alias("from"), (F.col("first.start") + F.col("length")).alias("to"))
    alike = ["at", "n_places", "mark", "mark2"]
    order = Window.partitionBy(*alike).orderBy("from", "to", "piece")
    before = F.max("to").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = same.withColumn("opens", (F.coalesce(before, F.lit(-1)) < F.col("from")).cast("int"))
    runs = runs.withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = runs.groupBy(*alike, "run").agg(F.min(F.struct("from", "to", "piece")).alias("lead"), F.max("to").alias("to"))
    return ends.select(F.col("lead.piece").alias("piece"), F.md5(F.concat("lead.piece", F.encode(F.concat(F.lit(":"), F.col("to") - F.col("lead.from")), "utf-8"))).alias("group_id"),
                       (F.col("to") - F.col("lead.from")).alias("length"), "n_places")
