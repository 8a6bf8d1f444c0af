"""Repeated byte strings across documents: maximal repeats from the interval tree of an enhanced suffix array.

Suffixes are sampled by content: of every ``LENGTH`` bytes the places of the least ``GRAM``-byte
hash are anchors, so equal strings of that length share an anchor at the same offset. Anchors
whose hash occurs once are dropped; the rest are sorted with their contexts, hash by hash, as one
array of suffixes to the right and one of reversed prefixes to the left of the anchor.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import map_batches, stage, texts

LENGTH = 100
GRAM = 40
SPREAD = LENGTH - GRAM + 1  # hashes in a string of LENGTH bytes
LEFT, RIGHT = LENGTH - GRAM, LENGTH  # bytes of context before and from an anchor on
BUCKET_BYTES = 64 << 20  # text bytes whose anchors meet in one task
BUCKET_ANCHORS = 60_000  # anchors with contexts that meet in one task
HOT = 20_000  # anchors of one hash; beyond, the strings around them are grouped by Spark instead
BROADCAST_ROWS = 200_000
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_POWERS = [np.ones(1, _U), np.ones(1, _U)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(max(n, 1 << 16), base, _U)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps, dtype=_U)
    return _POWERS[0][:n], _POWERS[1][:n]


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A mixed 64-bit hash of the ``GRAM`` bytes from every place."""
    power, inverse = _powers(len(data))
    sums = np.zeros(len(data) + 1, _U)
    np.cumsum((data.astype(_U) + _U(1)) * power, out=sums[1:], dtype=_U)
    h = (sums[GRAM:] - sums[:-GRAM]) * inverse[: len(data) - GRAM + 1]
    h = (h ^ (h >> _U(32))) * _U(0xD6E8FEB86659FD93)
    return h ^ (h >> _U(29))


def _sliding(x: np.ndarray, width: int, op) -> np.ndarray:
    done = 1
    while done * 2 <= width:
        x = op(x[:-done], x[done:])
        done *= 2
    return op(x[: len(x) - (width - done)], x[width - done:]) if done < width else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes): where a hash is the least of some ``SPREAD`` consecutive ones; all of equal least ones."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    h = gram_hashes(data)
    least = _sliding(h, SPREAD, np.minimum)
    around = np.concatenate([np.zeros(SPREAD - 1, _U), least, np.zeros(SPREAD - 1, _U)])
    places = np.flatnonzero(_sliding(around, SPREAD, np.maximum) == h)
    return places, h[places]


# --- the interval tree -------------------------------------------------------------


def lcp(a: int, b: int, width: int) -> int:
    """Equal leading bytes of two numbers of ``width`` bytes."""
    return width - ((a ^ b).bit_length() + 7) // 8


def intervals(lcps: list[int], least: int) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last): the common-prefix intervals of a sorted list with the given neighbour LCPs, by a stack scan."""
    stack: list[tuple[int, int]] = []  # (depth, first)
    for i, depth in enumerate([*lcps, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i
        if depth >= least and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


class Occurrence:
    """An anchor in a document: its order, and its contexts as numbers; 0xFF, which UTF-8 never holds, fills up past an end."""

    __slots__ = ("order", "row", "right", "left", "n_right", "n_left")

    def __init__(self, order, row: int, context: bytes, n_left: int, n_right: int):
        self.order, self.row, self.n_left, self.n_right = order, row, n_left, n_right
        self.left = int.from_bytes(context[:n_left][::-1].ljust(LEFT, b"\xff"), "big")
        self.right = int.from_bytes(context[n_left:].ljust(RIGHT, b"\xff"), "big")


def maximal_repeats(group: list[Occurrence]) -> Iterator[tuple[int, int, list[Occurrence]]]:
    """(left, right, occurrences): maximal strings of ``LENGTH`` or more bytes around one anchor hash, with all their occurrences.

    Every interval of the right suffixes is a string that cannot grow to the right for all of its
    occurrences; they are sorted by their left contexts, and each interval of these whose own right
    extension is diverse is left- and right-maximal (up to the contexts' ends).
    """
    by_right = sorted(group, key=lambda o: o.right)
    for depth, first, last in intervals([_lcp_right(a, b) for a, b in zip(by_right, by_right[1:])], GRAM):
        members = sorted(by_right[first:last + 1], key=lambda o: o.left)
        if depth == RIGHT and LENGTH <= depth:
            common = _lcp_left(members[0], members[-1])
            if common == LEFT:
                yield LEFT, depth, members
                continue
        for left, a, b in intervals([_lcp_left(x, y) for x, y in zip(members, members[1:])], LENGTH - depth):
            some = members[a:b + 1]
            low, high = min(some, key=lambda o: o.right), max(some, key=lambda o: o.right)
            if _lcp_right(low, high) == depth:
                yield left, depth, some


def _lcp_right(a: Occurrence, b: Occurrence) -> int:
    return min(lcp(a.right, b.right, RIGHT), a.n_right, b.n_right)


def _lcp_left(a: Occurrence, b: Occurrence) -> int:
    return min(lcp(a.left, b.left, LEFT), a.n_left, b.n_left)


# --- distributed steps -----------------------------------------------------------------


def repeated_anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """(text_hash, places, hot): per text the anchors whose hash occurs twice or more, u32 places and a flag byte each.

    A map task packs its anchors by bucket of the hash; what meets in a bucket are hashes and places, no text.
    """

    most = HOT

    def pack(batches):
        held, n = [], 0
        for batch in batches:
            for key, data in zip(batch.column("text_hash").to_pylist(), texts(batch, "data")):
                places, hashes = anchors(np.frombuffer(data, np.uint8))
                if len(places):
                    held.append((key, places, hashes))
                    n += len(places)
                if n > 2_000_000:
                    yield _packed(held, buckets)
                    held, n = [], 0
        if held:
            yield _packed(held, buckets)

    def meet(table):
        parts = [_unpack(x) for x in table.column("anchors").to_pylist()]
        hashes = np.concatenate([p[0] for p in parts])
        keys = np.concatenate([p[1] for p in parts])
        places = np.concatenate([p[2] for p in parts])
        order = np.argsort(hashes, kind="stable")
        sorted_ = hashes[order]
        first = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
        sizes = np.diff(np.append(np.flatnonzero(first), len(sorted_)))
        n = np.repeat(sizes, sizes)
        again = order[n > 1]
        hot = (n[n > 1] > most).astype(np.uint8)
        by_text = np.lexsort((places[again], keys[again]))
        again, hot = again[by_text], hot[by_text]
        texts_, starts = np.unique(keys[again], return_index=True)
        ends = np.append(starts[1:], len(again))
        return pa.table({"text_hash": pa.array(texts_), "places": pa.array([places[again[a:b]].astype("<u4").tobytes() for a, b in zip(starts, ends)], pa.binary()),
                         "hot": pa.array([hot[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary())})

    packed = map_batches(docs.select("text_hash", "data"), "bucket int, anchors binary", pack)
    return packed.groupBy("bucket").applyInArrow(meet, "text_hash bigint, places binary, hot binary")


def _packed(held, buckets: int) -> pa.RecordBatch:
    hashes = np.concatenate([h for _, _, h in held])
    places = np.concatenate([p for _, p, _ in held]).astype(np.uint32)
    index = np.repeat(np.arange(len(held), dtype=np.uint32), [len(p) for _, p, _ in held])
    keys = np.array([k for k, _, _ in held], np.int64)
    bucket = (hashes % _U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    rows = {"bucket": [], "anchors": []}
    for b in range(buckets):
        some = order[cuts[b]:cuts[b + 1]]
        if len(some):
            used, inverse = np.unique(index[some], return_inverse=True)
            head = np.array([len(some), len(used)], np.uint32).tobytes()
            slim = zlib.compress(inverse.astype(np.uint32).tobytes() + places[some].tobytes(), 1)
            rows["bucket"].append(b)
            rows["anchors"].append(head + hashes[some].tobytes() + keys[used].tobytes() + slim)
    return pa.RecordBatch.from_pydict({"bucket": pa.array(rows["bucket"], pa.int32()), "anchors": pa.array(rows["anchors"], pa.binary())})


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k = np.frombuffer(data, np.uint32, 2).tolist()
    hashes = np.frombuffer(data, _U, n, 8)
    keys = np.frombuffer(data, np.int64, k, 8 + 8 * n)
    slim = np.frombuffer(zlib.decompress(data[8 + 8 * (n + k):]), np.uint32)
    return hashes, keys[slim[:n]], slim[n:]


CONTEXT = "anchor bigint, doc_id bigint, text_hash bigint, place bigint, n_left int, context binary, hot boolean, low bigint, high bigint"


def contexts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """A row per anchor with its context. Of equal contexts in a batch only the first in order goes on;
    the others are covered from end to end, which ``low`` and ``high`` say."""
    ids = found.select("text_hash").distinct()
    few = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
    rows = docs.join(few, "text_hash", "left_semi").select("text_hash", "doc_id", "data").join(found.groupBy("text_hash").agg(
        F.collect_list(F.struct("places", "hot")).alias("found")), "text_hash")

    def run(batches):
        for batch in batches:
            seen: dict[bytes, int] = {}
            out = []
            docs_ = sorted(zip(batch.column("doc_id").to_pylist(), batch.column("text_hash").to_pylist(), texts(batch, "data"), batch.column("found").to_pylist()),
                           key=lambda d: _order(d[0], d[1]))
            for doc_id, key, data, lists in docs_:
                places = np.concatenate([np.frombuffer(x["places"], "<u4") for x in lists]).astype(np.int64)
                hot = np.concatenate([np.frombuffer(x["hot"], np.uint8) for x in lists])
                order = np.argsort(places)
                places, hot = places[order], hot[order]
                ok = places + GRAM <= len(data)
                hashes = gram_hashes(np.frombuffer(data, np.uint8))[places[ok]] if ok.any() else []
                for place, h, is_hot in zip(places[ok].tolist(), np.asarray(hashes, _U).view(np.int64).tolist(), hot[ok].tolist()):
                    start = max(0, place - LEFT)
                    context = data[start:place + RIGHT]
                    same = (place - start).to_bytes(1, "big") + context
                    if len(context) >= LENGTH and same in seen:
                        out.append((h, doc_id, key, place, place - start, None, False, start, start + len(context)))
                    elif len(context) >= LENGTH:
                        seen[same] = 1
                        out.append((h, doc_id, key, place, place - start, context, bool(is_hot), None, None))
                    if len(out) >= 20_000:
                        yield _context_batch(out)
                        out = []
            yield _context_batch(out)

    return map_batches(rows, CONTEXT, run)


def _context_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in CONTEXT.split(", ")]
    columns = list(zip(*rows)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def _order(doc_id: int | None, key: int, place: int = 0) -> tuple:
    """Null ids first, then by id; different texts of one id by hash."""
    return (doc_id is not None, doc_id or 0, key, place)


def _groups(table: pa.Table) -> tuple[dict[int, list[Occurrence]], list[tuple]]:
    doc, key, place = (table.column(c).to_pylist() for c in ("doc_id", "text_hash", "place"))
    groups: dict[int, list[Occurrence]] = defaultdict(list)
    for i, (h, n_left, context) in enumerate(zip(table.column("anchor").to_pylist(), table.column("n_left").to_pylist(), table.column("context").to_pylist())):
        groups[h].append(Occurrence(_order(doc[i], key[i], place[i]), i, context, n_left, len(context) - n_left))
    return groups, list(zip(doc, key, place))


def _bucketed(rows: DataFrame, buckets: int):
    return rows.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(buckets)).alias("bucket"))


def later_occurrences(rows: DataFrame, buckets: int) -> DataFrame:
    """(doc_id, text_hash, low, high): per anchor the bytes covered by repeats of which it is not the first occurrence."""

    def run(table):
        groups, at = _groups(table)
        low: dict[int, int] = {}
        high: dict[int, int] = {}
        for group in groups.values():
            if len(group) < 2:
                continue
            for left, right, some in maximal_repeats(group):
                first = min(some, key=lambda o: o.order)
                for o in some:
                    if o is not first:
                        place = at[o.row][2]
                        low[o.row] = min(low.get(o.row, place), place - left)
                        high[o.row] = max(high.get(o.row, 0), place + right)
        got = [(*at[i][:2], low[i], high[i]) for i in low]
        columns = list(zip(*got)) if got else [()] * 4
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("doc_id", "text_hash", "low", "high"), columns)})

    return _bucketed(rows, buckets).applyInArrow(run, "doc_id bigint, text_hash bigint, low bigint, high bigint")


def hot_strings(rows: DataFrame) -> DataFrame:
    """The same coverage for anchors of a very frequent hash: their strings of ``LENGTH`` bytes are grouped by
    Spark, with sums before the shuffle, so that no task holds the group."""
    at = F.explode(F.sequence(F.lit(0), F.octet_length("context") - LENGTH)).alias("at")
    strings = rows.select("doc_id", "text_hash", (F.col("place") - F.col("n_left")).alias("base"), "context", at)
    strings = strings.select(F.md5(F.substring("context", F.col("at") + 1, F.lit(LENGTH))).alias("string"),
                             F.struct("doc_id", "text_hash", (F.col("base") + F.col("at")).alias("start")).alias("o"))
    first = strings.groupBy("string").agg(F.min("o").alias("first"))
    later = strings.join(first, "string").where(~F.col("o").eqNullSafe(F.col("first")))
    return later.select("o.doc_id", "o.text_hash", F.col("o.start").alias("low"), (F.col("o.start") + LENGTH).alias("high"))


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Per document row: ``doc_id n_bytes n_removed n_spans spans kept`` (kept: the remaining bytes).

    A byte goes if a string of ``LENGTH`` bytes over it also starts earlier, in a document with a
    smaller id or further to the front of its own. All documents of an equal text of that length
    but the first are dropped whole before anchors are taken: nothing starts first in them. Null
    texts are empty; texts shorter than ``LENGTH`` lose nothing. Null ids come first, and of rows
    that repeat id and text one is the first. An empty table gives no rows; other columns are not read.
    """
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), data.alias("data")).withColumn("text_hash", F.xxhash64("data"))
    slim = stage(rows.select("doc_id", "text_hash", F.md5("data").alias("md5"), F.octet_length("data").cast("bigint").alias("n_bytes")), "texts")
    long = slim.where(F.col("n_bytes") >= LENGTH)
    firsts = long.groupBy("md5").agg(F.min(F.struct("doc_id")).alias("first"), F.count("*").alias("n")).where("n > 1")
    copies = stage(long.join(firsts, "md5").where(~F.col("doc_id").eqNullSafe(F.col("first.doc_id"))).select("doc_id", "text_hash").distinct(), "copies")
    copy_ids = F.broadcast(copies) if copies.count() <= BROADCAST_ROWS else copies
    same = rows["doc_id"].eqNullSafe(copies["doc_id"]) & (rows["text_hash"] == copies["text_hash"])
    originals = rows.join(copy_ids, same, "left_anti")
    again = long.groupBy("doc_id", "text_hash").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id"), F.col("text_hash").alias("again_hash"))
    again = stage(again, "again")
    some_again = not again.isEmpty()

    def twice(df: DataFrame):
        return df["doc_id"].eqNullSafe(again["again_id"]) & (df["text_hash"] == again["again_hash"])

    if some_again:
        once = originals.join(again, twice(originals), "left_semi").dropDuplicates(["doc_id", "text_hash"])
        originals = originals.join(again, twice(originals), "left_anti").unionByName(once)
    total = slim.agg(F.sum("n_bytes")).first()[0] or 0
    found = stage(repeated_anchors(originals, max(12, -(-total // BUCKET_BYTES))), "repeated-anchors")
    n_found = (found.agg(F.sum(F.octet_length("places"))).first()[0] or 0) // 4
    around = stage(contexts(originals, found), "contexts")
    covered = around.where("low IS NOT NULL").select("doc_id", "text_hash", "low", "high")
    open_ = around.where("low IS NULL")
    covered = covered.unionByName(later_occurrences(open_.where("NOT hot"), max(12, -(-n_found // BUCKET_ANCHORS)))).unionByName(hot_strings(open_.where("hot")))
    spans = covered.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    decided = spans.select("doc_id", "text_hash", "spans", F.lit(False).alias("copy")).unionByName(
        copies.select("doc_id", "text_hash", F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("spans"), F.lit(True).alias("copy")))
    decided = stage(decided, "decided")
    ids = decided.select("doc_id", "text_hash")
    few = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids

    def touched(df: DataFrame, to: DataFrame):
        return df["doc_id"].eqNullSafe(to["doc_id"]) & (df["text_hash"] == to["text_hash"])

    # only texts that lose something are shuffled to their spans
    losing = rows.join(few, touched(rows, ids), "left_semi")
    losing = losing.join(decided, touched(losing, decided)).select(losing["doc_id"], losing["text_hash"], "data", "spans", "copy")
    whole = rows.join(few, touched(rows, ids), "left_anti").select(
        "doc_id", "text_hash", "data", F.lit(None).cast("array<struct<low:bigint,high:bigint>>").alias("spans"), F.lit(False).alias("copy"))
    joined = losing.unionByName(whole)
    if some_again:
        # of rows that repeat id and text all but one are copies
        number = F.row_number().over(Window.partitionBy("doc_id", "text_hash").orderBy("copy"))
        some = joined.join(again, twice(joined), "left_semi").withColumn("copy", F.col("copy") | (number > 1))
        joined = joined.join(again, twice(joined), "left_anti").unionByName(some)

    def run(batches):
        for batch in batches:
            out = {"n_bytes": [], "n_removed": [], "n_spans": [], "spans": [], "kept": []}
            for text, spans, copy in zip(texts(batch, "data"), batch.column("spans").to_pylist(), batch.column("copy").to_pylist()):
                gone = [(0, len(text))] if copy else merge([(s["low"], s["high"]) for s in spans or ()])
                cuts = [0, *(x for s in gone for x in s), len(text)]
                values = (len(text), sum(b - a for a, b in gone), len(gone), [{"start": a, "end": b} for a, b in gone],
                          b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                for column, value in zip(out.values(), values):
                    column.append(value)
            kinds = [pa.int64()] * 3 + [pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")] + [pa.array(c, k) for c, k in zip(out.values(), kinds)], names=["doc_id", *out])

    return map_batches(joined.select("doc_id", "data", "spans", "copy"),
                       "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, spans array<struct<start:bigint,end:bigint>>, kept binary", run)
