"""Ranked lexical search: Block-Max MaxScore over an index in document shards.

A shard is an inverted index of its own: per term the documents in ascending id order, in blocks of
compressed postings. A block keeps its largest tf and its smallest ratio of length to tf, which
together bound any impact in it for whatever N and L the whole corpus turns out to have. A query
sorts a shard's lists by their bounds: lists whose bounds add up to less than the k-th score known are
not essential, so only documents of the others are candidates; a candidate is dropped as soon as
its score so far, the bound of the next list's block at its place and the bounds of the lists after
that stay below the k-th score, and only blocks that still hold candidates are decompressed. The
shards' k best are merged by one window.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.common import alnum_words, map_batches, stage, texts
from marquee.llm.postings import words

SHARD_BYTES, SHARD_DOCS = 16 << 20, 1 << 16  # of text and documents in a shard; one text alone may be longer
PIECE_BYTES = 1 << 20  # of a text split into words at once
BLOCK = 128  # postings
BROADCAST_BYTES = 32 << 20
QUERY_BLOCK = 1000  # items searched at once in a shard
UNIT, SATURATION, FLAT, SLOPE = 1_000_000_000, 1000, 25, 75
NONE = np.iinfo(np.int64).max  # stands for a null id, behind all others

# A row is a term of a shard. Row '' holds the shard's documents: ids (null is NONE) and lengths.
INDEX = ("shard bigint, term string, df bigint, n_terms bigint, last binary, most_tf binary, least_ratio binary, wide binary, at binary, data binary, "
         "ids binary, lengths binary")
_INDEX = pa.schema([("shard", pa.int64()), ("term", pa.string()), ("df", pa.int64()), ("n_terms", pa.int64())]
                   + [(c, pa.binary()) for c in ("last", "most_tf", "least_ratio", "wide", "at", "data", "ids", "lengths")])


# --- index ---------------------------------------------------------------------------


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored index of all terms of all documents. Texts are read once and nothing is shuffled."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part = _Shard(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for i, t in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                if shard.ids and (shard.bytes + len(t) > SHARD_BYTES or len(shard.ids) == SHARD_DOCS):
                    yield from shard.rows(part)
                    shard, part = _Shard(), part + 1
                shard.add(i, t)
        if shard.ids:
            yield from shard.rows(part)

    return stage(map_batches(rows, INDEX, run), "index")


class _Shard:
    """Documents of a shard on their way to postings; texts without terms are left out."""

    def __init__(self):
        self.numbers = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.ids, self.words, self.bytes = [], [], 0

    def add(self, doc_id, text: bytes) -> None:
        runs, at = [], 0
        while at < len(text):  # a very long text piece by piece, cut at blanks
            end = text.find(b" ", at + PIECE_BYTES)
            end = len(text) if end < 0 else end
            found = alnum_words(text[at:end])
            runs.append(np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found)))
            at = end
        if sum(map(len, runs)):
            self.ids.append(NONE if doc_id is None else doc_id)
            self.words.append(np.concatenate(runs) if len(runs) > 1 else runs[0])
            self.bytes += len(text)

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        lengths = np.array([len(w) for w in self.words], np.int64)
        ids = np.array(self.ids, np.int64)
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        ids, lengths_by_id = ids[order], lengths[order]
        key = np.concatenate(self.words).astype(np.int64) << 16 | np.repeat(place, lengths)
        self.words = []
        key, tf = np.unique(key, return_counts=True)
        lists = Lists(key >> 16, key & 0xFFFF, tf, lengths_by_id, len(self.numbers))
        names = [n.decode("utf-8", "replace") for n in self.numbers]
        one = {"shard": shard, "term": "", "df": len(ids), "n_terms": int(lengths.sum()), "ids": ids.tobytes(), "lengths": lengths_by_id.tobytes()}
        yield pa.RecordBatch.from_pylist([one], schema=_INDEX)
        for lo in range(0, len(names), 50_000):
            hi = min(lo + 50_000, len(names))
            cols = {"shard": pa.array(np.full(hi - lo, shard, np.int64)), "term": pa.array(names[lo:hi]), "df": pa.array(lists.df[lo:hi]), "n_terms": pa.nulls(hi - lo, pa.int64()),
                    "ids": pa.nulls(hi - lo, pa.binary()), "lengths": pa.nulls(hi - lo, pa.binary())} | lists.columns(lo, hi)
            yield pa.RecordBatch.from_arrays([cols[f.name] for f in _INDEX], schema=_INDEX)


class Lists:
    """Postings by (term, document) cut into blocks: gaps of one or two bytes, tf of one or four."""

    def __init__(self, term, doc, tf, lengths, terms: int):
        n = len(term)
        self.df = np.bincount(term, minlength=terms).astype(np.int64)
        start = np.concatenate([[0], np.cumsum(self.df)])
        within = np.arange(n) - start[term]
        head = np.flatnonzero(within % BLOCK == 0)
        ends = np.append(head[1:], n)
        gap = doc - np.concatenate([[0], doc[:-1]])
        gap[within == 0] = doc[within == 0]
        if n:
            most_tf = np.maximum.reduceat(tf, head)
            ratio = np.minimum.reduceat(lengths[doc] // tf, head)
            wide = (np.maximum.reduceat(gap, head) > 255) * 1 + (most_tf > 255) * 2
        else:
            most_tf = ratio = wide = np.zeros(0, np.int64)
        block = np.repeat(np.arange(len(head)), ends - head)
        gap_bytes, tf_bytes = 1 + (wide & 1), 1 + 3 * (wide >> 1)
        size = (ends - head) * (gap_bytes + tf_bytes)
        self.from_byte = np.concatenate([[0], np.cumsum(size)])
        data = np.zeros(self.from_byte[-1], np.uint8)
        i = np.arange(n) - head[block] if n else np.zeros(0, np.int64)
        base = self.from_byte[block]
        place, two = base + i * gap_bytes[block], (wide[block] & 1).astype(bool)
        data[place] = gap & 255
        data[place[two] + 1] = gap[two] >> 8
        place = base + (ends - head)[block] * gap_bytes[block] + i * tf_bytes[block]
        data[place] = tf & 255
        four = wide[block] >> 1 == 1
        for b in (1, 2, 3):
            data[place[four] + b] = tf[four] >> (8 * b) & 255
        self.data = data
        self.block_of = np.concatenate([[0], np.cumsum(-(-self.df // BLOCK))])  # first block of each term
        last = doc[ends - 1] if n else np.zeros(0, np.int64)
        at = self.from_byte[:-1] - np.repeat(self.from_byte[self.block_of[:-1]], np.diff(self.block_of))
        self.meta = {"last": last.astype("u2"), "most_tf": most_tf.astype("u4"), "least_ratio": np.minimum(ratio, 0xFFFFFFFF).astype("u4"),
                     "wide": wide.astype("u1"), "at": at.astype("u4")}

    def columns(self, lo: int, hi: int) -> dict[str, pa.Array]:
        """The binary columns of terms ``lo`` to ``hi``."""
        cut = self.block_of[lo:hi + 1]

        def binary(values, edges):
            data = values[edges[0]:edges[-1]]
            return pa.BinaryArray.from_buffers(pa.binary(), hi - lo, [None, pa.py_buffer(((edges - edges[0]) * values.itemsize).astype("i4").tobytes()), pa.py_buffer(data.tobytes())])

        return {c: binary(v, cut) for c, v in self.meta.items()} | {"data": binary(self.data, self.from_byte[cut])}


# --- search --------------------------------------------------------------------------


class Stored:
    """A stored list: block bounds at hand, postings decompressed block by block when asked for."""

    def __init__(self, row: dict, scale: float):
        self.last = np.frombuffer(row["last"], "u2").astype(np.int64)
        self.wide, self.at = np.frombuffer(row["wide"], "u1"), np.frombuffer(row["at"], "u4")
        self.data, self.df = row["data"], row["df"]
        most, ratio = np.frombuffer(row["most_tf"], "u4"), np.frombuffer(row["least_ratio"], "u4")
        # m > 24 + 75 n N / L, and m / tf is least where tf is most and n / tf least
        self.bound = np.floor(UNIT / (SATURATION + 8 * ((FLAT - 1) / most + SLOPE * scale * ratio))).astype(np.int64) + 1
        self.most = int(self.bound.max())
        self.opened: dict[int, tuple] = {}

    def block(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, tf) of a block."""
        if b not in self.opened:
            n = min(BLOCK, self.df - b * BLOCK)
            g, f = ("u1", "<u2")[self.wide[b] & 1], ("u1", "<u4")[self.wide[b] >> 1]
            at = int(self.at[b])
            gaps = np.frombuffer(self.data, g, n, at).astype(np.int64)
            tf = np.frombuffer(self.data, f, n, at + n * (1 + int(self.wide[b] & 1))).astype(np.int64)
            gaps[0] += self.last[b - 1] if b else 0
            self.opened[b] = np.cumsum(gaps), tf
        return self.opened[b]

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(b) for b in range(len(self.last))]
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


class Searcher:
    """One shard: its lists and documents, searched by one item after the other."""

    def __init__(self, lists: dict[str, Stored], ids: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int):
        self.lists, self.ids = lists, ids
        self.m = 8 * (FLAT + SLOPE * lengths * n_docs // n_terms)

    def impact(self, docs: np.ndarray, tf: np.ndarray) -> np.ndarray:
        return UNIT * tf // (SATURATION * tf + self.m[docs])

    def add(self, name: str, weight: int, docs: np.ndarray, scores: np.ndarray, blocks: np.ndarray, inside: np.ndarray) -> None:
        """Add a list's share to the scores of the documents that it holds; opens the blocks they fall into."""
        known = self.lists[name]
        where = np.flatnonzero(inside)
        cuts = np.flatnonzero(np.diff(blocks[where], prepend=-1))
        for lo, hi in zip(cuts, np.append(cuts[1:], len(where))):
            held, tf = known.block(int(blocks[where[lo]]))
            some = where[lo:hi]
            at = np.searchsorted(held, docs[some])
            hit = held[np.minimum(at, len(held) - 1)] == docs[some]
            at, some = at[hit], some[hit]
            scores[some] += weight * self.impact(docs[some], tf[at])

    def run(self, terms: list[tuple[str, int]], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the item's k best in the shard; ``terms`` are (term, weight times its repeats)."""
        terms = sorted(((w * self.lists[t].most, t, w) for t, w in terms if w > 0), reverse=True)
        if not terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        rest = np.cumsum([b for b, _, _ in terms][::-1])[::-1].tolist() + [0]  # bounds of a list and all after it
        least = self.seed(terms, k)
        essential = next((i for i in range(1, len(terms)) if rest[i] < least), len(terms))
        found = [self.lists[t].all() for _, t, _ in terms[:essential]]
        docs = np.unique(np.concatenate([d for d, _ in found]))
        scores = np.zeros(len(docs), np.int64)
        for (d, tf), (_, _, w) in zip(found, terms):
            scores[np.searchsorted(docs, d)] += w * self.impact(d, tf)
        for i in range(essential, len(terms)):
            _, t, w = terms[i]
            known = self.lists[t]
            alive = scores + rest[i] >= least
            docs, scores = docs[alive], scores[alive]
            blocks = np.searchsorted(known.last, docs)
            inside = blocks < len(known.last)
            bound = np.where(inside, w * known.bound[np.minimum(blocks, len(known.last) - 1)], 0)
            alive = scores + bound + rest[i + 1] >= least
            docs, scores, blocks, inside = docs[alive], scores[alive], blocks[alive], inside[alive]
            self.add(t, w, docs, scores, blocks, inside)
            if len(docs) > k:
                least = max(least, int(np.partition(scores, -k)[-k]))
        keep = np.lexsort((docs, -scores))[:k]
        return docs[keep], scores[keep]

    def seed(self, terms: list, k: int) -> int:
        """A score that k documents reach: whole scores of documents from the highest lists on."""
        parts, seen = [], 0
        for _, t, _ in terms:
            for b in range(len(self.lists[t].last)):
                if seen < 4 * k:
                    parts.append(self.lists[t].block(b)[0])
                    seen += len(parts[-1])
        docs = np.concatenate(parts)
        docs = np.unique(docs)
        if len(docs) < k:
            return 0
        scores = np.zeros(len(docs), np.int64)
        for _, t, w in terms:
            blocks = np.searchsorted(self.lists[t].last, docs)
            self.add(t, w, docs, scores, blocks, blocks < len(self.lists[t].last))
        return int(np.partition(scores, -k)[-k])


def fitting(df: DataFrame, size: str) -> DataFrame:
    """Broadcast if the sum of ``size`` (bytes of a row) is small; else Spark joins by shuffle."""
    total = df.agg(F.expr(f"sum({size})")).first()[0] or 0
    return F.broadcast(df) if total <= BROADCAST_BYTES else df


def search(index: DataFrame, items: DataFrame, k: int = 10, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id rank doc_id score`` of every row of ``items`` over a stored index."""
    spark = index.sparkSession
    docs = index.where("term = ''").agg(F.coalesce(F.sum("df"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
    rows = stage(items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("ws")).withColumn("item", F.monotonically_increasing_id()), "items")
    blocks = max(1, -(-rows.count() // QUERY_BLOCK))
    uses = (rows.select("item", "item_id", F.explode("ws").alias("term")).groupBy("item", "item_id", "term").agg(F.count("*").alias("times"))
            .withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))))
    uses = stage(uses, "item-terms")
    terms = stage(uses.select("term").distinct(), "terms")
    held = index.select("term", "df").join(fitting(terms, "octet_length(term) + 16"), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    w = F.floor(F.lit(1000.0) * F.log((F.lit(2 * docs.n + 2).cast("double")) / (2 * F.col("df") + 1).cast("double")))
    asked = uses.join(held, "term").select("block", "term", F.struct("item", (w * F.col("times")).cast("bigint").alias("weight")).alias("use"))
    asked = asked.groupBy("block", "term").agg(F.collect_list("use").alias("uses"))
    none = F.array().cast("array<struct<item:bigint,weight:bigint>>")
    asked = stage(asked.unionByName(spark.range(blocks).select(F.col("id").alias("block"), F.lit("").alias("term"), none.alias("uses"))), "asked")
    lists = index.drop("n_terms").join(fitting(asked, "octet_length(term) + 32 + 24 * size(uses)"), "term")

    def run(group: pa.Table) -> pa.Table:
        lists, by_item, home = {}, defaultdict(list), None
        for row in group.to_pylist():
            if row["term"] == "":
                home = row
                continue
            lists[row["term"]] = Stored(row, docs.n / docs.l)
            for use in row["uses"]:
                by_item[use["item"]].append((row["term"], use["weight"]))
        ids = np.frombuffer(home["ids"], np.int64)
        searcher = Searcher(lists, ids, np.frombuffer(home["lengths"], np.int64), docs.n, docs.l)
        found = [(item, *searcher.run(used, k)) for item, used in by_item.items()]
        n = [len(d) for _, d, _ in found]
        at = np.concatenate([np.zeros(0, np.int64), *(d for _, d, _ in found)])
        scores = np.concatenate([np.zeros(0, np.int64), *(s for _, _, s in found)])
        return pa.table({"item": np.repeat(np.array([i for i, _, _ in found], np.int64), n), "doc_id": pa.array(ids[at], mask=ids[at] == NONE), "score": scores})

    hits = lists.groupBy("shard", "block").applyInArrow(run, "item bigint, doc_id bigint, score bigint").where("score > 0")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    top = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = rows.select("item", "item_id")
    return top.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text",
                  item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """Per row of ``items`` its ``k`` best documents: ``item_id rank doc_id score``.

    Null and empty texts have no terms: such documents are not counted and never found, such items
    find nothing. Equal scores go by ascending doc_id, a null id last; repeated rows are
    documents of their own and each takes a rank. A repeated item_id is an item for each of its rows. Other
    columns are not read; an empty table on either side gives no rows. The largest 64-bit
    integer as a doc_id stands for null.
    """
    return search(build_index(docs, doc_id, text), items, k, item_id, item_text)


SQL = r"""
WITH t AS (SELECT row_number() OVER () AS d, doc_id,
  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM documents),
q AS (SELECT i, item_id, term, count(*) AS times FROM (SELECT row_number() OVER () AS i, item_id,
  unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
n AS (SELECT d, doc_id, count(*)::BIGINT AS n FROM t GROUP BY ALL),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
p AS (SELECT d, term, count(*)::BIGINT AS tf FROM t WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM p, c GROUP BY term, docs),
s AS (SELECT i, item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * docs) // c.terms))))::BIGINT AS score
  FROM p JOIN q USING (term) JOIN w USING (term) JOIN n USING (d), c GROUP BY i, item_id, d, doc_id),
r AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 10"""
