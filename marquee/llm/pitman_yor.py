"""Hierarchical Pitman-Yor language model: Chinese-restaurant seatings sampled by Gibbs, averaged predictions.

A token's context is the word before it. Every context has a restaurant of its own; the restaurants
of contexts with the same last two bytes share a parent, and all these endings share the root, whose
base is uniform over the known words and one unknown. Dishes are words. A table of a restaurant is
a customer of its parent.

Words are dealt to buckets, each with all restaurants' seatings of its words, so parents are at
hand; only the numbers of tables and customers are added up between sweeps: those of contexts by
Spark, block by block of contexts, those of endings (a list of fixed length) for all. Nothing that
grows with the corpus is broadcast or collected.
"""

from __future__ import annotations

import math
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import blank_words, map_batches, stage, texts

RESTAURANTS = 1 << 16  # of the level above the contexts: one for each ending of two bytes
HASHED = 48  # bits of a word's hash in the key of its context, below the ending
BURN_IN = 1  # jobs before the first seating that counts
SAMPLES = 2  # seatings averaged; each is one job and the tables' numbers are exchanged between jobs
SWEEPS = 1  # sweeps over all levels in a job
SINGLES = 8  # a sweep moves every customer of dishes with at most so many; larger dishes have so many moves and leaps of whole tables
STRENGTH = 1.0
CHUNK_TOKENS = 2_000_000
CHUNK_DOCS = 1 << 15
BUCKET_BYTES = 32 << 20  # text bytes whose words meet in one bucket
BLOCK_BUCKETS = 2  # buckets whose number of contexts is added up in one task, roughly
SALT_BYTES = 24 << 20  # packed postings that are scored in one task; each such task gets its own copy of the bucket's dishes
END, START = b"\n", b""  # neither can be a word
_U = np.uint64


def held_out(doc_id: int | None) -> bool:
    """One document in ten, by its id; a null id trains."""
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def word_key(word: bytes) -> int:
    """The key of a word, as a dish and as a context: its last two bytes, then its hash."""
    return int.from_bytes(word[-2:], "big") << HASHED | xxhash.xxh3_64_intdigest(word) >> 64 - HASHED


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays in one compressed value, each with its type, its length and its bytes by their place in a number."""
    parts = []
    for a in arrays:
        planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T
        parts += [f"{a.dtype.str:<4}".encode(), len(a).to_bytes(8, "little"), planes.tobytes()]
    return zlib.compress(b"".join(parts), 1)


def _unpack(data: bytes) -> list[np.ndarray]:
    raw, at, out = zlib.decompress(data), 0, []
    while at < len(raw):
        kind, n = np.dtype(raw[at:at + 4].decode().strip()), int.from_bytes(raw[at + 4:at + 12], "little")
        planes = np.frombuffer(raw, np.uint8, n * kind.itemsize, at + 12).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += 12 + n * kind.itemsize
    return out


def _small(a: np.ndarray) -> np.ndarray:
    """Numbers that are not negative, in as few bytes as the largest needs."""
    return a.astype(np.min_scalar_type(int(a.max(initial=0))))


def _gaps(a: np.ndarray, widths: np.ndarray) -> np.ndarray:
    """Rising numbers, group after group, as the steps within a group; each group starts with its first number."""
    out, starts = np.diff(a, prepend=0), np.cumsum(widths) - widths
    out[starts] = a[starts]
    return _small(out)


def _steps(keys: np.ndarray) -> np.ndarray:
    """Rising numbers as their steps; a running sum gives them back."""
    return np.diff(keys, prepend=keys.dtype.type(0))


def _ungap(gaps: np.ndarray, widths: np.ndarray) -> np.ndarray:
    widths = widths.astype(np.int64)
    sums, starts = np.cumsum(gaps, dtype=np.int64), np.cumsum(widths) - widths
    return sums - np.repeat(sums[starts] - gaps[starts], widths)


# --- counting -----------------------------------------------------------------------


class _Chunk:
    """Tokens of some documents, numbered by the words met so far."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.words: list[bytes] = []
        self.tokens: list[np.ndarray] = []
        self.doc_ids: list[int | None] = []
        self.n_tokens = 0
        for w in (START, END):
            self._number(w)

    def _number(self, word: bytes) -> None:
        self.known[word] = len(self.words)
        self.words.append(word)

    def add(self, doc_id: int | None, text: bytes) -> None:
        words = blank_words(text)
        for w in words:
            if w not in self.known:
                self._number(w)
        ids = np.empty(len(words) + 2, np.int32)
        ids[0], ids[-1] = 0, 1
        ids[1:-1] = np.fromiter(map(self.known.__getitem__, words), np.int32, len(words))
        self.tokens.append(ids)
        self.doc_ids.append(doc_id)
        self.n_tokens += len(words) + 1

    def rows(self, chunk: int, buckets: int):
        """One row per bucket, and the documents' row (bucket -1)."""
        keys = np.array([word_key(w) for w in self.words], _U)
        by_key = np.argsort(keys)
        seats = np.empty(len(keys), np.int32)  # places of the words among their keys
        seats[by_key] = np.arange(len(keys))
        sizes = np.array([len(t) - 1 for t in self.tokens])
        out = np.array([held_out(d) for d in self.doc_ids])
        yield chunk, -1, None, None, _pack(np.array([d or 0 for d in self.doc_ids], np.int64), np.array([d is None for d in self.doc_ids]), out, sizes)
        bucket_of = block_of(keys, buckets)
        by_bucket = by_key[np.argsort(bucket_of[by_key], kind="stable")]  # words numbered bucket by bucket: the code needs no factor for it
        place = np.empty(len(by_bucket), np.int64)
        place[by_bucket] = np.arange(len(by_bucket))
        if len(keys) ** 2 * len(sizes) >= 1 << 63:
            raise OverflowError("a chunk of too many words and documents")
        code = place[np.concatenate([t[1:] for t in self.tokens])]  # worked on in place: the largest list of a task
        code *= len(keys)
        code += seats[np.concatenate([t[:-1] for t in self.tokens])]
        code *= len(sizes)
        code += np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        code.sort()
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        n, code = np.diff(np.append(first, len(code))).astype(np.int32), code[first]
        pair, doc = np.divmod(code, len(sizes))
        del code, first
        starts = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
        train = np.add.reduceat(np.where(out[doc], 0, n), starts)  # 0 where only held-out documents have the pair
        widths = np.diff(np.append(starts, len(pair)))
        dish, seat = np.divmod(pair[starts], len(keys))
        dish = by_bucket[dish]
        bucket = bucket_of[dish]
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        starts = np.append(starts, len(pair))
        for b in np.unique(bucket).tolist():
            lo, hi = cuts[b], cuts[b + 1]
            first = np.flatnonzero(np.concatenate([[True], dish[lo + 1:hi] != dish[lo:hi - 1]]))
            per_word, (used, at) = np.diff(np.append(first, hi - lo)), np.unique(seat[lo:hi], return_inverse=True)
            pairs = _pack(_steps(keys[dish[lo:hi][first]]), per_word.astype(np.uint32), _gaps(at, per_word), _steps(keys[by_key[used]]))
            e = slice(starts[lo], starts[hi])
            yield chunk, b, pairs, _pack(_small(train[lo:hi])), _pack(_small(widths[lo:hi]), _gaps(doc[e], widths[lo:hi]), _small(n[e]))


def _count(docs: DataFrame, buckets: int) -> DataFrame:
    """(chunk, bucket, pairs, train, docs): words and contexts of a chunk's pairs, their training counts, and the documents that have them."""

    def run(batches):
        from pyspark import TaskContext

        part, n, held = TaskContext.get().partitionId(), 0, _Chunk()

        def flush():
            rows = list(zip(*held.rows(part << 24 | n, buckets)))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(rows, kinds)], names=["chunk", "bucket", "pairs", "train", "docs"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
                held.add(doc_id, text)
                if held.n_tokens >= CHUNK_TOKENS or len(held.doc_ids) >= CHUNK_DOCS:
                    yield flush()
                    n, held = n + 1, _Chunk()
        if held.doc_ids:
            yield flush()

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), "chunk bigint, bucket int, pairs binary, train binary, docs binary", run)


# --- seatings ---------------------------------------------------------------------------


def even_seating(c: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Sizes of ``t`` tables for ``c`` customers of each dish, dish after dish."""
    within = np.arange(int(t.sum())) - np.repeat(np.cumsum(t) - t, t)
    return np.repeat(c // t, t) + (within < np.repeat(c % t, t))


def settle(old: np.ndarray, t: np.ndarray, sizes: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A seating for ``c`` customers from one for ``old``: dishes with as many as before keep theirs.

    ``sizes`` list the tables of the dishes with two or more customers.
    """
    new_t = np.minimum(np.maximum(t, c > 0), c).astype(np.int64)
    free = c > 1
    out = even_seating(c[free], new_t[free])
    kept = free & (old == c)
    to = (np.cumsum(np.where(free, new_t, 0)) - new_t)[kept]
    at = (np.cumsum(np.where(old > 1, t, 0)) - t)[kept]
    n = t[kept]
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    out[np.repeat(to, n) + within] = sizes[np.repeat(at, n) + within]
    return new_t, out


def gibbs(c: np.ndarray, t: np.ndarray, sizes: np.ndarray, scale: np.ndarray, parent: np.ndarray, discount: float, moves: int,
          rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables per dish and their sizes after ``moves`` Gibbs moves of each dish.

    A move takes a customer of the dish at random from its table and seats it again: at a new
    table by ``scale`` (strength and discounted tables of the restaurant, followed here for the
    dish's own) times the ``parent``'s probability, at an old one by its size less the discount.
    All dishes move at once. A dish with one customer has one table and is not in ``sizes``.
    """
    free = np.flatnonzero(c > 1)
    if not len(free):
        return t, sizes
    n, k, scale, parent = c[free].astype(np.int64), t[free].astype(np.int64), scale[free] - discount * t[free], parent[free]
    room = k + moves  # empty places at the end of each dish's tables
    begin = np.cumsum(room) - room
    table = np.zeros(int(room.sum()), np.int64)
    table[np.arange(len(sizes)) + np.repeat(begin - (np.cumsum(k) - k), k)] = sizes
    spare = begin + k
    guests = np.cumsum(n) - n  # customers of the dishes before
    left = guests - np.arange(len(n))  # the same, with one customer of each standing
    for _ in range(moves):
        at = np.searchsorted(np.cumsum(table), guests + (rng.random(len(n)) * n).astype(np.int64), side="right")
        table[at] -= 1
        empty = table[at] == 0
        k -= empty
        old, fresh = n - 1 - discount * k, (scale + discount * k) * parent
        new = rng.random(len(n)) * (fresh + old) < fresh
        place = np.where(empty, at, spare)
        spare += new & ~empty
        k += new
        again, sums = np.flatnonzero(~new), np.cumsum(table)
        for _ in range(12):  # size less the discount, by rejection
            pick = np.searchsorted(sums, left[again] + (rng.random(len(again)) * (n[again] - 1)).astype(np.int64), side="right")
            place[again] = pick
            again = again[rng.random(len(again)) * table[pick] >= table[pick] - discount]
            if not len(again):
                break
        table[place] += 1
    t = t.copy()
    t[free] = k
    return t, table[table > 0]


_log_gamma = np.frompyfunc(math.lgamma, 1, 1)


def leap(c: np.ndarray, t: np.ndarray, sizes: np.ndarray, scale: np.ndarray, parent: np.ndarray, discount: float, moves: int,
         rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables per dish and their sizes after ``moves`` leaps of each dish; arguments as of :func:`gibbs`, all dishes with two or more customers.

    A leap marks the table of a random customer, releases each other table with a share ``free``
    and seats all their customers anew: the new tables' number is negative binomial, their sizes
    are Sibuya's, and the marked table takes the rest. The seating's probability relative to the
    proposal's is that of the rest alone, gamma(rest - discount) / gamma(rest), which accepts it.
    Leaps of several shares take turns, as many tables fit in few customers only in part.
    """
    dish, others = np.arange(len(c)), scale - discount * t
    t, owner = t.astype(np.int64), np.repeat(dish, t)
    guests = np.cumsum(c) - c
    most = np.minimum(np.minimum(1, 0.9 / parent), 0.5 * c ** discount / (others * parent / discount + 1))
    for move in range(moves):
        free = most / 4 ** (move % 4)
        mark = np.searchsorted(np.cumsum(sizes), guests + (rng.random(len(c)) * c).astype(np.int64), side="right")
        gone = rng.random(len(sizes)) < free[owner]
        gone[mark] = False
        pool = sizes[mark] + np.bincount(owner[gone], sizes[gone], len(c)).astype(np.int64)
        fixed = t - np.bincount(owner[gone], minlength=len(c))
        made = rng.negative_binomial(others / discount + fixed, 1 - parent * free)
        of = np.repeat(dish, made)
        new = np.minimum(rng.geometric(np.maximum(rng.beta(discount, 1 - discount, len(of)), 1e-15)), c[of])
        rest = pool - np.bincount(of, new, len(c)).astype(np.int64)
        fits = np.flatnonzero(rest > 0)
        a, b = rest[fits].astype(float), sizes[mark[fits]].astype(float)
        gain = (_log_gamma(a - discount) - _log_gamma(a) - _log_gamma(b - discount) + _log_gamma(b)).astype(float)
        ok = np.zeros(len(c), bool)
        ok[fits[np.log1p(-rng.random(len(fits))) < gain]] = True
        sizes = sizes.copy()
        sizes[mark[ok]] = rest[ok]
        stays, joins = ~(gone & ok[owner]), ok[of]
        owner, sizes = np.concatenate([owner[stays], of[joins]]), np.concatenate([sizes[stays], new[joins]])
        by = np.argsort(owner, kind="stable")
        owner, sizes = owner[by], sizes[by]
        t = np.bincount(owner, minlength=len(c))
    return t, sizes


def reseat(c: np.ndarray, t: np.ndarray, sizes: np.ndarray, scale: np.ndarray, parent: np.ndarray, discount: float,
           rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Tables per dish and their sizes after a sweep: as many Gibbs moves as a dish has customers, or ``SINGLES`` and leaps.

    A leap seats a share of a dish's customers anew whatever their number, so the leaps grow only
    with its logarithm and no dish keeps a task long.
    """
    t, free = t.copy(), np.flatnonzero(c > 1)
    owner = np.repeat(free, t[free])
    steps = np.ceil(np.log2(np.maximum(c, 1))).astype(np.int64)  # dishes of like numbers of customers move together
    owners, parts = [owner[:0]], [sizes[:0]]
    for step in np.unique(steps[free]).tolist():
        some = np.flatnonzero(steps == step)
        n, old, mine = c[some].astype(np.int64), t[some], sizes[steps[owner] == step]
        args = [scale[some], parent[some], discount]
        if 1 << step > SINGLES:
            k, mine = leap(n, old, mine, *args, step, rng)
            args[0] = args[0] + discount * (k - old)
            old = k
        t[some], mine = gibbs(n, old, mine, *args, min(1 << step, SINGLES), rng)
        owners.append(np.repeat(some, t[some]))
        parts.append(mine)
    by = np.argsort(np.concatenate(owners), kind="stable")
    return t, np.concatenate(parts)[by]


def endings(contexts: np.ndarray) -> np.ndarray:
    """The restaurants above contexts."""
    return (contexts >> _U(HASHED)).astype(np.int64)


def block_of(keys: np.ndarray, blocks: int) -> np.ndarray:
    """A number below ``blocks`` by the hash in a key."""
    return ((keys & _U((1 << HASHED) - 1)) % _U(blocks)).astype(np.int64)


@dataclass
class Level:
    """Totals of the restaurants of one level over all buckets."""

    tables: np.ndarray
    customers: np.ndarray
    discount: float

    def scale(self) -> np.ndarray:
        """Weight of the parent's probability."""
        return STRENGTH + self.discount * self.tables

    def predict(self, c, t, seat, parent):
        return (c - self.discount * t + self.scale()[seat] * parent) / (STRENGTH + self.customers[seat])


@dataclass
class Dishes:
    """The dishes of a bucket: training counts by (word, context), and tables on all levels.

    Pairs of held-out documents alone are there as well, with no customer and no table.
    """

    words: np.ndarray  # keys, ascending; once packed only as many
    word: np.ndarray  # per pair; ascending, and so are the contexts of a word
    seat: np.ndarray  # the context's place in ``contexts``
    count: np.ndarray
    tables: np.ndarray
    tables1: np.ndarray  # per (word, ending) of ``group``
    tables0: np.ndarray  # per word
    sizes: np.ndarray  # of the tables of dishes with two or more customers, on the three levels
    sizes1: np.ndarray
    sizes0: np.ndarray
    contexts: np.ndarray  # keys, ascending; once packed they have their block in place of the hash

    def __post_init__(self):
        self.group, self.of_group = np.unique(self.word * RESTAURANTS + endings(self.contexts)[self.seat], return_inverse=True)
        self.word1, self.ending = np.divmod(self.group, RESTAURANTS)

    def customers1(self) -> np.ndarray:
        return np.bincount(self.of_group, self.tables, len(self.group)).astype(np.int64)

    def customers0(self) -> np.ndarray:
        return np.bincount(self.word1, self.tables1, len(self.words)).astype(np.int64)

    def totals(self) -> np.ndarray:
        """Tables per context, customers and tables per ending, and tables at the root, in one list."""
        return np.concatenate([np.bincount(self.seat, self.tables, len(self.contexts)), np.bincount(self.ending, self.customers1(), RESTAURANTS),
                               np.bincount(self.ending, self.tables1, RESTAURANTS), [self.tables0.sum()]])

    def chances(self, levels: list[Level], base: float) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the words at the root, and of the (word, ending) pairs."""
        zero = np.zeros(len(self.words), np.int64)
        root = levels[0].predict(self.customers0(), self.tables0, zero, base)
        return root, levels[1].predict(self.customers1(), self.tables1, self.ending, root[self.word1])

    def predict(self, levels: list[Level], base: float) -> np.ndarray:
        """Probabilities of the pairs."""
        return levels[2].predict(self.count, self.tables, self.seat, self.chances(levels, base)[1][self.of_group])

    def sweep(self, levels: list[Level], base: float, rng: np.random.Generator) -> None:
        root, by_ending = self.chances(levels, base)
        top, middle, low = (x.discount for x in levels)
        old1, old0 = self.customers1(), self.customers0()
        self.tables, self.sizes = reseat(self.count, self.tables, self.sizes, levels[2].scale()[self.seat], by_ending[self.of_group], low, rng)
        c1 = self.customers1()
        t, sizes = settle(old1, self.tables1, self.sizes1, c1)
        self.tables1, self.sizes1 = reseat(c1, t, sizes, levels[1].scale()[self.ending], root[self.word1], middle, rng)
        c0 = self.customers0()
        t, sizes = settle(old0, self.tables0, self.sizes0, c0)
        self.tables0, self.sizes0 = reseat(c0, t, sizes, np.full(len(self.words), levels[0].scale()[0]), np.full(len(self.words), base), top, rng)

    @classmethod
    def seated(cls, words: np.ndarray, word: np.ndarray, seat: np.ndarray, count: np.ndarray, contexts: np.ndarray | None = None) -> Dishes:
        """The first seating: one table for each dish on each level. Without ``contexts`` every ending is one."""
        if contexts is None:
            contexts = np.arange(RESTAURANTS, dtype=_U) << _U(HASHED)
        empty = np.zeros(0, np.int64)
        out = cls(words, word, seat, count, (count > 0).astype(np.int64), *[empty] * 5, contexts)
        out.tables1 = (out.customers1() > 0).astype(np.int64)
        out.tables0 = (out.customers0() > 0).astype(np.int64)
        out.sizes, out.sizes1, out.sizes0 = (c[c > 1] for c in (count, out.customers1(), out.customers0()))
        return out

    def pack(self, blocks: int) -> bytes:
        """What all seatings share."""
        per_word = np.bincount(self.word, minlength=len(self.words))
        return _pack(_small(endings(self.contexts)), _small(block_of(self.contexts, blocks)), per_word.astype(np.uint32), _gaps(self.seat, per_word), _small(self.count))

    def pack_tables(self) -> tuple[bytes, bytes]:
        """(tables, sizes): what predictions need, and the sizes of tables that only sampling needs."""
        return _pack(*map(_small, (self.tables, self.tables1, self.tables0))), _pack(*map(_small, (self.sizes, self.sizes1, self.sizes0)))

    @classmethod
    def unpack(cls, data: bytes, tables: bytes | None = None, sizes: bytes | None = None) -> Dishes:
        """Without ``tables`` the first seating."""
        ending, block, per_word, gaps, count = _unpack(data)
        contexts = ending.astype(_U) << _U(HASHED) | block.astype(_U)
        pairs = np.arange(len(per_word)), np.repeat(np.arange(len(per_word)), per_word), _ungap(gaps, per_word), count.astype(np.int64)
        if tables is None:
            return cls.seated(*pairs, contexts)
        rest = _unpack(tables) + (_unpack(sizes) if sizes is not None else [np.zeros(0, np.int64)] * 3)
        return cls(*pairs, *(x.astype(np.int64) for x in rest), contexts)


def _merge(parts: list[tuple[bytes, bytes]]) -> tuple[Dishes, list[bytes]]:
    """The training counts of a bucket from all chunks, and the places of each chunk's pairs among them."""
    held = [(np.cumsum(w, dtype=_U), per_word, gaps, np.cumsum(keys, dtype=_U), *_unpack(train)) for pairs, train in parts for w, per_word, gaps, keys in [_unpack(pairs)]]
    words, contexts = (np.unique(np.concatenate([h[k] for h in held])) for k in (0, 3))
    codes = [np.repeat(np.searchsorted(words, w) * len(contexts), per_word) + np.searchsorted(contexts, keys)[_ungap(gaps, per_word)]
             for w, per_word, gaps, keys, _ in held]
    pair, places = np.unique(np.concatenate(codes), return_inverse=True)
    count = np.bincount(places, np.concatenate([h[4] for h in held]), len(pair)).astype(np.int64)
    word, seat = np.divmod(pair, len(contexts))
    at = [_pack(_small(np.diff(p, prepend=0))) for p in np.split(places, np.cumsum([len(c) for c in codes])[:-1])]
    return Dishes.seated(words, word, seat, count, contexts), at


_STATE = "bucket int, tables binary, sizes binary, shares array<binary>, places array<int>, totals array<bigint>"
_MERGED = f"{_STATE}, dishes binary, keys array<binary>, sums array<bigint>, chunk bigint, at binary"


_KINDS = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}


def _rows(rows: list[dict], schema: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema([(name, _KINDS[kind]) for name, kind in map(str.split, schema.split(", "))]))


def _state(bucket: int, d: Dishes, blocks: int) -> dict:
    """What a seating adds to the totals: tables by block of contexts, and of the list above them the places that are not 0 with their numbers."""
    totals = d.totals().astype(np.int64)
    tables, above = totals[:len(d.contexts)], totals[len(d.contexts):]
    order, cuts = _by_block(d.contexts, blocks)
    places = np.flatnonzero(above)
    return {"bucket": bucket, "shares": [_pack(_small(tables[order[lo:hi]])) for lo, hi in zip(cuts, cuts[1:])], "places": places.tolist(), "totals": above[places].tolist()}


def _sums(d: Dishes) -> list[int]:
    """Training tokens, words, and dishes with one and two customers on the three levels."""
    c1, c0 = d.customers1(), d.customers0()
    return [int(x) for x in (d.count.sum(), (c0 > 0).sum(), *[(c == k).sum() for c in (c0, c1, d.count) for k in (1, 2)])]


def _kept(df: DataFrame, n: int) -> DataFrame:
    """Keep a table in the warehouse by bucket, so that joins by bucket read it where it lies."""
    name = f"lm_{uuid.uuid4().hex}"
    df.write.bucketBy(n, "bucket").saveAsTable(name)
    return df.sparkSession.table(name)


def _summed(rows: DataFrame, n: int) -> np.ndarray:
    """A list of fixed length from rows (pos, col), added up over the buckets by Spark."""
    out = np.zeros(n)
    for r in rows.groupBy("pos").agg(F.sum("col").alias("n")).collect():
        out[r.pos] = r.n
    return out


def _above(state: DataFrame) -> np.ndarray:
    """Totals above the contexts over all buckets: a list of fixed length."""
    rows = state.select(F.explode(F.arrays_zip("places", "totals")).alias("x")).select(F.col("x.places").alias("pos"), F.col("x.totals").alias("col"))
    return _summed(rows, 2 * RESTAURANTS + 1)


def _by_block(contexts: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of contexts block by block, and where each block starts and the last ends."""
    block = block_of(contexts, blocks)
    order = np.argsort(block, kind="stable")
    return order, np.searchsorted(block[order], np.arange(blocks + 1))


def _keys(d: Dishes, blocks: int) -> list[bytes]:
    """By block: the keys of contexts and their customers."""
    customers = np.bincount(d.seat, d.count, len(d.contexts)).astype(np.int64)
    order, cuts = _by_block(d.contexts, blocks)
    return [_pack(_steps(d.contexts[order[lo:hi]]), _small(customers[order[lo:hi]])) for lo, hi in zip(cuts, cuts[1:])]


def _numbered(state: DataFrame) -> DataFrame:
    """(bucket, block, at): the numbers of a bucket's contexts among all of a block, and their customers in the bucket."""

    def number(table):
        held = [_unpack(x) for x in table.column("at").to_pylist()]
        places = np.unique(np.concatenate([np.cumsum(keys, dtype=_U) for keys, _ in held]), return_inverse=True)[1]
        ends = np.cumsum([len(keys) for keys, _ in held])[:-1]
        at = [_pack(_small(np.diff(p, prepend=0)), customers) for p, (_, customers) in zip(np.split(places, ends), held)]
        return table.set_column(table.schema.get_field_index("at"), "at", pa.array(at, pa.binary()))

    keys = state.select("bucket", F.posexplode("keys").alias("block", "at"))
    return keys.groupBy("block").applyInArrow(number, "bucket int, block int, at binary")


def _context_totals(state: DataFrame, numbered: DataFrame) -> DataFrame:
    """(bucket, parts): customers and tables over all buckets of each of a bucket's contexts, in the order of :func:`_by_block`.

    Buckets send their tables of a block of contexts; a task adds up a block and answers each of its buckets.
    """
    shares = state.select("bucket", F.posexplode("shares").alias("block", "share"))
    rows = shares.withColumn("at", F.lit(None).cast("binary")).unionByName(numbered.withColumn("share", F.lit(None).cast("binary")))

    def add(table):
        at, tables = {}, {}
        for bucket, share, number in zip(*(table.column(c).to_pylist() for c in ("bucket", "share", "at"))):
            if share is not None:
                tables[bucket] = _unpack(share)[0]
            else:
                steps, customers = _unpack(number)
                at[bucket] = np.cumsum(steps, dtype=np.int64), customers
        places = np.concatenate([at[b][0] for b in at])
        sums = [np.bincount(places, np.concatenate(x)).astype(np.int64) for x in ([at[b][1] for b in at], [tables[b] for b in at])]
        return pa.Table.from_batches([_rows([{"bucket": b, "block": table.column("block")[0].as_py(), "data": _pack(*(_small(x[at[b][0]]) for x in sums))} for b in at], schema)])

    schema = "bucket int, block int, data binary"
    added = rows.groupBy("block").applyInArrow(add, schema)
    return added.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct("block", "data"))).getField("data").alias("parts"))


def _totals(d: Dishes, parts: list[bytes], above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(totals, customers) over all buckets of a bucket's contexts, in the order of its contexts, and of all above."""
    customers, tables = (np.concatenate(x).astype(float) for x in zip(*map(_unpack, parts)))
    order = _by_block(d.contexts, len(parts))[0]
    out, guests = np.empty(len(order)), np.empty(len(order))
    out[order], guests[order] = tables, customers
    return np.concatenate([out, above]), guests


def _levels(totals: np.ndarray, customers: np.ndarray, discounts: list[float]) -> list[Level]:
    """Root, endings, contexts: the customers of a level are the tables of the one below."""
    n = len(customers)
    guests, ending, root = totals[n:n + RESTAURANTS], totals[n + RESTAURANTS:-1], totals[-1:]
    return [Level(root, ending.sum(keepdims=True), discounts[0]), Level(ending, guests, discounts[1]), Level(totals[:n], customers, discounts[2])]


# --- scoring ------------------------------------------------------------------------------


def _score(at: bytes, docs: bytes, known: np.ndarray, base: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a chunk's documents in a bucket: index, known tokens, base score and score, from those of the bucket's pairs."""
    widths, gaps, n = _unpack(docs)
    pair = np.repeat(np.cumsum(_unpack(at)[0], dtype=np.int64), widths)
    used, of = np.unique(_ungap(gaps, widths), return_inverse=True)
    sums = [np.bincount(of, n * x[pair], len(used)) for x in (known, base, score)]
    return used.astype(np.uint32), sums[0].astype(np.uint32), sums[1], sums[2]


def score_documents(docs: DataFrame) -> DataFrame:
    """``doc_id held_out n_tokens n_known train_tokens base_score score perplexity`` of every document row.

    The model learns from all documents that are not held out; ``score`` is the log10 of the
    averaged predictive probability of all tokens, the end included. Null and empty texts are
    their end alone. Repeated rows count and are scored each; a null id trains. If nothing
    trains, all words are unknown. An empty table gives no rows; other columns are not read.
    Sampling is seeded by bucket, so a repeated task draws the same seating.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(12, -(-size // BUCKET_BYTES))
    chunks = stage(_count(docs, buckets), "lm-chunks")
    spark = docs.sparkSession

    blocks = -(-buckets // BLOCK_BUCKETS)

    def merge(key, table):
        bucket = key[0].as_py()
        d, at = _merge(list(zip(table.column("pairs").to_pylist(), table.column("train").to_pylist())))
        rows = [_state(bucket, d, blocks) | {"dishes": d.pack(blocks), "keys": _keys(d, blocks), "sums": _sums(d)}]
        rows += [{"bucket": bucket, "chunk": chunk, "at": x} for chunk, x in zip(table.column("chunk").to_pylist(), at)]
        return pa.Table.from_batches([_rows(rows, _MERGED)])

    merged = _kept(chunks.where("bucket >= 0").select("bucket", "chunk", "pairs", "train").groupBy("bucket").applyInArrow(merge, _MERGED), buckets)
    state = merged.where("chunk IS NULL")
    dishes = state.select("bucket", "dishes")
    sums = _summed(state.select(F.posexplode("sums")), 8)
    tokens, vocabulary = int(sums[0]), int(sums[1])
    # discount of a level from the dishes with one and two customers
    discounts = [float(np.clip(one / max(1, one + 2 * two), 0.1, 0.95)) for one, two in sums[2:].reshape(3, 2)]
    base, kept, states = 1 / (vocabulary + 1), [], []
    numbered = stage(_numbered(state), "lm-numbered")
    above, parts = _above(state), _kept(_context_totals(state, numbered), buckets)
    for number in range(BURN_IN + SAMPLES):

        def sweep(batches, above=above, number=number):
            for batch in batches:
                for bucket, shared, tables, sizes, parts in zip(*(batch.column(c).to_pylist() for c in ("bucket", "dishes", "tables", "sizes", "parts"))):
                    d, rng = Dishes.unpack(shared, tables, sizes), np.random.default_rng([number, bucket])
                    totals, customers = _totals(d, parts, above)
                    others = totals - d.totals()  # of the other buckets; this one's are followed
                    for _ in range(SWEEPS):
                        d.sweep(_levels(others + d.totals(), customers, discounts), base, rng)
                    tables, sizes = d.pack_tables()
                    last = number + 1 == BURN_IN + SAMPLES  # nobody reads its sizes
                    yield _rows([_state(bucket, d, blocks) | {"tables": tables, "sizes": None if last else sizes}], _STATE)

        seated = dishes.join(state.select("bucket", "tables", "sizes"), "bucket") if number else state.select("bucket", "dishes", "tables", "sizes")
        state = _kept(map_batches(seated.join(parts, "bucket"), _STATE, sweep), buckets)
        above, parts = _above(state), _kept(_context_totals(state, numbered), buckets)
        if number >= BURN_IN:
            kept.append(above)
            states.append(state.select("bucket", "tables").join(parts, "bucket").withColumn("sample", F.lit(number - BURN_IN)))
    shared = spark.sparkContext.broadcast(kept)  # SAMPLES lists of fixed length
    salts = chunks.where("bucket >= 0").groupBy("bucket").agg(F.ceil(F.sum(F.octet_length("docs")) / SALT_BYTES).cast("int").alias("salts"))
    salts = F.broadcast(stage(salts, "lm-salts"))  # a row per bucket
    posts = chunks.where("bucket >= 0").select("bucket", "chunk", "docs").unionByName(merged.where("chunk IS NOT NULL").select("bucket", "chunk", "at"), allowMissingColumns=True)
    posts = posts.join(salts, "bucket").select("bucket", F.pmod(F.xxhash64("chunk"), F.col("salts")).cast("int").alias("salt"), "chunk", "docs", "at")
    models = dishes
    for more in states:
        models = models.unionByName(more, allowMissingColumns=True)
    models = models.join(salts, "bucket").select("bucket", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), "sample", "dishes", "tables", "parts")

    def score(key, left, right):
        rows = right.to_pylist()
        data, chance = next(r["dishes"] for r in rows if r["sample"] is None), 0.0
        for r in sorted((r for r in rows if r["sample"] is not None), key=lambda r: r["sample"]):
            d = Dishes.unpack(data, r["tables"])
            chance = chance + d.predict(_levels(*_totals(d, r["parts"], shared.value[r["sample"]]), discounts), base)
        count = np.bincount(d.word, d.count, len(d.words))[d.word]
        of_pairs = count > 0, np.log10((count + 0.1) / (tokens + 0.1 * (vocabulary + 1))), np.log10(chance / len(kept))
        docs, at = {}, {}
        for chunk, x, y in zip(*(left.column(c).to_pylist() for c in ("chunk", "docs", "at"))):
            (docs if y is None else at)[chunk] = x if y is None else y
        out = [_pack(*_score(at[chunk], docs[chunk], *of_pairs)) for chunk in docs]
        return pa.table({"chunk": pa.array(docs, pa.int64()), "docs": pa.array(out, pa.binary())})

    scored = posts.groupBy("bucket", "salt").cogroup(models.groupBy("bucket", "salt")).applyInArrow(score, "chunk bigint, docs binary")
    parts = scored.withColumn("head", F.lit(False)).unionByName(chunks.where("bucket < 0").select("chunk", "docs", F.lit(True).alias("head")))

    def add(table):
        parts = list(zip(table.column("head").to_pylist(), table.column("docs").to_pylist()))
        ids, null, out, sizes = _unpack(next(d for h, d in parts if h))
        known, base_score, score = np.zeros(len(ids), np.int64), np.zeros(len(ids)), np.zeros(len(ids))
        for _, data in sorted(p for p in parts if not p[0]):
            i, k, b, s = _unpack(data)
            known[i] += k
            base_score[i] += b
            score[i] += s
        return pa.table({"doc_id": pa.array(ids, pa.int64(), mask=null), "held_out": pa.array(out), "n_tokens": pa.array(sizes.astype(np.int64)),
                         "n_known": pa.array(known), "train_tokens": pa.array(np.full(len(ids), tokens, np.int64)), "base_score": pa.array(base_score),
                         "score": pa.array(score), "perplexity": pa.array(10.0 ** (-score / sizes))})

    return parts.groupBy("chunk").applyInArrow(add, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                                                    "base_score double, score double, perplexity double")
