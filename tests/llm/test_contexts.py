"""Contexts of the language model: each has a restaurant of its own, counted over all buckets."""

import random
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np

from marquee.llm import pitman_yor


def test_contexts_of_one_ending_are_kept_apart(spark):
    """Two words whose hashes once shared a restaurant: what follows one says nothing on the other."""
    words = [f"w{i}le" for i in range(400)]
    x, y = next((a, b) for a, b in combinations(words, 2) if zlib.crc32(a.encode()) % 64 == zlib.crc32(b.encode()) % 64)
    train = [i for i in range(1000) if not pitman_yor.held_out(i)][:200]
    left = next(i for i in range(1000) if pitman_yor.held_out(i))
    rows = [(i, f"{x} a" if k % 2 else f"{y} b") for k, i in enumerate(train)] + [(left, f"{x} b")]
    got = {r.doc_id: r for r in pitman_yor.score_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[left].held_out and got[left].n_known == 3
    assert got[train[0]].score > got[left].score + 1 and got[train[1]].score > got[left].score + 1


def test_contexts_are_counted_over_all_buckets(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(["one", "two", "tree", "free", "é", "x", "seven", "eleven"]) for _ in range(r.randint(0, 9))) for _ in range(40)]
    chunks = [pitman_yor._Chunk(), pitman_yor._Chunk()]
    customers, dishes, seen = Counter(), defaultdict(set), set()
    for i, text in enumerate(texts):
        chunks[i % 2].add(i, text.encode())
        words = [pitman_yor.START, *text.encode().split(), pitman_yor.END]
        for before, word in zip(words, words[1:]):
            seen.add(pitman_yor.word_key(before))
            if not pitman_yor.held_out(i):
                customers[pitman_yor.word_key(before)] += 1
                dishes[pitman_yor.word_key(before)].add(word)
    parts = defaultdict(list)
    for n, chunk in enumerate(chunks):
        for _, bucket, pairs, train, _ in chunk.rows(n, 5):
            if bucket >= 0:
                parts[bucket].append((pairs, train))
    buckets = {b: pitman_yor._merge(p)[0] for b, p in parts.items()}
    state = spark.createDataFrame([(b, pitman_yor._state(b, d, 3)["shares"], pitman_yor._keys(d, 3)) for b, d in buckets.items()],
                                  "bucket int, shares array<binary>, keys array<binary>")
    found = {x.bucket: x.parts for x in pitman_yor._context_totals(state, pitman_yor._numbered(state)).collect()}
    for b, d in buckets.items():
        totals, guests = pitman_yor._totals(d, found[b], np.zeros(1))
        assert dict(zip(d.contexts.tolist(), guests)) == {k: customers[k] for k in d.contexts.tolist()}
        assert dict(zip(d.contexts.tolist(), totals)) == {k: len(dishes[k]) for k in d.contexts.tolist()}
        kept = pitman_yor.Dishes.unpack(d.pack(3))
        assert (kept.seat == d.seat).all() and (kept.count == d.count).all() and (kept.group == d.group).all() and (kept.tables0 == d.tables0).all()
        assert (pitman_yor._totals(kept, found[b], np.zeros(1))[1] == guests).all()
    assert {k for d in buckets.values() for k in d.contexts.tolist()} == seen


def test_predictions_of_a_context_sum_to_one():
    """Seatings with pairs and words of held-out documents alone, which have no customers."""
    rng = np.random.default_rng(5)
    contexts = np.sort(rng.integers(1, 1 << 60, 30).astype(np.uint64))
    pair = np.unique(rng.integers(0, 40 * 30, 500))
    word, seat = np.divmod(pair, 30)
    words, word = np.unique(word, return_inverse=True)
    count = rng.integers(0, 6, len(pair))
    count[word == 0] = 0
    d = pitman_yor.Dishes.seated(words.astype(np.uint64), word, seat, count, contexts)
    customers, base = np.bincount(seat, count, 30), 1 / (len(words) + 1)
    for _ in range(3):
        d.sweep(pitman_yor._levels(d.totals(), customers, [0.6, 0.5, 0.4]), base, rng)
        assert (d.tables <= d.count).all() and ((d.tables > 0) == (d.count > 0)).all() and d.tables0[0] == 0
        levels = pitman_yor._levels(d.totals(), customers, [0.6, 0.5, 0.4])
        assert abs(d.chances(levels, base)[0].sum() + levels[0].predict(0, 0, np.zeros(1, np.int64), base)[0] - 1) < 1e-9
        # a word a context never had has its ending's share of what is left
        mass = np.bincount(seat, count - 0.4 * d.tables, 30) + levels[2].scale()
        assert np.allclose(mass, pitman_yor.STRENGTH + customers)


def test_gaps_give_numbers_back():
    widths = np.array([3, 1, 2, 1])
    a = np.array([2, 5, 5, 0, 70000, 70001, 9])
    gaps = pitman_yor._gaps(a, widths)
    assert gaps.dtype == np.uint32 and (pitman_yor._ungap(gaps, widths) == a).all()
    none = np.zeros(0, np.int64)
    assert len(pitman_yor._ungap(pitman_yor._gaps(none, none), none)) == 0
