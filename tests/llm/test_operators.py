"""The corpus operators against brute force on small tables: nulls, empty and long texts, ties, repeated rows, clashing columns."""

import hashlib
import math
import pathlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marquee.llm import bpe, graph, huffman, licenses, neardup, pitman_yor, postings, pseudonyms, quality, repeats, warc
from marquee.session import scratch_path

public_tokenizers = pytest.importorskip("public_tokenizers")
DOCS = "doc_id bigint, text string, lang string, kept string, n_words string"
rng = np.random.default_rng(3)
WORDS = ["".join(rng.choice(list("abcdeé"), rng.integers(1, 7))) for _ in range(300)]


def prose(n, seed):
    return " ".join(np.random.default_rng(seed).choice(WORDS, n))


def edited(text, k, seed):
    words, r = text.split(), np.random.default_rng(seed)
    for i in r.integers(0, len(words), k):
        words[i] = f"new{r.integers(1000)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def texts():
    base = prose(120, 1)
    passage = prose(60, 2)
    out = [None, "", " \n\t ", "One", "two words", base, base, edited(base, 3, 4), edited(base, 9, 5), edited(base, 14, 6), base.upper(),
           prose(80, 7) + " " + passage + " " + prose(40, 8), passage + "\n" + prose(70, 9), "ab" * 400, "line one is here\n" * 60,
           prose(6000, 10), "MIT License. " + prose(60, 11) + " licensed under CC BY-NC 4.0, Apache License, Version 2.0",
           "a" * 3000, "Éa éA " * 30, prose(60, 12) + " 4111 1111 1111 1111 x@y.example.com 2024-02-29"]
    return out + [edited(base, 2, 20 + i) for i in range(12)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", "old", "old") for i, t in enumerate(texts)] + [(5, texts[5], "en", "old", "old"), (None, texts[7], None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def alnum(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(t))


def blank(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def multiset(rows):
    return Counter(tuple(r) for r in rows)


# --- 7 -----------------------------------------------------------------------------


def quality_of(t):
    words, t = blank(t), t or ""
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i, g in enumerate(zip(words, words[1:], words[2:])) if grams[g] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if blank(x)]
    n, chars, symbols, dup = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(hit) > 50 * n
    letters = [c for c in t if c.isascii() and c.isalpha()]
    bad = (2 * t.count("!") > n or 4 * symbols > n or 2 * dup > len(lines) or not 2 * n <= chars <= 15 * n or 2 * sum(c.isupper() for c in letters) > len(letters)
           or 10 * len(hit) > 3 * n or 10 * max(Counter(words).values(), default=0) > 3 * n
           or 10 * sum(all(c.isascii() and not c.isalpha() for c in w) for w in words) > 3 * n)
    return n, chars, symbols, dup, len(hit), failed, not failed and not bad


def test_quality(docs, nothing):
    found = quality.quality_rules(docs)
    assert set(found.columns) == {"doc_id", "text", "lang", "rejected_by", *quality.MEASURES}
    want = Counter((r.doc_id, *quality_of(r.text)) for r in docs.collect())
    assert multiset(found.select("doc_id", *quality.MEASURES).collect()) == want
    assert quality.quality_rules(nothing).collect() == []


def test_cascade_order(docs):
    order = quality.plan_cascade(docs)
    assert sorted(n for n, _, _ in order) == sorted(quality.RULES)
    assert [s / c for _, c, s in order] == sorted((s / c for _, c, s in order), reverse=True)


# --- 3 -------------------------------------------------------------------------------


def test_license_base(docs, nothing):
    for r in licenses.license_scan(docs).collect():
        words = alnum(r.text)
        places = [(i, label) for p, label in licenses.BASE.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        assert (r.n_words, r.n_base) == (len(words), len(places))
        assert (r.first_word, r.last_word) == (min((i for i, _ in places), default=None), max((i for i, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and set(r.base_labels.split(",")) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1
    assert licenses.license_scan(nothing).collect() == []


def test_license_base_phrases_across_separators(spark):
    """Consecutive words count, whatever stands between them."""
    gaps = ("  ", "\n", "\n * ", "\r\n# ", "-", "\t", "\n" + " " * 20, " </> ")
    rows = [("see the " + phrase.upper().replace(" ", gap) + " now", label) for gap in gaps for phrase, label in licenses.BASE.items()]
    for r in licenses.license_scan(spark.createDataFrame(rows, "text string, label string").coalesce(1)).collect():
        assert (r.n_base, r.first_word, r.last_word, r.base_labels) == (1, 2, 2, r.label) and r.label in r.labels.split(",") and r.score >= 0.8


def test_license_rules():
    table = licenses.rules()
    keys = sorted({r.keyword for r in table})
    assert len(table) > 300

    def labels(t):
        return [d[2].label for d in licenses.detect(t.lower().encode(), table, keys)]

    assert labels("Licensed under CC BY-NC 4.0.") == ["cc-by-nc-4.0"]
    assert labels("Apache License, Version 2.0") == ["apache-2.0"]
    assert labels("GNU General Public License as published by the Free Software Foundation, version 3 of the License") == ["gpl-3"]
    assert labels("SPDX-License-Identifier: BSD-3-Clause") == ["bsd-3-clause"]
    assert labels("mit der cc und by") == []
    # containment: no kept detection lies inside one of at least its priority
    kept = licenses.detect(b"the mit license and gnu general public license v3, apache license, apache license 2.0", table, keys)
    assert not any(a is not b and a[0] <= b[0] and b[1] <= a[1] and a[2].priority >= b[2].priority for a in kept for b in kept)


def written(tree, gap, most):
    """A text that a parsed pattern matches: ``gap`` between words, optional parts left out or (``most``) put in."""
    out = ""
    for op, arg in tree:
        op = str(op)
        if op == "LITERAL":
            out += chr(arg)
        elif op == "SUBPATTERN":
            out += written(arg[3], gap, most)
        elif op == "BRANCH":
            out += written(arg[1][-1 if most else 0], gap, most)
        elif op == "IN":
            out += chr(arg[0][1])
        elif op == "MAX_REPEAT":
            low, high, body = arg
            out += gap if (low, high) == (1, 8) else written(body, gap, most) * (1 if most else low) if high == 1 else gap * (1 if most else low)
        else:
            assert op == "ASSERT_NOT", op
    return out


@pytest.mark.parametrize("gap", [" ", "\n", "\n * ", "\n# ", "  ", "\r\n// ", "-", ", "])
def test_license_rules_across_separators(gap):
    """Every rule is tried where its pattern matches, with optional parts and without."""
    table = licenses.rules()
    keys = sorted({r.keyword for r in table})
    for rule in table:
        for most in (False, True):
            text = written(re._parser.parse(rule.pattern.pattern.decode()), gap, most).encode()
            assert rule.pattern.fullmatch(text), (rule.name, text)
            kept = licenses.detect(b"x (" + text + b")", table, keys)
            assert any(a <= 3 and b >= 3 + len(text) and r.priority >= rule.priority for a, b, r in kept), (rule.name, text)


def test_license_wrapped_headers():
    table = licenses.rules()
    keys = sorted({r.keyword for r in table})

    def labels(t):
        return [d[2].label for d in licenses.detect(t.lower().encode(), table, keys)]

    assert labels("GNU General\n * Public License") == ["gpl"]
    assert labels("# Permission is hereby\n# granted, free of charge, to any person\n# obtaining a copy") == ["mit"]
    assert labels("The Software shall be used for Good not Evil") == labels("The Software shall be used for Good, not Evil") == ["json"]


# --- 6, 2 --------------------------------------------------------------------------------


def odd_texts(n):
    r = np.random.default_rng(5)
    letters = list("abcXYZ  \n\t'.!?0123éÉßΣσİ漢字🙂-_’\xa0\x85\x1c") + ["<|endoftext|>", "the", "'ll"]
    return ["".join(r.choice(letters, r.integers(1, 60))) for _ in range(n)]


def test_bpe_equals_library(spark, docs, nothing, texts):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("word_bpe_49k.json")
    library, own = tokenizers.Tokenizer.from_file(path), bpe.WordBpe(path)
    for t in [*odd_texts(800), *(t or "" for t in texts)]:
        ids = library.encode(t, add_special_tokens=False).ids
        assert own.encode(t).tolist() == ids and own.decode(ids) == library.decode(ids, skip_special_tokens=False)
    rows = bpe.bpe_decode(bpe.bpe_encode(docs, path), path).collect()
    for r in rows:
        assert r.ids == library.encode(r.text or "", add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)
    assert multiset((r.doc_id, r.decoded) for r in bpe.bpe_round_trip(docs, path).collect()) == multiset((r.doc_id, r.decoded) for r in rows)
    assert len(rows) == docs.count() and bpe.bpe_round_trip(nothing, path).collect() == []


def test_long_words_merge_alike():
    own = bpe.WordBpe(public_tokenizers.path("word_bpe_49k.json"))
    for seed in range(60):
        r = np.random.default_rng(seed)
        parts = [own.first[b] for b in r.choice(list(b"theinganodr"), r.integers(2, 60))]
        assert bpe.merge_ranks(list(parts), own.merges) == bpe.merge_heap(list(parts), own.merges)


def test_library_runs_equal_whole_texts(texts):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    whole, runs = tokenizers.Tokenizer.from_file(path), huffman.Library(path)
    for t in [*odd_texts(800), *(t or "" for t in texts)]:
        assert np.frombuffer(runs.encode(t), "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("n,bits", [(1, 4), (2, 4), (16, 4), (50, 6), (3000, 18)])
def test_code_round_trip(n, bits):
    r = np.random.default_rng(n)
    counts = (r.pareto(0.6, n) * 3 + 1).astype(np.int64)
    counts[0] = 10 ** 9
    lengths = huffman.code_lengths(counts, bits)
    assert lengths.max() <= bits and (lengths > 0).all() and (0.5 ** lengths.astype(float)).sum() <= 1
    code, ids = huffman.Code(lengths), r.integers(0, n, 5000).astype(np.uint32)
    payload, checkpoints = code.pack(ids)
    assert (code.unpack(payload, checkpoints, len(ids)) == ids).all()
    assert (code.unpack(payload, checkpoints[3:5], 2 * huffman.LANE) == ids[3 * huffman.LANE:5 * huffman.LANE]).all()


def test_code_lengths_are_optimal():
    import heapq

    counts = np.array([7, 1, 9, 30, 2, 2, 50, 4])
    heap, total = list(counts), 0
    heapq.heapify(heap)
    while len(heap) > 1:
        pair = heapq.heappop(heap) + heapq.heappop(heap)
        total += pair
        heapq.heappush(heap, pair)
    assert (huffman.code_lengths(counts, 12) * counts).sum() == total


def test_id_files(docs, nothing, monkeypatch):
    tokenizers = pytest.importorskip("tokenizers")
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    want, start = [], 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    got = sorted(huffman.round_trip(docs, path, 2).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    for r in got:
        assert r.start == start
        start += r.n_tokens
        want.append((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())))
    assert Counter(want) == Counter((r.doc_id, (*library.encode(r.text or "", add_special_tokens=False).ids, 2)) for r in rows)
    assert huffman.round_trip(nothing, path, 2).collect() == []


# --- 4 ---------------------------------------------------------------------------------------


def test_feistel_permutes():
    f = pseudonyms.Feistel(b"key")
    for a, b in ((7, 9), (1, 5), (16, 16)):
        image = [f.permute("x", v, a, b) for v in range(a * b)]
        assert sorted(image) == list(range(a * b)) and [f.permute("x", v, a, b, True) for v in image] == list(range(a * b))
    assert sorted(f.below("d", v, 101) for v in range(101)) == list(range(101))


@pytest.mark.parametrize("labels", [0, 1, 4, 7])
@pytest.mark.parametrize("head", [1, 10, 64])
def test_long_values_are_hidden_whole(labels, head):
    """Up to the longest address that the pattern takes: most places of every part change, and all come back."""
    name = ("john.smith" * 7)[:head]
    text = f"{name}@" + "".join("abcdefghij" * 6 + "abc." for _ in range(labels)) + "mail.org"
    found = pseudonyms.find(text, b"secret")
    new = pseudonyms.replace(text, found)
    assert [k for _, _, k, _ in found] == ["email"] and len(new) == len(text)
    assert pseudonyms.replace(new, pseudonyms.find(new, b"secret", back=True)) == text
    parts = [(a, b) for a, b in zip(text.replace("@", ".").split("."), new.replace("@", ".").split("."))][:-1]
    for a, b in parts:
        assert len(a) < 4 or sum(x == y for x, y in zip(a, b)) <= max(2, len(a) // 4)
    f = pseudonyms.Feistel(b"key")
    wide = 26 ** 300
    assert len({f._add("x", s, 5, wide) * 26 // wide for s in range(40)}) > 10 and max(f._add("x", s, 5, wide) for s in range(40)) > wide // 2


def test_pseudonyms(docs, nothing):
    key = b"secret"
    text = ("Card 4111 1111 1111 1111 and 4111111111111111, mail jo.42@mail7.example.com, 10.20.30.40, born 29.02.2000 or 2000-02-29, not 31.02.2000, "
            "SSN 078-05-1120 not 000-12-3456, IBAN DE89 3704 0044 0532 0130 00, call +1 (017) 555-7713. Room 12, 300 pages.")
    found = pseudonyms.find(text, key)
    out = pseudonyms.replace(text, found)
    assert Counter(k for _, _, k, _ in found) == Counter(card=2, email=1, ip=1, date=2, ssn=1, iban=1, phone=1)
    for old in ("4111 1111", "jo.42@", "10.20.30.40", "29.02.2000", "078-05-1120", "3704 0044", "555-7713"):
        assert old not in out
    for kept in ("31.02.2000", "000-12-3456", "Room 12, 300 pages.", "+1 ("):
        assert kept in out
    assert pseudonyms.replace(out, pseudonyms.find(out, key, back=True)) == text
    cards = [new.replace(" ", "") for _, _, k, new in found if k == "card"]
    assert cards[0] == cards[1] and pseudonyms.luhn_digit(cards[0][:-1]) == cards[0][-1]
    days = [new for _, _, k, new in found if k == "date"]
    assert days[0] == ".".join(reversed(days[1].split("-")))
    rows = {(r.doc_id, r.text) for r in pseudonyms.pseudonyms(docs, key).collect()}
    assert {(r.doc_id, r.text and pseudonyms.replace(r.text, pseudonyms.find(r.text, key))) for r in docs.collect()} == rows
    assert pseudonyms.pseudonyms(nothing, key).collect() == []
    with pytest.raises(ValueError):
        pseudonyms.pseudonyms(docs, b"")


# --- 5 -----------------------------------------------------------------------------------------


def test_warc(spark):
    long, other = "<p>" + "x" * 1500, "<p>" + "é" * 700
    pages = [(1, "http://a/1", long), (2, "http://a/2", long), (3, None, long), (4, "http://b\r\nX: y", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""),
             (8, "u", other), (8, "u", other), (None, "u", other), (None, None, None)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string").repartition(3)
    root = scratch_path(spark, "warc-test")
    rows = warc.read_warc(warc.write_warc(df, root), root, payloads=True).collect()
    want = Counter()
    for page, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "") == (html or "") and p is not None]
        leader = max(same, default=None) if len(body) >= 1000 else None
        back = leader is not None and page != leader
        want[page, len(body), hashlib.sha1(body).hexdigest(), "revisit" if back else "response", leader if back else None, None if back else body] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload) if r.payload != b"" else b"") for r in rows) == want
    again = scratch_path(spark, "warc-test")
    warc.write_warc(df.repartition(1), again)
    assert warc.write_warc(df.limit(0), scratch_path(spark, "warc-test")).collect() == []
    files = lambda r: b"".join(warc.read_file(r, f) for f in sorted(x.name for x in pathlib.Path(r.removeprefix("file:")).glob("*.gz")))
    assert files(root) == files(again) and len(list(warc.members(files(root)))) == len(pages)
    with pytest.raises(ValueError):
        list(warc.members(files(root)[:-30]))


# --- 8 -------------------------------------------------------------------------------------------


def test_components(spark):
    links = [(9, 8), (8, 7), (7, 1), (20, 21), (21, 22), (30, 30)]
    got = dict(graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert got == {9: 1, 8: 1, 7: 1, 1: 1, 20: 20, 21: 20, 22: 20}


@pytest.mark.parametrize("n,percent,block", [(2, 80, 512), (5, 80, 512), (2, 60, 3)])
def test_near_duplicates(docs, nothing, monkeypatch, n, percent, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = docs.collect()

    def shingles(t):
        w = blank(lowered(t))
        return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()

    sets = [shingles(r.text) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[find(i)] = find(j)
    want = Counter()
    for i, r in enumerate(rows):
        ids = [rows[j].doc_id for j in range(len(rows)) if find(j) == find(i) and rows[j].doc_id is not None]
        low = min(ids, default=None) if sets[i] else r.doc_id
        want[r.doc_id, len(sets[i]), low, r.doc_id == low] += 1
    got = neardup.near_duplicates(docs, n, percent)
    assert multiset(got.select("doc_id", "n_shingles", "component_id", "kept").collect()) == want
    assert neardup.near_duplicates(nothing).collect() == []


def test_near_duplicates_below_80_percent(spark):
    """Pairs at exactly 60 percent (9 of 15 words in both), of which a threshold for 80 misses a third."""
    rows = [(2 * i + k, " ".join(f"w{i}x{j}" for j in [*range(9), *range(9 + 3 * k, 12 + 3 * k)])) for i in range(60) for k in (0, 1)]
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2), 1, 60).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(d, d - d % 2) for d, _ in rows}


@pytest.mark.parametrize("values,matches", [(2, 56), (3, 40), (2, 1), (2, 96)])
def test_merged_lists_count_all_collisions(values, matches):
    random = np.random.default_rng(values * 100 + matches)
    some = random.integers(0, values, (90, neardup.COORDS), dtype=np.uint32) * np.uint32(0xFFFFFFFF // (values - 1))
    posted, probes = np.concatenate([some[:60], some[:3]]), some[30:]
    same = (probes[:, None, :] == posted[None, :, :]).sum(axis=2)
    got = list(neardup.Lists(posted).collisions(probes, matches))
    assert len(got) == len(probes)
    for row, (nodes, counts) in zip(same, got):
        assert dict(zip(nodes.tolist(), counts.tolist())) == {j: n for j, n in enumerate(row.tolist()) if n >= matches}


def test_matches_follow_the_similarity():
    assert neardup.matches_for(80) == 56 and neardup.matches_for(100) == neardup.COORDS
    assert all(neardup.missed(neardup.matches_for(p), p) <= neardup.MISSED < 4e-7 for p in range(20, 101))
    with pytest.raises(ValueError):
        neardup.matches_for(5)


# --- 9 ---------------------------------------------------------------------------------------------


def test_contamination(spark, docs, nothing, texts):
    items = [(0, texts[11][30:260]), (1, "Nowhere to be found in any of these texts at all, ever"), (2, None), (3, ""), (4, "Two WORDS"), (5, "a"),
             (10, texts[12][:120].upper()), (11, " ".join(texts[5].split()[5:15]))]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = Counter()
    for r in docs.collect():
        w, hit, named = alnum(r.text), set(), set()
        for item, t in items:
            x = alnum(t)
            k = min(10, len(x))
            wins = {tuple(x[i:i + k]) for i in range(len(x) - k + 1)} if x else set()
            for i in range(len(w) - k + 1):
                if tuple(w[i:i + k]) in wins:
                    hit |= set(range(i, i + k))
                    named.add(str(item))
        want[r.doc_id, len(w), len(hit), len(named), ",".join(sorted(named)), bool(hit)] += 1
    got = postings.contamination(docs, bench).collect()
    assert Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, ",".join(r.item_ids), r.contaminated) for r in got) == want
    assert postings.contamination(nothing, bench).collect() == []
    assert not any(r.contaminated for r in postings.contamination(docs, bench.limit(0)).collect())


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x x beta y gamma"), (2, "gamma beta alpha"), (3, "alpha x x x x x x beta gamma")], "doc_id bigint, text string")
    phrases = spark.createDataFrame([("p", ["alpha", "beta", "gamma"])], "phrase string, words array<string>")
    terms = spark.createDataFrame([("alpha",), ("beta",), ("gamma",)], "term string")
    index = postings.build_index(docs, terms)
    assert {r.doc_id for r in postings.proximity_matches(index, phrases, 5).collect()} == {1, 2}
    assert {r.doc_id for r in postings.proximity_matches(index, phrases, 2).collect()} == {2}


# --- 10 ----------------------------------------------------------------------------------------------


def removed(rows):
    """Brute force: rows in order, every 100-byte string that was seen before."""
    seen, out = set(), []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            if data[i:i + 100] in seen:
                gone[i:i + 100] = b"\1" * 100
            seen.add(data[i:i + 100])
        runs = [r for r in bytes(gone).split(b"\0") if r]
        out.append((doc_id, len(data), sum(gone), len(runs), bytes(x for x, g in zip(data, gone) if not g)))
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 2])
def test_repeats(spark, docs, nothing, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = sorted(((r.doc_id, r.text) for r in docs.where("doc_id IS NOT NULL").collect()), key=lambda r: r[0])
    some = docs.where("doc_id IS NOT NULL")
    got = repeats.remove_repeats(some).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect()
    assert Counter((*r[:4], bytes(r.kept)) for r in got) == Counter(removed(rows))
    assert repeats.remove_repeats(nothing).collect() == []


def test_repeats_null_ids(docs):
    got = repeats.remove_repeats(docs).collect()
    by = Counter((r.doc_id, r.n_removed == r.n_bytes) for r in got if r.n_bytes >= 100)
    assert by[None, False] == 1 and by[7, True] == 1  # the same text: the null id comes first


def test_maximal_repeats_against_all_substrings():
    r = np.random.default_rng(1)
    core = bytes(r.integers(97, 123, 40, dtype=np.uint8))
    for seed in range(20):
        r = np.random.default_rng(seed)
        group, contexts = [], []
        sides = [bytes(r.integers(97, 99, 60, dtype=np.uint8)) for _ in range(3)]
        for i in range(8):
            left, right = sides[r.integers(3)][: r.integers(30, 61)], sides[r.integers(3)]
            cut = r.integers(0, 61)
            context = left + core + right[:cut] + bytes(r.integers(120, 123, 60 - cut, dtype=np.uint8))
            contexts.append((len(left), context))
            group.append(repeats.Occurrence(i, i, context, len(left), len(context) - len(left)))
        found = {(a, b, tuple(sorted(o.row for o in some))) for a, b, some in repeats.maximal_repeats(group)}
        want = set()
        for a in range(61):
            for b in range(40, 101):
                if a + b < 100:
                    continue
                by = {}
                for i, (n, c) in enumerate(contexts):
                    if a <= n and n + b <= len(c):
                        by.setdefault(c[n - a:n + b], []).append(i)
                for rows in by.values():
                    if len(rows) > 1:
                        def grows(da, db):
                            more = {contexts[i][1][contexts[i][0] - a - da:contexts[i][0] + b + db] if contexts[i][0] >= a + da else i for i in rows}
                            return len(more) == 1 and all(contexts[i][0] + b + db <= len(contexts[i][1]) for i in rows)
                        if not (a < 60 and grows(1, 0)) and not (b < 100 and grows(0, 1)):
                            want.add((a, b, tuple(rows)))
        assert found == want


# --- 1 ------------------------------------------------------------------------------------------------


def test_pitman_yor(docs, nothing):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = Counter()
    for d, t in rows:
        if not pitman_yor.held_out(d):
            counts.update([*blank(lowered(t)), None])
    total, vocabulary = sum(counts.values()), len(counts)
    got = pitman_yor.score_documents(docs).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((d, len(blank(t)) + 1) for d, t in rows)
    base = [sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (vocabulary + 1))) for w in [*blank(lowered(t)), None]) for d, t in rows]
    assert sorted(round(r.base_score, 6) for r in got) == sorted(round(x, 6) for x in base)
    assert all(r.train_tokens == total and r.score < 0 and r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 10 == 0) for r in got)
    again = pitman_yor.score_documents(docs.repartition(2)).collect()
    assert sorted(round(r.base_score, 6) for r in again) == sorted(round(r.base_score, 6) for r in got)
    assert pitman_yor.score_documents(nothing).collect() == []


def test_predictions_sum_to_one():
    r = np.random.default_rng(2)
    words = np.arange(1, 40, dtype=np.uint64)
    pairs = np.unique(r.integers(0, 39, 300) * pitman_yor.RESTAURANTS + r.integers(0, 3, 300) * 64)
    word, seat = np.divmod(pairs, pitman_yor.RESTAURANTS)
    word = np.unique(word, return_inverse=True)[1]
    words = words[: word.max() + 1]
    d = pitman_yor.Dishes.seated(words, word, seat, r.integers(1, 30, len(pairs)))
    customers = np.bincount(seat, d.count, pitman_yor.RESTAURANTS)
    base = 1 / (len(words) + 1)
    for _ in range(3):
        d.sweep(pitman_yor._levels(d.totals(), customers, [0.7, 0.7, 0.7]), base, r)
        levels = pitman_yor._levels(d.totals(), customers, [0.7, 0.7, 0.7])
        root, middle = d.chances(levels, base)
        unknown = levels[0].predict(0, 0, np.zeros(1, np.int64), base)
        assert abs(root.sum() + unknown[0] - 1) < 1e-9


def test_gibbs_samples_the_seating():
    """One dish with four customers and parent probability 1: the Chinese restaurant, 2.92 tables on average."""
    theta, discount, n = 1.0, 0.5, 20_000
    t, sizes = np.ones(n, np.int64), np.full(n, 4)
    for step in range(25):
        t, sizes = pitman_yor.gibbs(np.full(n, 4), t, sizes, theta + discount * t, np.ones(n), discount, 1, np.random.default_rng(step))
    assert sizes.sum() == 4 * n and len(sizes) == t.sum()
    assert t.min() == 1 and t.max() == 4 and abs(t.mean() - 2.922) < 0.03


def test_settle_keeps_what_did_not_change():
    old, t, sizes = np.array([1, 4, 5, 3]), np.array([1, 2, 3, 1]), np.array([3, 1, 2, 2, 1, 3])
    t, sizes = pitman_yor.settle(old, t, sizes, np.array([2, 4, 1, 3]))
    assert t.tolist() == [1, 2, 1, 1] and sizes.tolist() == [2, 3, 1, 3]


def expected_tables(c, scale, parent, discount, most):
    """Mean number of tables of a dish with ``c`` customers, from the generalised Stirling numbers."""
    k = np.arange(1, most + 1)
    log = np.full(most, -np.inf)
    log[0] = 0.0
    with np.errstate(divide="ignore"):
        for m in range(1, c):
            log = np.logaddexp(np.concatenate([[-np.inf], log[:-1]]), log + np.log(np.maximum(m - k * discount, 0)))
    log += np.cumsum(np.log(scale + discount * (k - 1))) + k * math.log(parent)
    weight = np.exp(log - log.max())
    return float((k * weight).sum() / weight.sum())


def test_a_sweep_reaches_every_customer():
    """From one table each, a few sweeps bring dishes of any size to the exact mean number of tables."""
    rng = np.random.default_rng(1)
    for c, scale, parent, discount in [(2, 3.0, 0.3, 0.6), (4, 40.0, 0.2, 0.5), (30, 20.0, 0.2, 0.7), (40, 900.0, 0.2, 0.6), (300, 60.0, 0.1, 0.7),
                                       (3000, 50.0, 0.05, 0.5), (3000, 4000.0, 0.01, 0.7), (2000, 2.0, 0.9, 0.5), (5000, 1.0, 1e-4, 0.8)]:
        n = 600
        t, sizes, count = np.ones(n, np.int64), np.full(n, c), np.full(n, c)
        means = []
        for _ in range(24):
            t, sizes = pitman_yor.reseat(count, t, sizes, scale + discount * t, np.full(n, parent), discount, rng)
            assert (np.add.reduceat(sizes, np.cumsum(t) - t) == c).all() and sizes.min() > 0 and len(sizes) == t.sum()
            means.append(t.mean())
        want = expected_tables(c, scale, parent, discount, min(c, 600))
        assert abs(np.mean(means[16:]) - want) < 0.03 * want + 0.05, (c, scale, parent, discount, means, want)


def test_library_takes_over_used_runs(monkeypatch):
    monkeypatch.setattr(huffman, "REMEMBERED", 40)
    lib = huffman.Library(public_tokenizers.path("byte_bpe_50k.json"))
    asked = Counter()
    run = lib._run
    monkeypatch.setattr(lib, "_run", lambda r, lead=" ": asked.update([(r, lead)]) or run(r, lead))
    for i in range(60):
        text = f"the often used run of x{i} y{i} z{i}"
        assert lib.encode(text) == lib._whole(text)
        assert len(lib.known) + len(lib.older) < 100
    assert asked["often", " "] == 1 and asked["used", " "] == 1


def test_library_looks_at_blanks_of_unknown_runs_only(monkeypatch):
    """White space is judged run by run, once; lines of a text are not remembered, their runs are."""
    lib = huffman.Library(public_tokenizers.path("byte_bpe_50k.json"))
    judged = Counter()
    lone = huffman.lone_blanks
    monkeypatch.setattr(huffman, "lone_blanks", lambda t: judged.update([t]) or lone(t))
    for i in range(5):
        text = f"one run, 12 of{i}\nmany, and 12 more"
        assert lib.encode(text) == lib._whole(text)
    assert judged["run,"] == judged["12"] == 1 and not any("\n" in r for r in lib.known)
    for text in ("", " ", "a  run", "a run ", " a run", "a \trun", "a\n run", "a run,\n\nand", "a run,\n", "\u00a0", "a \u2003run", "a\x1crun", "a\x1c\x1drun", "a\n", "\na run"):
        assert lib.encode(text) == lib._whole(text), text


def test_shared_lists_are_not_kept(spark, monkeypatch):
    """Lists of all texts are the largest table of the near duplicates: they go from shuffle to shuffle, not to the shared folder."""
    names = []
    stage = neardup.stage
    monkeypatch.setattr(neardup, "stage", lambda df, name: names.append(name) or stage(df, name))
    texts_ = [" ".join(f"w{i}" for i in range(40)), " ".join(f"w{i}" for i in range(41)), "other words here"]
    docs = spark.createDataFrame(list(enumerate(texts_)), "doc_id bigint, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 0, 2: 2} and "prefix-lists" in names and "shared-lists" not in names


def test_pack_keeps_types_and_values():
    arrays = [np.arange(5) - 2, np.array([True, False]), np.zeros(0, np.uint16), np.array([1, 70000], np.uint32), np.array([1.5, -2.0])]
    got = pitman_yor._unpack(pitman_yor._pack(*arrays))
    assert [(x.dtype, x.tolist()) for x in got] == [(x.dtype, x.tolist()) for x in arrays]
    small = (np.random.default_rng(0).integers(0, 4, 5000) * 61 + np.arange(5000)).astype(np.uint32)
    assert len(pitman_yor._pack(small)) < 0.33 * small.nbytes
