"""Ranked search, exact top-k and conversation repair against brute force: nulls, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import itertools
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marquee.llm import conversations, maxscore, topk

rng = np.random.default_rng(11)
WORDS = ["".join(rng.choice(list("abcdé"), rng.integers(1, 5))) for _ in range(120)]


# --- 11 ------------------------------------------------------------------------------


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k=10):
    """Every document scored for every item."""
    bags = [(i, Counter(terms_of(t)), len(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag, n in bags:
            m = 100 - 75 + 75 * n * n_docs // total
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in terms_of(text) if t in bag)
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return out


@pytest.fixture(scope="module")
def corpus():
    r = np.random.default_rng(5)
    texts = [" ".join(r.choice(WORDS, r.integers(1, 90), p=np.arange(120, 0, -1) / 7260)) for _ in range(260)]
    docs = [(i, t) for i, t in enumerate(texts)]
    docs += [(900, None), (901, ""), (902, " .,;! \n"), (903, texts[3]), (904, texts[3]), (4, texts[4]), (None, texts[5]), (None, texts[5]), (905, "Éa É9x a " * 3000)]
    items = [(i, " ".join(r.choice(WORDS, 12))) for i in range(9)] + [(20, None), (21, ""), (22, texts[3] + " " + texts[3]), (22, "ZZZ unknown"), (None, "a B, a-b")]
    return docs, items


def test_ranked_search(spark, corpus, monkeypatch):
    monkeypatch.setattr(maxscore, "SHARD_DOCS", 23)
    monkeypatch.setattr(maxscore, "QUERY_BLOCK", 5)
    docs, items = corpus
    d = spark.createDataFrame([(*x, "mine", 1) for x in docs], "doc_id bigint, text string, term string, score int").repartition(3)
    b = spark.createDataFrame([(*x, 0) for x in items], "item_id bigint, text string, rank int")
    got = [tuple(r) for r in maxscore.ranked_search(d, b).collect()]
    assert Counter(got) == Counter(ranked(docs, items))
    assert maxscore.ranked_search(d, b).columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_search_of_nothing(spark, corpus):
    d = spark.createDataFrame(corpus[0], "doc_id bigint, text string")
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert maxscore.ranked_search(d, none).collect() == []
    assert maxscore.ranked_search(d.where("doc_id >= 900 AND doc_id <= 902"), spark.createDataFrame(corpus[1], "item_id bigint, text string")).collect() == []
    assert maxscore.ranked_search(d.limit(0), spark.createDataFrame(corpus[1], "item_id bigint, text string")).collect() == []


def test_blocks_are_skipped(monkeypatch):
    """A shard with many blocks: same best documents, and common lists are not decompressed whole."""
    monkeypatch.setattr(maxscore, "BLOCK", 4)
    r = np.random.default_rng(7)
    rare = ["rare%d" % i for i in range(6)]
    docs = [(i, " ".join([*r.choice(WORDS[:6], r.integers(5, 300)), *(r.choice(rare, 5) if i % 97 == 0 else [])])) for i in range(1500)]
    shard = maxscore._Shard()
    for i, t in docs:
        shard.add(i, t.encode())
    rows = [x for batch in shard.rows(0) for x in batch.to_pylist()]
    home = rows[0]
    n, total = home["df"], home["n_terms"]
    lists = {x["term"]: maxscore.Stored(x, n / total) for x in rows[1:]}
    for x in lists.values():
        held, tf = x.all()
        m = 8 * (25 + 75 * np.frombuffer(home["lengths"], np.int64)[held] * n // total)
        impact = maxscore.UNIT * tf // (1000 * tf + m)
        assert all(impact[4 * b:4 * b + 4].max() <= x.bound[b] for b in range(len(x.last)))
        x.opened.clear()
    searcher = maxscore.Searcher(lists, np.frombuffer(home["ids"], np.int64), np.frombuffer(home["lengths"], np.int64), n, total)
    item = " ".join(rare[:3] + [WORDS[0], WORDS[1], WORDS[1]])
    weights = [(t, c * math.floor(1000 * math.log((2 * n + 2) / (2 * lists[t].df + 1)))) for t, c in Counter(item.split()).items()]
    got_docs, got_scores = searcher.run(weights, 10)
    assert [(x[2], x[3]) for x in ranked(docs, [(0, item)])] == list(zip(got_docs.tolist(), got_scores.tolist()))
    common = lists[WORDS[0]]
    assert len(common.opened) < len(common.last) / 2


# --- 12 ------------------------------------------------------------------------------


def nearest(rows, k=5):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in whole:
        if q is None or q % 50:
            continue
        hits = sorted((-sum(a * b for a, b in zip(v, w)), i is None, i or 0, i) for i, w in whole if i != q)
        out += [(q, r + 1, h[3], -h[0]) for r, h in enumerate(hits[:k])]
    return out


@pytest.mark.parametrize("dims, scale", [(40, 1.0), (3, 1.0), (20, 1e6)])
def test_nearest(spark, monkeypatch, dims, scale):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 37)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "ROUND_BYTES", 4000)
    r = np.random.default_rng(dims)
    rows = [(i, (r.normal(size=dims) * scale).tolist()) for i in range(400)]
    same = rows[7][1]
    rows += [(1000 + i, same) for i in range(30)] + [(100, rows[100][1]), (None, same), (None, rows[50][1]), (450, [0.0] * dims), (2000, None), (2050, None),
             (2100, [math.nan] + same[1:]), (2150, [None] + same[1:]), (2200, [math.inf] + same[1:]), (2250, []), (2300, same[:2]), (2301, same + [0.5])]
    df = spark.createDataFrame([(*x, 5, "mine") for x in rows], "vec_id bigint, embedding array<double>, score int, block string").repartition(5)
    got = [tuple(x) for x in topk.nearest(df).collect()]
    assert Counter(got) == Counter(nearest(rows))


def test_nearest_of_nothing(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [0.5])], "vec_id bigint, embedding array<float>")
    assert topk.nearest(df).collect() == [] and topk.nearest(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (2, [0.5])], "vec_id bigint, embedding array<float>")
    assert [tuple(r) for r in topk.nearest(few).collect()] == [(0, 1, 2, 256 * 128)]


# --- 13 ------------------------------------------------------------------------------


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        harm = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if harm:
            text = "" if harm == 1 else re.sub("[.!?]", "", text) if harm == 2 else text
            out += [(conv, turn, "user" if harm == 4 else role, text)] * (2 if harm == 3 else 1)
    return sorted(out, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.md5(r[3].encode()).hexdigest()))


def plain_repair(rows):
    """All states after every row with their least (cost, audit, rows), a row at a time."""
    nxt = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
    put = {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}
    seen, faults = set(), ""
    for _, _, role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        faults += "b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "-"
        seen.add((role, text))
    best = {0: (0, "", ())}

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for q, (c, a, r) in list(out.items()):
                to, role = put[q]
                new = (c + 5, a + "I", (*r, role + ":"))
                if to not in out or new[:2] < out[to][:2]:
                    out[to] = new
        return out

    for (_, _, role, text), f in zip(rows, faults):
        after = {}
        for q, (c, a, r) in inserted(best).items():
            options = [(q, c + 2, a + "D", r)]
            if f in "t-":
                more = 5 * (f == "t")
                if (q, role[:1]) in nxt:
                    options.append((nxt[q, role[:1]], c + more, a + "K", (*r, f"{role}:{text}")))
                options.append((put[q][0], c + 1 + more, a + "R", (*r, f"{put[q][1]}:{text}")))
            for to, *new in options:
                if to not in after or new[:2] < list(after[to][:2]):
                    after[to] = tuple(new)
        best = after
    cost, audit, left = min(v for q, v in inserted(best).items() if q in (0, 3))
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest()


def talks():
    r = np.random.default_rng(4)
    rows = []
    for conv in range(60):
        for turn in range(int(r.integers(1, 14))):
            role = ["user", "assistant"][turn % 2] if r.random() < 0.7 else str(r.choice(["system", "user", "assistant", "tool", ""]))
            text = str(r.choice(["Yes.", "No!", "Well", "a b c. \n", "éé?", " \t", "again."]))
            rows.append((conv, turn if r.random() < 0.9 else int(r.integers(0, 30)), role, text))
    rows += [(99, t, ["user", "assistant"][t % 2], f"text {t % 37}" + "." * (t % 5 > 0)) for t in range(700)]
    rows += [(70, None, "user", "Hi."), (70, None, None, "x."), (70, 3, "user", None), (70, 3, "user", None), (70, 3, "user", "Hi."), (71, None, None, None)]
    rows += [(None, t, "assistant" if t % 3 else "user", "Yes.") for t in range(40)]
    gone = next(c for c in range(1000, 2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    return rows + [(gone, 0, "user", "Hi.")], gone


@pytest.mark.parametrize("piece", [2000, 5])
def test_conversation_repair(spark, monkeypatch, piece):
    monkeypatch.setattr(conversations, "SLICE_ROWS", piece)
    rows, gone = talks()
    df = spark.createDataFrame([(*x, 1, "mine") for x in rows], "conv_id bigint, turn bigint, role string, text string, cost int, audit string").repartition(4)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.repair(conversations.damaged(df)).select("conv_id", *conversations.MEASURES).collect()}
    bad = hurt(rows)
    assert got == {c: plain_repair([x for x in bad if x[0] == c]) for c in {x[0] for x in rows}}
    assert got[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversations.repair(conversations.damaged(df.limit(0))).collect() == []


def test_slices_cross_like_rows():
    """Every cut of random runs of rows gives the audit of the whole."""
    r = np.random.default_rng(1)
    for _ in range(300):
        kinds = "".join(r.choice(list("suaSUA?!x"), r.integers(1, 30)))
        vector, total = conversations.run_forward(kinds, 0, len(kinds), conversations.at_state(0))
        last = conversations.crossing(vector, conversations.END_COSTS)
        whole = conversations.solve(kinds, 0, last)
        cuts = sorted({0, len(kinds), *r.integers(0, len(kinds) + 1, 4).tolist()})
        pieces = [kinds[a:b] for a, b in itertools.pairwise(cuts)]
        costs, ranks = [], []
        for p in pieces:
            vs = [conversations.run_forward(p, 0, len(p), conversations.at_state(s)) for s in range(4)]
            costs.append([min(v + t, conversations.FAR) for vec, t in vs for v, _ in vec])
            ranks.append([k for vec, _ in vs for _, k in vec])
        states, cost = conversations.cross_slices(costs, ranks)
        assert "".join(conversations.solve(p, a, b) for p, (a, b) in zip(pieces, itertools.pairwise(states))) == whole
        assert cost == total + vector[last][0] + conversations.END_COSTS[last]
