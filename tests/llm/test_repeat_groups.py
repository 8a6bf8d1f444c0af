"""Groups of maximal repeats against every 100-byte string of small tables."""

from collections import defaultdict

import numpy as np
import pytest

from marquee.llm import repeat_groups

DOCS = "doc_id bigint, text string, length string"
rng = np.random.default_rng(11)


def letters(n, some="abcdefghij klmnop"):
    return "".join(rng.choice(list(some), n))


PASSAGE, SHORT, TWIN = letters(420), letters(130), letters(260)
ROWS = [
    (1, letters(50) + PASSAGE + letters(80)), (2, PASSAGE + letters(200)), (3, letters(300) + PASSAGE),
    (4, letters(90) + SHORT + letters(70) + SHORT), (5, SHORT), (6, TWIN), (6, TWIN), (None, TWIN), (7, "ab" * 150), (8, "é" * 120),
    (9, None), (10, ""), (11, "too short"), (None, letters(400)), (12, letters(99, "xyz")), (13, letters(30) + PASSAGE[100:260] + letters(9))]
ROWS += [(20 + i, letters(40) + PASSAGE[:120] + letters(5 + i)) for i in range(6)]


def places_of(rows):
    """Brute force: (row, place) of every string of 100 bytes that occurs twice or more."""
    found = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        data = (text or "").encode()
        for at in range(len(data) - 99):
            found[data[at:at + 100]].append((i, at))
    return {s: spots for s, spots in found.items() if len(spots) > 1}


def all_places(rows, string):
    out = []
    for doc_id, text in rows:
        data = (text or "").encode()
        out += [(doc_id, at) for at in range(len(data) - len(string) + 1) if data[at:at + len(string)] == string]
    return out


def by_text(spots):
    return sorted(spots, key=lambda s: (s[0] is not None, s[0] or 0, s[1]))


@pytest.mark.parametrize("hot", [repeat_groups.HOT, 5])
def test_groups(spark, monkeypatch, hot):
    monkeypatch.setattr(repeat_groups, "HOT", hot)
    docs = spark.createDataFrame([(*r, "mine") for r in ROWS], DOCS).repartition(4)
    groups = defaultdict(list)
    for r in repeat_groups.maximal_groups(docs).collect():
        groups[r.group_id, r.length, r.n_places].append((r.doc_id, r.start))
    data = {i: (t or "").encode() for i, t in ROWS if i is not None}
    strings = {}
    for (group, length, n), spots in groups.items():
        doc_id, start = next(s for s in spots if s[0] is not None)
        string = data[doc_id][start:start + length]
        assert len(string) == length >= 100 and n == len(spots) > 1
        assert by_text(spots) == by_text(all_places(ROWS, string)), "all places, and only these"
        assert strings.setdefault(string, group) == group
    # every repeated string of 100 bytes is in a group that has as many places
    held = defaultdict(set)
    for string in strings:
        n = len(all_places(ROWS, string))
        for at in range(len(string) - 99):
            held[string[at:at + 100]].add(n)
    want = {s: len(spots) for s, spots in places_of(ROWS).items()}
    assert set(held) == set(want) and all(n in held[s] for s, n in want.items())
    # whole passages, the longest ones too
    assert PASSAGE[120:].encode() not in strings and SHORT.encode() in strings and TWIN.encode() in strings
    assert PASSAGE.encode() in strings and PASSAGE[100:260].encode() in strings and PASSAGE[:120].encode() in strings


def test_no_groups(spark):
    assert repeat_groups.maximal_groups(spark.createDataFrame([], DOCS)).collect() == []
    alone = spark.createDataFrame([(1, letters(500), ""), (2, None, ""), (3, letters(300), None)], DOCS)
    assert repeat_groups.maximal_groups(alone).collect() == []
