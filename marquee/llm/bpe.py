"""BPE encoding over a contiguous rank array, and decoding, for a vocabulary with word ends."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from marquee.llm.common import map_batches

# Words longer than this many symbols are merged from a heap: scanning an array of n ranks n times is for short words.
SHORT_WORD = 96
# Encoded words that a task remembers; the memory is emptied when full and at the task's end.
REMEMBERED = 150_000
ID_BITS = 20
ID_MASK = (1 << ID_BITS) - 1
NO_RANK = 1 << 60

# Fixed value: how the vocabulary's published pattern cuts words.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

BLANKS = regex.compile(r"\s+")
ODD_BLANKS = re.compile("[\x1c-\x1f]")  # blanks to str.split, symbols to the pattern


def byte_letters() -> list[str]:
    """The printable stand-in of every byte: itself where Latin-1 prints it, else the next letter from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merge_ranks(parts: list[int], merges: dict[int, int]) -> list[int]:
    """Merge one word, given as the ids of its first parts.

    ``rank[i]`` belongs to the boundary between parts i and i + 1: the merge's rank with the
    merged id below it. Each turn takes the lowest rank, the leftmost of equals, deletes that
    boundary and refreshes the two ranks beside it.
    """
    get = merges.get
    rank = [get(a << ID_BITS | b, NO_RANK) for a, b in zip(parts, parts[1:])]
    while rank:
        best = min(rank)
        if best == NO_RANK:
            break
        i = rank.index(best)
        parts[i] = merged = best & ID_MASK
        del parts[i + 1], rank[i]
        if i < len(rank):
            rank[i] = get(merged << ID_BITS | parts[i + 1], NO_RANK)
        if i:
            rank[i - 1] = get(parts[i - 1] << ID_BITS | merged, NO_RANK)
    return parts


def merge_heap(parts: list[int], merges: dict[int, int]) -> list[int]:
    """The same merges for a long word, from a heap of pairs; stale entries are skipped."""
    n, parts = len(parts), list(parts)
    before, after = list(range(-1, n - 1)), list(range(1, n + 1))
    heap: list[tuple[int, int, int, int]] = []

    def push(i: int) -> None:
        j = after[i] if i >= 0 else n
        if j < n and (found := merges.get(parts[i] << ID_BITS | parts[j])) is not None:
            heapq.heappush(heap, (found, i, parts[i], parts[j]))

    for i in range(n - 1):
        push(i)
    while heap:
        found, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue
        parts[i], parts[j], after[i] = found & ID_MASK, -1, after[j]
        if after[j] < n:
            before[after[j]] = i
        push(i)
        push(before[i])
    return [p for p in parts if p >= 0]


class WordBpe:
    """The vocabulary of a published tokenizer file with word ends (lower case, blanks dropped)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.ids: dict[str, int] = dict(model["vocab"])
        if max(self.ids.values(), default=0) > ID_MASK:
            raise ValueError("vocabulary too large for the packed merge table")
        self.merges = {self.ids[a] << ID_BITS | self.ids[b]: r << ID_BITS | self.ids[a + b]
                       for r, (a, b) in enumerate(model["merges"])}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in [*self.ids.items(), *self.added.items()]}
        longest = sorted(self.added, key=len, reverse=True)
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, longest)) + ")") if longest else None
        letters = byte_letters()
        self.first = [self.ids[x] for x in letters]
        self.final = [self.ids[x + self.suffix] for x in letters]
        self.known: dict[str, bytes] = {}  # int32 ids

    def encode_word(self, word: str) -> list[int]:
        *head, last = word.encode("utf-8", "surrogatepass")
        parts = [self.first[b] for b in head] + [self.final[last]]
        return (merge_ranks if len(parts) <= SHORT_WORD else merge_heap)(parts, self.merges)

    def _word(self, word: str) -> bytes:
        if word not in self.known:
            self.known[word] = array("i", self.encode_word(word)).tobytes()
        return self.known[word]

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text; special tokens that it spells out become their ids, none are added."""
        if self.split_added and any(t in text for t in self.added):
            parts = [array("i", [self.added[p]]).tobytes() if p in self.added else self._plain(p)
                     for p in self.split_added.split(text)]
            return np.frombuffer(b"".join(parts), dtype=np.int32)
        return np.frombuffer(self._plain(text), dtype=np.int32)

    def _plain(self, text: str) -> bytes:
        text = unicodedata.normalize("NFC", text)
        # each letter alone: the library has no rule for a capital sigma at a word's end
        text = "".join(c.lower() for c in text) if "Σ" in text else text.lower()
        # no word crosses a blank, so runs between blanks are encoded (and remembered) whole
        runs = BLANKS.split(text) if ODD_BLANKS.search(text) else text.split()
        known = self.known
        try:
            return b"".join(map(known.__getitem__, runs))
        except KeyError:
            if len(known) > REMEMBERED:
                known.clear()
            for run in set(runs).difference(known):
                known[run] = b"".join(map(self._word, WORDS.findall(run)))
            return b"".join(map(known.__getitem__, runs))

    def decode(self, ids) -> str:
        """The parts joined by blanks, special tokens included, as a file without a decoder asks for."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _with(df: DataFrame, added: list[StructField], make) -> DataFrame:
    """``df`` with the columns that ``make(coder, batch)`` gives; columns of the same names are replaced."""
    names = {f.name for f in added}
    schema = StructType([f for f in df.schema.fields if f.name not in names] + added)
    kept = [f.name for f in schema.fields[: -len(added)]]
    path, fill = make

    def run(batches):
        coder = load(path)
        try:
            for batch in batches:
                yield pa.RecordBatch.from_arrays([batch.column(n) for n in kept] + fill(coder, batch), names=schema.names)
        finally:
            coder.known.clear()

    return map_batches(df, schema, run)


def _id_lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    values = np.concatenate(rows) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values), type=pa.list_(pa.field("element", pa.int32(), False)))


def bpe_encode(docs: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Every row with the ``ids`` of its whole text; a column of that name is replaced.

    Null and empty texts have no ids (an empty array). Repeated rows are encoded alike, an
    empty table gives no rows. ``path`` must be readable on every executor.
    """
    return _with(docs, [StructField(ids, ArrayType(IntegerType(), False))],
                 (path, lambda coder, batch: [_id_lists([coder.encode(t or "") for t in batch.column(text).to_pylist()])]))


def bpe_decode(coded: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Every row with the text of its ``ids``; null ids give an empty text, unknown ids are left out."""
    return _with(coded, [StructField(text, StringType())],
                 (path, lambda coder, batch: [pa.array([coder.decode(x or ()) for x in batch.column(ids).to_pylist()], pa.string())]))


def bpe_round_trip(docs: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``bpe_encode`` and ``bpe_decode`` of its ids in one pass, with one Python worker a task."""

    def fill(coder, batch):
        rows = [coder.encode(t or "") for t in batch.column(text).to_pylist()]
        return [_id_lists(rows), pa.array([coder.decode(x.tolist()) for x in rows], pa.string())]

    return _with(docs, [StructField(ids, ArrayType(IntegerType(), False)), StructField(decoded, StringType())], (path, fill))
