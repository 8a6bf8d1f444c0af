"""Token ids in files: canonical length-limited Huffman codes from global counts, blocks that decode alone."""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window, functions as F

from marquee.llm.bpe import byte_letters
from marquee.llm.common import map_batches, shared_folder, stage
from marquee.llm.files import Committed, read_file
from marquee.session import scratch_path

MAX_BITS = 18
BLOCK_IDS = 1 << 18  # a block ends with the document that reaches this
FILE_IDS = 1 << 23  # so does a file
LANE = 64  # ids between two checkpoints
WIDE, NARROW = "<u4", "<u2"  # how ids are held between encoding and writing
MAGIC = b"IDHUF1\n\0"
_BLOCK = struct.Struct("<IQQ")  # documents, ids, payload bytes

# --- the code -----------------------------------------------------------------


def code_lengths(counts: np.ndarray, max_bits: int = MAX_BITS) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` by package merge; ids that never occur get 0."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    if n > 1 << max_bits:
        raise ValueError(f"{n} ids need codes longer than {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.int64)
    items, levels = leaves, [np.ones(n, bool)]
    for _ in range(max_bits - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, packages])
        by = np.argsort(merged, kind="stable")
        items = merged[by]
        levels.append(by < n)
    take = 2 * n - 2
    for is_leaf in reversed(levels):
        singles = int(is_leaf[:take].sum())
        lengths[order[:singles]] += 1
        take = 2 * (take - singles)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes by (length, id), and the ids in that order."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    codes, code, last = np.zeros(len(lengths), np.uint64), 0, 0
    for i in order.tolist():
        code <<= int(lengths[i]) - last
        last = int(lengths[i])
        codes[i] = code
        code += 1
    return codes, order


class Code:
    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        self.codes, order = canonical(lengths)
        self.bits = max(1, int(lengths.max(initial=0)))
        spans = np.left_shift(1, self.bits - lengths[order].astype(np.int64))
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.width = np.ones(1 << self.bits, np.int64)
        self.symbol[: spans.sum()] = np.repeat(order, spans)
        self.width[: spans.sum()] = np.repeat(lengths[order], spans)

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bits of the ids, and the bit offset of every ``LANE``-th of them."""
        width = self.lengths[ids].astype(np.int64)
        if len(ids) and not width.all():
            raise ValueError("an id has no code: it was not in the counts")
        ends = np.cumsum(width)
        at = ends - width
        word = at >> 5
        shifted = self.codes[ids] << (64 - (at & 31) - width).astype(np.uint64)
        words = np.zeros((int(ends[-1]) >> 5) + 2 if len(ids) else 0, np.uint64)
        if len(ids):
            first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
            words[word[first]] += np.add.reduceat(shifted >> np.uint64(32), first)
            words[word[first] + 1] += np.add.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes(), at[::LANE].astype(np.uint64)

    def unpack(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """All lanes advance together, one table look-up an id."""
        if not n:
            return np.zeros(0, np.uint32)
        raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = checkpoints.astype(np.int64), len(window) - 1
        out = np.empty((LANE, len(at)), np.uint32)
        mask, bits = np.uint32((1 << self.bits) - 1), 32 - self.bits
        for k in range(LANE):
            peek = window[np.minimum(at >> 3, last)] >> (bits - (at & 7)).astype(np.uint32) & mask
            out[k] = self.symbol[peek]
            at += self.width[peek]
        return out.T.reshape(-1)[:n]


# --- blocks and files -----------------------------------------------------------
# file: MAGIC, u32 size of the packed lengths, the lengths (zlib), blocks.
# block: documents u32, ids u64, payload bytes u64; doc ids i64; "has no doc id" u8; ids per document u32;
# checkpoints u64, one per LANE ids; payload, big-endian bits.


def write_block(code: Code, doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs)
    payload, checkpoints = code.pack(ids)
    return b"".join([_BLOCK.pack(len(docs), len(ids), len(payload)), np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array([d is None for d in doc_ids], np.uint8).tobytes(), np.array([len(d) for d in docs], "<u4").tobytes(),
                     checkpoints.astype("<u8").tobytes(), payload])


def read_block(code: Code, data: memoryview) -> tuple[int, list[int | None], np.ndarray, np.ndarray]:
    """(bytes read, doc ids, ids per document, all ids) of the block at the start of ``data``."""
    n_docs, n_ids, n_payload = _BLOCK.unpack_from(data)
    at = _BLOCK.size

    def part(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(data, kind, n, at)
        at += out.nbytes
        return out

    doc_ids, missing, sizes = part("<i8", n_docs), part("u1", n_docs), part("<u4", n_docs)
    checkpoints = part("<u8", -(-n_ids // LANE))
    ids = code.unpack(bytes(data[at:at + n_payload]), checkpoints, n_ids)
    return at + n_payload, [None if m else d for d, m in zip(doc_ids.tolist(), missing)], sizes, ids


def write_ids(coded: DataFrame, root: str, doc_id: str = "doc_id", ids: str = "ids", max_bits: int = MAX_BITS, kind: str = WIDE) -> DataFrame:
    """Write the id lists (binary, unsigned little-endian numbers of ``kind``) in ascending order of ``doc_id``; returns the manifest.

    Counts cover all rows; the code table is bounded by the vocabulary. Rows are range-sorted,
    null ids first, repeated ids in a fixed order of their content, so a repeated task writes
    the same file. ``coded`` is read several times: stage it before. An empty table writes
    no file. The manifest (file, part, piece, documents, ids, bytes, start) has a row per file.
    """
    spark = coded.sparkSession

    def count(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids_of_batch = np.frombuffer(b"".join(x or b"" for x in batch.column(0).to_pylist()), kind)
            n = np.bincount(ids_of_batch, minlength=len(total))
            n[: len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used), "n": pa.array(total[used])})

    counted = map_batches(coded.select(ids), "id bigint, n bigint", count).groupBy("id").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(max([r.id for r in counted], default=-1) + 1, np.int64)
    for r in counted:
        counts[r.id] = r.n
    lengths = code_lengths(counts, max_bits)
    table = zlib.compress(lengths.tobytes())
    header = MAGIC + struct.pack("<I", len(table)) + table
    shared = spark.sparkContext.broadcast((header, lengths))

    def write(batches):
        from pyspark import TaskContext

        part, piece, out = TaskContext.get().partitionId(), 0, None
        header, lengths = shared.value
        code = Code(lengths)
        held_ids, held, held_n, file_docs, file_ids, rows = [], [], 0, 0, 0, []

        def flush(last: bool):
            nonlocal out, held_ids, held, held_n, file_docs, file_ids, piece
            if held:
                if out is None:
                    out = Committed(root, f"part-{part:06d}-{piece:05d}.ids")
                    out.write(header)
                out.write(write_block(code, held_ids, held))
                file_docs, file_ids = file_docs + len(held), file_ids + held_n
                held_ids, held, held_n = [], [], 0
            if out is not None and (last or file_ids >= FILE_IDS):
                out.commit()
                rows.append((f"part-{part:06d}-{piece:05d}.ids", part, piece, file_docs, file_ids, out.size))
                out, file_docs, file_ids, piece = None, 0, 0, piece + 1

        for batch in batches:
            for d, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held_ids.append(d)
                held.append(np.frombuffer(x or b"", kind))
                held_n += len(held[-1])
                if held_n >= BLOCK_IDS:
                    flush(False)
        flush(True)
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(("file", "part", "piece", "documents", "ids", "bytes"), r)) for r in rows])

    parts = max(1, -(-int(counts.sum()) // FILE_IDS))
    sort = [F.col(doc_id).asc_nulls_first(), F.xxhash64(ids), F.col(ids)]
    keyed = coded.select(F.col(doc_id).cast("bigint").alias(doc_id), ids)
    files = map_batches(keyed.repartitionByRange(parts, F.col(doc_id).asc_nulls_first(), F.xxhash64(ids)).sortWithinPartitions(*sort),
                        "file string, part bigint, piece bigint, documents bigint, ids bigint, bytes bigint", write)
    files = stage(files, "id-manifest")  # runs the writers once
    before = Window.orderBy("part", "piece").rowsBetween(Window.unboundedPreceding, -1)  # a row per file of some ten MB
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


@lru_cache(maxsize=2)
def _code(table: bytes) -> Code:
    return Code(np.frombuffer(zlib.decompress(table), np.uint8))


def read_ids(manifest: DataFrame, root: str, doc_id: str = "doc_id") -> DataFrame:
    """The documents of the manifest's files: id, ``start`` (ids before it), ``n_tokens``, ``ids`` (little-endian u32).

    Every file is read and its blocks decoded on their own; nothing is taken from the writer but the manifest.
    """

    def read(batches):
        for batch in batches:
            for file, start in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                data = read_file(root, file)
                size = struct.unpack_from("<I", data, len(MAGIC))[0]
                at = len(MAGIC) + 4 + size
                if not data.startswith(MAGIC):
                    raise ValueError(f"not an id file: {file}")
                code, view = _code(data[at - size:at]), memoryview(data)
                while at < len(data):
                    used, doc_ids, sizes, ids = read_block(code, view[at:])
                    at += used
                    ends = np.cumsum(sizes, dtype=np.int64)
                    raw = ids.astype("<u4").tobytes()
                    cut = (ends * 4).tolist()
                    yield pa.RecordBatch.from_pydict({
                        doc_id: pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - sizes), "n_tokens": pa.array(sizes.astype(np.int64)),
                        "ids": pa.array([raw[a:b] for a, b in zip([0, *cut], cut)], pa.binary())})
                    start += int(ends[-1]) if len(ends) else 0

    n = max(1, manifest.count())
    return map_batches(manifest.select("file", "start").repartition(n), f"{doc_id} bigint, start bigint, n_tokens bigint, ids binary", read)


# --- encoding with the library ----------------------------------------------------

REMEMBERED = 600_000  # runs that a Python worker remembers, from task to task; when full they become the older ones, of which used ones are taken over


# Fixed value: the published pattern of byte-level vocabularies. Characters before U+0558 have one class in every Unicode version.
_PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
_SETTLED = re.compile("[\x00-\u0557]*")
_TAILED = re.compile(r"([^\W\d_]+)([!-&(-/:-@\[-^`{-~]+)")  # letters, then signs other than the apostrophe


def lone_blanks(text: str) -> bool:
    """No white space beside other white space or at an end.

    Then a single blank belongs to the run after it and no merge crosses it, so runs can be
    remembered; all other texts go to the library whole.
    """
    words = text.split()
    return len(words) - 1 == len(text) - sum(map(len, words))


class _Spaced(ValueError):
    """A run that breaks ``lone_blanks``."""


class _Runs(dict):
    """Ids by run; an unknown run is found on its first look-up."""

    def __init__(self, find: Callable[[str], bytes]):
        super().__init__()
        self.find = find

    def __missing__(self, run: str) -> bytes:
        return self.find(run)


class Library:
    """Byte-level BPE by the tokenizers library, whose model is asked once for each run between blanks."""

    def __init__(self, path: str, kind: str = WIDE):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.kind, self.code = kind, {WIDE: "I", NARROW: "H"}[kind]
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = str.maketrans(dict(enumerate(byte_letters())))
        self.blank = " ".translate(self.letters)
        self.known = _Runs(self._find)  # run without the blank before it -> ids
        self.bare: dict[str, bytes] = {}  # the same of runs without a blank before them
        self.older: dict[str, bytes] = {}  # what ``known`` was when it was last full
        self.newline = self._piece("\n")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _piece(self, piece: str) -> bytes:
        if piece.isascii() and piece.isalpha():  # such letters stand for themselves
            return self._ids(piece)
        return self._ids(piece.encode("utf-8", "surrogatepass").decode("latin-1").translate(self.letters))

    def _ids(self, letters: str) -> bytes:
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _word(self, word: str, lead: str) -> bytes:
        """A run of letters, the blank before it included."""
        return self._ids(self.blank + word) if lead and word.isascii() else self._piece(lead + word)

    def _find(self, run: str) -> bytes:
        ids = self.older.get(run)
        if ids is None:
            if not (run.isalpha() or lone_blanks(run)):
                raise _Spaced
            ids = self._run(run)
            if "\n" in run:  # hardly ever met again, and its parts are remembered
                return ids
        self.known[run] = ids
        return ids

    def _seen(self, run: str, lead: str) -> bytes:
        if lead:
            return self.known[run]
        if run not in self.bare:
            self.bare[run] = self._run(run, "")
        return self.bare[run]

    def _run(self, run: str, lead: str = " ") -> bytes:
        if run.isalpha():
            return self._word(run, lead)
        tailed = _TAILED.fullmatch(run)
        if tailed and tailed[1].isalpha():
            return self._seen(tailed[1], lead) + self._seen(tailed[2], "")
        if "\n" in run:
            head, *lines = run.split("\n")
            return self.newline.join([self._seen(head, lead), *(self._seen(x, "") for x in lines)])
        if _SETTLED.fullmatch(run):
            return b"".join(map(self._piece, _PIECES.findall(lead + run)))
        return self._whole(lead + run)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian numbers of ``kind``."""
        if not text:
            return b""
        if any(a in text for a in self.added):
            return self._whole(text)
        if len(self.known) + len(self.bare) > REMEMBERED:
            self.older, self.known = self.known, _Runs(self._find)
            self.bare.clear()
        first, *rest = text.split(" ")
        if not lone_blanks(first):
            return self._whole(text)
        try:  # a text has lone blanks if all its runs have; remembered runs have
            tail = b"".join(map(self.known.__getitem__, rest))
        except _Spaced:
            return self._whole(text)
        return self._run(first, "") + tail


@lru_cache(maxsize=2)
def library(path: str, kind: str = WIDE) -> Library:
    return Library(path, kind)


def id_kind(path: str, end_id: int) -> str:
    """The narrowest numbers that hold every id of the vocabulary and the end id."""
    from tokenizers import Tokenizer

    return NARROW if max(end_id, *Tokenizer.from_file(path).get_vocab().values()) < 1 << 16 else WIDE


def encode_ids(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", kind: str = WIDE) -> DataFrame:
    """``doc_id`` and ``ids`` (little-endian numbers of ``kind``) of every whole text, ``end_id`` appended.

    Null and empty texts have the end id alone. Repeated rows and null ids are kept; an empty
    table gives no rows; other columns are not read.
    """
    end = np.array([end_id], kind).tobytes()

    def run(batches):
        lib = library(path, kind)
        for batch in batches:
            ids = [lib.encode(t or "") + end for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=[doc_id, "ids"])

    return map_batches(docs.select(F.col(doc_id).cast("bigint").alias(doc_id), text), f"{doc_id} bigint, ids binary", run)


def round_trip(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Encode, write the files and read the documents back from them."""
    spark = docs.sparkSession
    shared_folder(spark)
    root = scratch_path(spark, "id-files")
    kind = id_kind(path, end_id)
    manifest = write_ids(stage(encode_ids(docs, path, end_id, doc_id, text, kind), "ids"), root, doc_id, kind=kind)
    return read_ids(manifest, root, doc_id)
