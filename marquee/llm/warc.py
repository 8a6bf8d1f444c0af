"""Deterministic sharded WARC writer and reader: range-sorted records, files rolled by compressed size."""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import map_batches, stage
from marquee.llm.files import Committed, read_file

SHARE_BYTES = 1000  # equal payloads from this size on are stored once
PART_BYTES = 96 << 20  # payload bytes a writing task gets
FILE_BYTES = 64 << 20  # compressed size at which a file is closed
STEP_BYTES = 8 << 10  # of a file given to the unpacker at once
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_NAMES = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
PAGE, REFERS, LENGTH = "X-Page-Id", "X-Refers-To-Page-Id", "X-Payload-Length"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, f'{page_id} {url} {digest}')}>"


def one_line(value: str) -> str:
    """A header value: line breaks would end the header."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def make_record(page_id: int | None, url: str | None, payload: bytes | None, digest: str, size: int, refers_to: int | None, date: str) -> bytes:
    """An uncompressed record; ``payload`` is None for a revisit. All headers and digests are made here."""
    url = one_line(url or "")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    b32 = "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: {record_id(page_id, url, digest)}",
             f"WARC-Date: {date}", f"WARC-Target-URI: {url}", "Content-Type: application/http; msgtype=response",
             f"WARC-Payload-Digest: {b32}", f"WARC-Block-Digest: {_sha1(block)}", f"{LENGTH}: {size}"]
    if page_id is not None:
        lines.append(f"{PAGE}: {page_id}")
    if payload is None:
        lines += [f"WARC-Profile: {REVISIT}", f"{REFERS}: {refers_to}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; a wrong length or digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    size = int(headers["Content-Length"])
    block = rest[:size]
    if first != "WARC/1.1" or rest[size:] != b"\r\n\r\n" or _sha1(block) != headers["WARC-Block-Digest"]:
        raise ValueError(f"broken record {headers.get('WARC-Record-ID')}")
    return headers, block.partition(b"\r\n\r\n")[2]


def pages_with_leader(pages: DataFrame) -> tuple[DataFrame, int]:
    """``page_id url payload digest size refers_to is_mark``, and all payload bytes.

    Equal payloads of at least ``SHARE_BYTES`` share the record of the largest page id. Leaders and revisits are found
    on slim rows without payloads. A revisit is told by a mark, a row with no payload that sorts before the page's own
    and so reaches its task in the one shuffle that payloads go through.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    full = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"), F.octet_length(payload).cast("bigint").alias("size"))
    slim = stage(full.select("page_id", "url", "digest", "size"), "warc-digests")
    shared = (slim.where(F.col("size") >= SHARE_BYTES).groupBy("digest").agg(F.max("page_id").alias("leader"), F.count("*").alias("n"))
              .where((F.col("n") > 1) & F.col("leader").isNotNull()).select("digest", "leader"))
    revisits = slim.join(shared, "digest").where(~F.col("page_id").eqNullSafe(F.col("leader"))).select("page_id", "url", "digest", "leader").distinct()
    marks = revisits.select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "digest", F.lit(None).cast("bigint").alias("size"),
                            F.col("leader").alias("refers_to"), F.lit(True).alias("is_mark"))
    rows = full.select("*", F.lit(None).cast("bigint").alias("refers_to"), F.lit(False).alias("is_mark"))
    return rows.unionByName(marks), slim.agg(F.sum("size")).first()[0] or 0


def write_warc(pages: DataFrame, root: str, date: str = "2024-01-01T00:00:00Z", level: int = 4) -> DataFrame:
    """Write a record per page row in order of page id; returns the manifest (file, part, piece, records, bytes).

    The order is (page id, url, digest), null ids first, and every header comes from the row, so
    the same pages give the same bytes. Null html is an empty payload, a null url an empty one.
    Rows that repeat a page id are written each; if their payload is shared and the id is the
    leader's, each is a response. An empty table gives no file. Each record is a gzip member.
    """
    rows, total = pages_with_leader(pages)
    columns = rows.columns

    def write(batches):
        from pyspark import TaskContext

        part, out, n, files, marked, leader = TaskContext.get().partitionId(), None, 0, [], None, None

        def close():
            nonlocal out, n
            out.commit()
            files.append({"file": f"part-{part:06d}-{len(files):05d}.warc.gz", "part": part, "piece": len(files), "records": n, "bytes": out.size})
            out, n = None, 0

        for batch in batches:
            for page_id, url, payload, digest, size, refers_to, is_mark in zip(*(batch.column(c).to_pylist() for c in columns)):
                if is_mark:
                    marked, leader = (page_id, url, digest), refers_to
                    continue
                refers_to = leader if marked == (page_id, url, digest) else None
                if out is None:
                    out = Committed(root, f"part-{part:06d}-{len(files):05d}.warc.gz")
                packer = zlib.compressobj(level, zlib.DEFLATED, 31)
                record = make_record(page_id, url, payload if refers_to is None else None, digest, size, refers_to, date)
                out.write(packer.compress(record) + packer.flush())
                n += 1
                if out.size >= FILE_BYTES:
                    close()
        if out is not None:
            close()
        if files:
            yield pa.RecordBatch.from_pylist(files)

    order = [F.col("page_id").asc_nulls_first(), F.col("url").asc_nulls_first(), F.col("digest")]  # of the ranges: a mark goes where its page goes
    parts = max(1, -(-total // PART_BYTES), min(16, total >> 20))
    made = map_batches(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, F.col("is_mark").desc()),
                       "file string, part bigint, piece bigint, records bigint, bytes bigint", write)
    return stage(made, "warc-manifest")  # runs the writers once


def members(data: bytes):
    """The gzip members of a file, unpacked one by one; a member that is cut off is an error."""
    view, at = memoryview(data), 0
    while at < len(view):
        unpacker, out = zlib.decompressobj(31), []
        while not unpacker.eof:
            some = view[at:at + STEP_BYTES]
            if not some:
                raise ValueError("the last record is cut off")
            out.append(unpacker.decompress(some))
            at += len(some) - len(unpacker.unused_data)
        yield b"".join(out)


def read_warc(manifest: DataFrame, root: str, payloads: bool = False) -> DataFrame:
    """A row per record of the manifest's files, lengths and digests checked against the bytes.

    ``payload_bytes`` and ``payload_digest`` are those of the full payload: measured for a
    response, from its headers for a revisit.
    """
    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    schema += ", payload binary" if payloads else ""

    def read(batches):
        for batch in batches:
            for file in batch.column("file").to_pylist():
                rows = []
                for data in members(read_file(root, file)):
                    headers, payload = parse_record(data)
                    kind, digest = headers["WARC-Type"], base64.b32decode(headers["WARC-Payload-Digest"][5:]).hex()
                    if kind == "response" and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != int(headers[LENGTH])):
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
                    page, refers = headers.get(PAGE), headers.get(REFERS)
                    row = {"page_id": page and int(page), "url": headers["WARC-Target-URI"], "payload_bytes": int(headers[LENGTH]),
                           "payload_digest": digest, "record_type": kind, "refers_to": refers and int(refers)}
                    rows.append(row | {"payload": payload if kind == "response" else None} if payloads else row)
                    if len(rows) == 500:
                        yield _batch(rows, payloads)
                        rows = []
                yield _batch(rows, payloads)

    return map_batches(manifest.select("file").repartition(max(1, manifest.count())), schema, read)


def _batch(rows: list[dict], payloads: bool) -> pa.RecordBatch:
    fields = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
              ("record_type", pa.string()), ("refers_to", pa.int64())] + [("payload", pa.binary())] * payloads
    return pa.RecordBatch.from_pylist(rows, schema=pa.schema(fields))


SQL = """
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size FROM pages),
g AS (SELECT *, max(page_id) OVER (PARTITION BY digest) AS leader FROM p)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
  CASE WHEN size >= 1000 AND page_id <> leader THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN size >= 1000 AND page_id <> leader THEN leader END AS refers_to FROM g"""
