"""Shared helpers: reading, row-wise passes over Arrow batches, staging, small byte tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StructField, StructType, _parse_datatype_string

from marquee.session import scratch_path, shared_root

# Bounds of one Arrow batch between Spark and Python: rows and bytes, whichever comes first.
BATCH_ROWS = 2000
BATCH_BYTES = 16 << 20
SIEVE_BITS = 1 << 24  # 2 MB, however many values

# A-Z to lower case, bytes that end a word to blanks. A word is a run of other bytes; bytes of
# characters beyond ASCII always belong to words.
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ALNUM = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in _LOWER)
_SPACES = bytes(32 if b in (9, 10, 11, 12, 13, 32) else b for b in _LOWER)


def lower_ascii(text: bytes) -> bytes:
    return text.translate(_LOWER)


def alnum_words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    return text.translate(_ALNUM).split()


def blank_words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z."""
    return text.translate(_SPACES).split()


def raw_words(text: bytes) -> list[bytes]:
    """Words of ``[^\\x20\\x09-\\x0D]+`` as they stand; ``bytes.split`` knows just these blanks."""
    return text.split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small, whatever the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def map_batches(df: DataFrame, schema: str | StructType,
                fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    bound_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def with_columns(df: DataFrame, outputs: dict[str, str], fn: Callable[[pa.RecordBatch], dict[str, list]]) -> DataFrame:
    """All columns of ``df`` next to those that ``fn`` makes of each batch; a clashing column of ``df`` is replaced."""
    made = [StructField(n, _parse_datatype_string(t)) for n, t in outputs.items()]
    kept = [f for f in df.schema.fields if f.name not in outputs]
    types = {n: arrow_type(f.dataType) for n, f in zip(outputs, made)}
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            new = fn(batch)
            arrays = [batch.column(n) for n in names] + [pa.array(new[n], types[n]) for n in types]
            yield pa.RecordBatch.from_arrays(arrays, names=names + list(types))

    return map_batches(df, StructType(kept + made), run)


def arrow_type(t: DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def texts(batch: pa.RecordBatch, name: str) -> list[bytes]:
    """A text column as UTF-8 bytes; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write to the cluster's shared folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def perhaps_in(df: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """``df`` with ``_perhaps``: false only if no row of ``values`` has the row's value of ``column`` (null like any other).

    A bit per hash of a value is broadcast, a list of fixed length, so that wide rows without a partner need no shuffle.
    """
    place = F.pmod(F.xxhash64(F.col(column).cast(values.schema[column].dataType)), F.lit(SIEVE_BITS))
    bits = values.select(place.alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_bits"))
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = df.join(F.broadcast(bits), F.bitmap_bucket_number(place) == F.col("_bucket"), "left")
    return found.select(*[df[c] for c in df.columns], F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False)).alias("_perhaps"))


def shared_folder(spark: SparkSession) -> str:
    return shared_root(spark)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
