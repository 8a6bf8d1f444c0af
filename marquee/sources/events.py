"""Event streams: JSON decoding, batch and streaming readers, change feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from marquee.functions.scalars import topic_of
from marquee.sources.contracts import CONTRACTS, CORRUPT

# formats whose rows carry the event as JSON text
TEXT_FORMATS = ("kafka", "text")


def decode_json(df: DataFrame, contract: str, value: str = "value") -> DataFrame:
    """Parse JSON text by its contract; what is no JSON object lands in the corrupt column."""
    spec = CONTRACTS[contract]
    schema = spec.schema.add(CORRUPT, T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    text = F.col(value).cast("string")
    parsed = df.withColumn("_e", F.from_json(text, schema, options))
    broken = F.when(F.col("_e").isNull() | ~F.coalesce(F.ltrim(text).startswith("{"), F.lit(False)), F.coalesce(text, F.lit("")))
    rest = [c for c in df.columns if c != value and c not in schema.fieldNames()]
    event = parsed.select(*rest, "_e.*", broken.alias("_b"))
    return spec.with_defaults(event.withColumn(CORRUPT, F.coalesce(CORRUPT, "_b")).drop("_b"))


def read_events(spark: SparkSession, path: str, contract: str, fmt: str = "parquet") -> DataFrame:
    """One batch of events with the contract's schema, never inferred."""
    spec = CONTRACTS[contract]
    if fmt in TEXT_FORMATS:
        return decode_json(spark.read.format(fmt).load(path), contract)
    return spec.with_defaults(spark.read.schema(spec.schema).format(fmt).load(path))


def read_event_stream(spark: SparkSession, contract: str, fmt: str = "kafka", **options: str) -> DataFrame:
    """The same as a stream, from the earliest offset.

    For a broker pass ``kafka__bootstrap__servers`` and ``subscribe`` (dots
    written as ``__``); for files pass ``path``.
    """
    spec = CONTRACTS[contract]
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        reader = reader.option("startingOffsets", "earliest")
    elif fmt not in TEXT_FORMATS:
        reader = reader.schema(spec.schema)
    for key, value in options.items():
        reader = reader.option(key.replace("__", "."), value)
    df = reader.load()
    return decode_json(df, contract) if fmt in TEXT_FORMATS else spec.with_defaults(df)


def schema_drift(df: DataFrame, contract: str, value: str = "value") -> DataFrame:
    """Unexpected keys, missing keys and other versions, with counts.

    One pass: each record yields its few findings, summed before the shuffle.
    """
    spec = CONTRACTS[contract]
    text = F.col(value).cast("string")
    keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
    expected = F.array(*[F.lit(c) for c in spec.fields])
    needed = F.array(*[F.lit(c) for c in spec.fields if c not in spec.nullable and c not in spec.defaults])
    version = F.coalesce(F.get_json_object(text, "$.schema_version"), F.lit(spec.version))
    find = lambda kind, items: F.transform(items, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))
    findings = F.concat(
        find("unexpected_field", F.array_except(keys, expected)),
        find("missing_field", F.array_except(needed, keys)),
        find("bad_version", F.filter(F.array(version), lambda v: v != spec.version)),
    )
    return df.select(F.explode(findings).alias("f")).groupBy("f.kind", "f.key").agg(F.count(F.lit(1)).alias("n"))


def replay(df: DataFrame, target_topic: str | None = None, category: str = "category") -> DataFrame:
    """Records for republishing: key, JSON value tagged as replayed, topic."""
    topic = F.lit(target_topic) if target_topic else topic_of(F.col(category))
    event = [c for c in df.columns if c not in (category, "date", "hour")]
    key = F.coalesce(F.col("user_id").cast("string"), F.col("event_id").cast("string"))
    value = F.to_json(F.struct(*event, F.lit(True).alias("is_replayed")))
    return df.select(key.alias("key"), value.alias("value"), topic.alias("topic"))


def decode_cdc(df: DataFrame, row_schema: str, value: str = "value") -> DataFrame:
    """Change records, bare or under ``payload``: op, before, after."""
    row = T.StructType.fromDDL(row_schema)
    body = T.StructType().add("before", row).add("after", row).add("op", T.StringType()).add("ts_ms", T.LongType())
    envelope = T.StructType([T.StructField("payload", body), *body.fields])
    parsed = df.withColumn("_c", F.from_json(F.col(value).cast("string"), envelope))
    pick = lambda name: F.coalesce(F.col(f"_c.payload.{name}"), F.col(f"_c.{name}")).alias(name)
    rest = [c for c in df.columns if c != value]
    return parsed.select(*rest, pick("op"), pick("before"), pick("after"), pick("ts_ms"))


def changed_rows(cdc: DataFrame, keys: list[str]) -> DataFrame:
    """One flat row per change: the new values, or the keys of a deleted row, with its op."""
    names = cdc.schema["after"].dataType.fieldNames()
    value = lambda c: F.coalesce(F.col(f"after.{c}"), F.col(f"before.{c}")) if c in keys else F.col(f"after.{c}")
    return cdc.select(*[value(c).alias(c) for c in names], "op", "ts_ms")
