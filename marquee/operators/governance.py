"""Privacy: masking by catalog, text scans, erasure and retention."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.masking import count_finds, mask_email, mask_free_text, mask_ip, mask_phone, pseudonymize
from marquee.functions.scalars import as_time, shift
from marquee.operators.staging import apply_ttl, union_all

# Retention per data class, and the masking strategy per column.
RETENTION_DAYS = {"CONFIDENTIAL_PII": 730, "PSEUDONYMOUS_IDENTIFIER": 365, "PUBLIC_METADATA": 3650}
PII_CATALOG = [
    ("CONFIDENTIAL_PII", "users", "email", "PARTIAL_EMAIL_MASK"),
    ("CONFIDENTIAL_PII", "users", "phone", "PHONE_SUFFIX_MASK"),
    ("PSEUDONYMOUS_IDENTIFIER", "users", "user_id", "HMAC_SHA256_OR_RAW_UUID"),
    ("PSEUDONYMOUS_IDENTIFIER", "devices", "device_id", "RAW_UUID"),
    ("PSEUDONYMOUS_IDENTIFIER", "raw_playback_events", "session_id", "RAW_UUID"),
    ("PUBLIC_METADATA", "dim_content", "content_id", "NONE"),
    ("PUBLIC_METADATA", "dim_content", "title", "NONE"),
    ("PUBLIC_METADATA", "dim_content", "genres", "NONE"),
]
DELETION_SLA_HOURS = 48
ERASED_TABLES = [
    "watchlists", "devices", "subscriptions", "profiles", "users",
    "raw_playback_events", "fact_watch_sessions", "mart_churn_features",
]


def masked(column: str, strategy: str, key: str | DataFrame | None) -> Column:
    c = F.col(column)
    if strategy == "PARTIAL_EMAIL_MASK":
        return mask_email(c)
    if strategy == "PHONE_SUFFIX_MASK":
        return mask_phone(c)
    if strategy == "IP_MASK":
        return mask_ip(c)
    if strategy == "HMAC_SHA256_OR_RAW_UUID":
        return pseudonymize(c, "hmac", key)
    if strategy == "SALTED_SHA256":
        return pseudonymize(c, "sha256", key)
    return c


def apply_catalog(df: DataFrame, table: str, key: str | DataFrame | None = None, catalog: list[tuple] = PII_CATALOG) -> DataFrame:
    """Mask every column of a table the catalog lists; keyed strategies refuse to run without a key."""
    rules = {c: s for _, t, c, s in catalog if t == table and c in df.columns}
    return df.withColumns({c: masked(c, s, key) for c, s in rules.items()})


def mask_text(df: DataFrame, column: str, country_code: str = "91") -> DataFrame:
    """Mask personal data inside whole texts."""
    return df.withColumn(column, mask_free_text(F.col(column), country_code))


def pii_report(df: DataFrame, column: str, by: str) -> DataFrame:
    """Number of personal-data finds by kind and group; texts are never collected."""
    kinds = count_finds(F.col(column))
    counts = [F.sum(c).alias(k) for k, c in kinds.items()]
    rows = df.groupBy(by).agg(F.count(F.lit(1)).alias("rows"), *counts)
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("bigint").alias("finds")) for k in kinds])
    return rows.select(by, "rows", F.explode(pairs).alias("p")).select(by, "rows", "p.kind", "p.finds")


def erase_users(tables: dict[str, DataFrame], requests: DataFrame, user_columns: dict[str, str] | None = None
                ) -> tuple[dict[str, DataFrame], DataFrame]:
    """(tables without the requested users, rows removed per table and user)."""
    wanted = requests.select("user_id").distinct()
    columns = user_columns or {}
    kept, audits = {}, []
    for name, df in tables.items():
        column = columns.get(name, "user_id")
        ids = wanted.select(F.col("user_id").alias(column))
        kept[name] = df.join(ids, column, "left_anti")
        audits.append(df.join(ids, column, "left_semi").groupBy(F.col(column).alias("user_id")).agg(
            F.count(F.lit(1)).alias("rows_erased")).select(F.lit(name).alias("table_name"), "user_id", "rows_erased"))
    return kept, union_all(audits)


def tombstones(requests: DataFrame, topic: str) -> DataFrame:
    """Null-valued records that delete the key from a compacted stream."""
    return requests.select(
        F.col("user_id").cast("string").alias("key"), F.lit(None).cast("string").alias("value"), F.lit(topic).alias("topic")
    ).distinct()


def enforce_retention(df: DataFrame, data_class: str, ts: str, as_of) -> DataFrame:
    return apply_ttl(df, ts, RETENTION_DAYS[data_class], as_of)


def erasure_sla(requests: DataFrame, audit: DataFrame, as_of, hours: int = DELETION_SLA_HOURS) -> DataFrame:
    """Requests still open after the allowed hours."""
    done = audit.groupBy("user_id").agg(F.min("erased_at").alias("erased_at"))
    late = F.col("requested_at") < shift(as_time(as_of), hours=-hours)
    open_ = requests.join(done, "user_id", "left").where(F.col("erased_at").isNull() & late)
    waited = (F.unix_seconds(as_time(as_of)) - F.unix_seconds(F.col("requested_at").cast("timestamp"))) / 3600.0
    return open_.select("user_id", "requested_at", F.floor(waited).alias("hours_open"))
