"""The reference-shaped tables, derived by Spark from whole given tables.

Fault cases (missing, unknown, late, future, impossible, redelivered) hang on
the value of the JSON field ``k`` or of other columns; no row is left out.
``checks/sql.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.scalars import PLAYBACK_TOPIC

AS_OF = "2024-01-31 00:00:00"


def case(col, pairs: dict, default):
    out = None
    for value, result in pairs.items():
        out = F.when(col == value, F.lit(result)) if out is None else out.when(col == value, F.lit(result))
    return out.otherwise(default)


DEVICES = {0: "smart_tv", 1: "mobile", 2: "tablet", 3: "web"}
TYPES = {"view": "video_play", "signup": "video_pause", "click": "video_seek", "purchase": "video_complete"}
STATES = {"O": "active", "P": "past_due"}
OPS = {"O": "c", "P": "u"}
CATEGORY = {0: "STANDARD", 1: "ECONOMY", 2: "LARGE", 3: "MEDIUM", 4: "SMALL"}


# schemas seen so far, so a file's footer is read for its schema once
SCHEMAS: dict = {}


class Given:
    """Lazy tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def read(self, name: str) -> DataFrame:
        path = f"{self.dir}/{name}.parquet"
        if path not in SCHEMAS:
            SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(SCHEMAS[path]).parquet(path)

    @property
    def raw(self) -> DataFrame:
        """Playback deliveries; events with k >= 95 arrive twice."""
        k, ts = F.col("k"), F.col("ts").cast("timestamp")
        ev = self.read("events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
        ev = ev.withColumn("delivery", F.explode(F.sequence(F.lit(0), F.when(k >= 95, 1).otherwise(0))))
        content = F.concat(F.when(k >= 90, F.lit("ghost_")).otherwise(F.lit("cnt_")), F.lpad(k.cast("string"), 6, "0"))
        value, user, eid = F.col("value"), F.col("user_id"), F.col("event_id")
        return ev.select(
            "event_id",
            case(F.col("event_type"), TYPES, F.col("event_type")).alias("event_type"),
            F.when(k == 94, "99.0.0-unauthorized").otherwise("1.0.0").alias("schema_version"),
            "user_id",
            (user * 100 + F.dayofmonth("ts")).alias("session_id"),
            (user * 10 + eid % 5).alias("device_id"),
            case(eid % 5, DEVICES, F.lit("streaming_stick")).alias("device_type"),
            F.concat(F.lit("1."), (user % 3).cast("string"), F.lit(".0")).alias("app_version"),
            F.when(k == 98, F.lit("")).when(k != 99, content).alias("content_id"),
            F.when(k == 96, -value).otherwise(value * 20.0).alias("position_seconds"),
            F.when((k == 95) & (value > 100), value * 1000.0).otherwise(value).alias("playback_seconds"),
            F.when(k == 97, ts + F.expr("INTERVAL 40 DAYS")).when(k == 93, ts - F.expr("INTERVAL 10 DAYS"))
             .otherwise(ts).alias("event_time"),
            (ts + F.make_dt_interval(secs=(F.col("delivery") * 60 + 1).cast("decimal(18,6)"))).alias("ingestion_time"),
            (user % 6).alias("source_partition"),
        )

    @property
    def events(self) -> DataFrame:
        from marquee.operators.staging import stg_playback_events

        return stg_playback_events(self.raw, AS_OF)

    @property
    def content(self) -> DataFrame:
        return self.read("part").select(
            F.concat(F.lit("cnt_"), F.lpad(F.col("p_partkey").cast("string"), 6, "0")).alias("content_id"),
            F.col("p_name").alias("title"),
            F.array("p_type", "p_brand").alias("genres"),
            F.when(F.col("p_size") > 25, "en").otherwise("hi").alias("language"),
            (F.lit(2005) + F.col("p_size") % 20).alias("release_year"),
            F.col("p_brand").alias("director"),
            F.floor(F.col("p_retailprice") * 6.0).cast("int").alias("duration_seconds"),
            F.lit("U/A 13+").alias("maturity_rating"),
            (F.col("p_type") == "PROMO").alias("is_series"),
            F.col("p_size").alias("total_seasons"),
        )

    @property
    def movies(self) -> DataFrame:
        return self._documents.where(~F.col("is_series")).drop("is_series", "total_seasons")

    @property
    def series(self) -> DataFrame:
        return self._documents.where("is_series").drop("is_series", "duration_seconds", "keywords").withColumn(
            "creator", F.lit(None).cast("string")).withColumn("keywords", F.lit(None).cast("array<string>"))

    @property
    def _documents(self) -> DataFrame:
        return self.content.withColumns({
            "synopsis": F.concat(F.lit("A story of "), F.col("title")),
            "cast": F.array("director", F.lit("Ensemble")),
            "keywords": F.array(F.get("genres", 0), F.lit("drama")),
        })

    @property
    def searches(self) -> DataFrame:
        ev = self.read("events").where(F.col("event_type") == "signup")
        k = F.get_json_object("props", "$.k").cast("int")
        cid = F.concat(F.lit("cnt_"), F.lpad(k.cast("string"), 6, "0"))
        ts = F.col("ts").cast("timestamp")
        return ev.select(
            "event_id", "user_id", (F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session_id"),
            (F.col("user_id") * 10).alias("device_id"), F.lit("web").alias("device_type"),
            F.concat(F.lit("query "), k.cast("string")).alias("query_text"), (k % 20).alias("results_count"),
            F.when(k >= 80, F.lit("")).when(k >= 30, cid).alias("selected_content_id"),
            ts.alias("event_time"), (ts + F.expr("INTERVAL 1 SECOND")).alias("ingestion_time"),
        )

    @property
    def recs(self) -> DataFrame:
        ev = self.read("events").where(F.col("event_type").isin("view", "click"))
        k = F.get_json_object("props", "$.k").cast("int")
        return ev.select(
            "event_id", "user_id",
            F.when(F.col("event_type") == "click", "recommendation_click").otherwise("recommendation_impression").alias("event_type"),
            F.concat(F.lit("m"), (k % 3).cast("string")).alias("model_version"),
            F.col("ts").cast("timestamp").alias("event_time"),
        )

    @property
    def sessions(self) -> DataFrame:
        from marquee.operators.sessions import watch_sessions

        return watch_sessions(self.events, self.content)

    @property
    def activity(self) -> DataFrame:
        from marquee.plans.marts import daily_user_activity

        return daily_user_activity(self.sessions)

    @property
    def users(self) -> DataFrame:
        bal = F.col("c_acctbal")
        key = F.col("c_custkey").cast("string")
        mail = F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@mail"),
                        F.col("c_nationkey").cast("string"), F.lit(".example.com"))
        return self.read("customer").select(
            F.col("c_custkey").alias("user_id"), F.when(bal >= 0, mail).alias("email"),
            F.when(bal > 9000, F.lit(None)).when(bal > 8000, F.lit("12345")).otherwise(F.concat(F.lit("+91"), F.lpad(key, 10, "9"))).alias("phone"),
            F.concat(F.lit("C"), F.col("c_nationkey").cast("string")).alias("country_code"),
            F.date_add(F.lit("2020-01-01").cast("date"), F.col("c_nationkey")).cast("timestamp").alias("created_at"),
            F.concat_ws(".", F.lit("10"), F.col("c_nationkey").cast("string"), (F.col("c_custkey") % 256).cast("string"), F.lit("7")).alias("ip"),
        )

    @property
    def plans(self) -> DataFrame:
        return self.read("region").select(
            F.concat(F.lit("plan_"), F.col("r_regionkey").cast("string")).alias("plan_id"), F.col("r_name").alias("plan_name"))

    @property
    def subs(self) -> DataFrame:
        return self.read("orders").select(
            F.col("o_orderkey").alias("subscription_id"), F.col("o_custkey").alias("user_id"),
            F.concat(F.lit("plan_"), (F.col("o_orderkey") % 5).cast("string")).alias("plan_id"),
            case(F.col("o_orderstatus"), STATES, F.lit("canceled")).alias("status"),
            F.col("o_orderdate").cast("timestamp").alias("updated_at"),
            case(F.col("o_orderstatus"), OPS, F.lit("d")).alias("op"),
        )

    @property
    def devices(self) -> DataFrame:
        s = self.read("supplier")
        return s.select(
            F.col("s_suppkey").alias("device_id"), case(F.col("s_nationkey") % 5, DEVICES, F.lit("streaming_stick")).alias("device_type"),
            F.col("s_name").alias("device_name"), F.when(F.col("s_acctbal") > 1000, "Android").alias("os"),
            F.when(F.col("s_acctbal") > 5000, "").otherwise("2.1.0").alias("app_version"))

    @property
    def purchases(self) -> DataFrame:
        """(user, item) occurrences: orders joined with their lines and parts."""
        orders = self.read("orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
        lines = self.read("lineitem").select("l_orderkey", "l_partkey")
        item = F.concat_ws("/", "p_brand", "p_type").alias("content_id")
        parts = self.read("part").select("p_partkey", item)
        return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(
            parts, lines.l_partkey == parts.p_partkey).select("user_id", "content_id")

    @property
    def items(self) -> DataFrame:
        """Catalog of the purchased items, two rows of shape (content_id, title, …) per brand and type."""
        return self.read("part").groupBy(F.concat_ws("/", "p_brand", "p_type").alias("content_id")).agg(
            F.min("p_name").alias("title"), F.min(F.lit(2005) + F.col("p_size") % 20).alias("release_year"),
            F.max(F.floor(F.col("p_retailprice") * 6.0).cast("int")).alias("duration_seconds"),
            F.lit("U/A 13+").alias("maturity_rating"))

    @property
    def chunks(self) -> DataFrame:
        label, vec = F.col("label"), F.col("vec_id")
        kind = case(label % 6, CATEGORY, F.lit("PROMO"))
        return self.read("embeddings").select(
            vec.alias("chunk_id"), F.concat(F.lit("Brand#"), (vec % 25 + 1).cast("string"), F.lit("/"), kind).alias("content_id"),
            F.array(F.concat(F.lit("genre_"), label.cast("string"))).alias("genres"), F.col("embedding").alias("vec"), "label")

    @property
    def vector_queries(self) -> DataFrame:
        return self.chunks.select(F.col("chunk_id").alias("query_id"), "vec")

    @property
    def raw_json(self) -> DataFrame:
        """Deliveries as JSON text; k = 94 (version 99) carries an extra field, k = 92 is cut off."""
        raw = self.raw
        extra = F.when(F.col("schema_version") != "1.0.0", F.lit("x")).alias("unauthorized_field")
        fmt = "yyyy-MM-dd HH:mm:ss.SSSSSS"
        cols = [F.date_format(c, fmt).alias(c) if c in ("event_time", "ingestion_time") else F.col(c)
                for c in raw.columns if c != "source_partition"]
        text = F.to_json(F.struct(*cols, extra))
        return raw.select(F.when(F.col("content_id") == "ghost_000092", F.lit("not json")).otherwise(text).alias("value"), "event_id")


def finish(df: DataFrame) -> DataFrame:
    """Types both engines share: naive times, joined string arrays."""
    out = {}
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        if kind == "timestamp":
            out[f.name] = F.col(f.name).cast("timestamp_ntz")
        elif kind == "array<string>":
            out[f.name] = F.array_join(f.name, "|")
    return df.withColumns(out) if out else df


__all__ = ["AS_OF", "Given", "PLAYBACK_TOPIC", "finish"]
