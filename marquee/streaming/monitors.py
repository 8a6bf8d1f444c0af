"""Dead-letter rates and threshold alerts on metric tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

# Limits on dead letters.
MAX_DLQ_PER_SECOND = 5.0
MAX_DLQ_SHARE = 0.001


def dlq_rate(dlq: DataFrame, ingress: DataFrame, width: str = "5 minutes", slide: str = "1 minute",
             failed: str = "failed_at", received: str = "received_at") -> DataFrame:
    """Dead letters per second and as a share of ingress over sliding windows.

    Both inputs are counted per slide first, so only small counts are spread
    over the overlapping windows.
    """
    def per_slide(df, ts, bad):
        return df.groupBy(F.window(ts, slide).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
            F.col("w.start").alias("ts"), (F.col("n") if bad else F.lit(0).cast("bigint")).alias("dead"),
            (F.lit(0).cast("bigint") if bad else F.col("n")).alias("total"))

    counts = per_slide(dlq, failed, True).unionByName(per_slide(ingress, received, False))
    both = counts.groupBy(F.window("ts", width, slide).alias("w")).agg(
        F.sum("dead").alias("dlq_count"), F.sum("total").alias("ingress_count"))
    return _rates(both)


def _rates(both: DataFrame) -> DataFrame:
    seconds = F.unix_seconds("w.end") - F.unix_seconds("w.start")
    rate = F.col("dlq_count") / seconds.cast("double")
    share = F.col("dlq_count") / F.greatest("ingress_count", F.lit(1))
    return both.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "dlq_count", "ingress_count",
        rate.alias("dlq_per_second"), share.alias("dlq_share"), (rate > MAX_DLQ_PER_SECOND).alias("rate_breach"),
        (share > MAX_DLQ_SHARE).alias("share_breach"))


def stream_dlq_rate(dlq: DataFrame, ingress: DataFrame, width: str = "5 minutes", slide: str = "1 minute", delay: str = "10 seconds",
                    failed: str = "failed_at", received: str = "received_at") -> DataFrame:
    """:func:`dlq_rate` of two streams, a row for each window that the watermark has closed.

    Both sides are counted per slide, the counts are added up per sliding window, and the windows of the two
    sides meet in a stream-stream join. Windows of one side only come out too, once the
    other's watermark has passed them. State holds counts only, a row per open slide and window.
    """
    def windows(df, ts, name):
        slides = df.withWatermark(ts, delay).groupBy(F.window(ts, slide).alias("s")).agg(F.count(F.lit(1)).alias("n"))
        wide = slides.groupBy(F.window(F.window_time("s"), width, slide).alias("w")).agg(F.sum("n").alias(name))
        return wide.withColumnRenamed("w", f"{name}_w")

    dead, total = windows(dlq, failed, "dlq_count"), windows(ingress, received, "ingress_count")
    both = dead.join(total, F.col("dlq_count_w") == F.col("ingress_count_w"), "full_outer")
    return _rates(both.select(F.coalesce("dlq_count_w", "ingress_count_w").alias("w"),
                              *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("dlq_count", "ingress_count")]))


@dataclass(frozen=True)
class Rule:
    """A metric that must not stay past its limit for ``hold_seconds``."""

    alert: str
    metric: str
    op: str
    limit: float
    hold_seconds: int
    severity: str


# The platform's alert rules.
RULES = [
    Rule("ConsumerLagHigh", "kafka_consumer_lag", ">", 500.0, 120, "warning"),
    Rule("DLQRateElevated", "dlq_rate_5m", ">", 5.0, 60, "critical"),
    Rule("DataQualityFailure", "dq_check_status", "==", 0.0, 60, "critical"),
    Rule("TaskFailure", "task_failures_total", ">", 0.0, 60, "warning"),
]


def breaches(metrics: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Every sample with the rules on its metric: ``alert``, ``severity``, ``hold`` seconds and whether it is ``broken``."""
    table = metrics.sparkSession.createDataFrame([(r.alert, r.metric, r.op, r.limit, r.hold_seconds, r.severity) for r in rules],
                                                 "alert string, metric string, op string, bound double, hold bigint, severity string")
    value, bound = F.col("value"), F.col("bound")
    broken = (
        F.when(F.col("op") == ">", value > bound).when(F.col("op") == ">=", value >= bound)
        .when(F.col("op") == "<", value < bound).when(F.col("op") == "<=", value <= bound).otherwise(value == bound)
    )
    # the rule list is a constant of a few rows
    return metrics.join(F.broadcast(table), "metric").withColumn("broken", broken)


def evaluate_alerts(metrics: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Intervals in which a rule stayed broken at least its hold time.

    metrics: metric, series, ts, value. Consecutive broken samples of a series
    form one interval.
    """
    series = Window.partitionBy("alert", "series").orderBy("ts")
    flagged = breaches(metrics, rules)
    starts = F.col("broken") & ~F.coalesce(F.lag("broken").over(series), F.lit(False))
    marked = flagged.withColumn("starts", starts.cast("int"))
    islands = marked.withColumn("island", F.sum("starts").over(series)).where("broken")
    spans = islands.groupBy("alert", "severity", "series", "island", "hold").agg(
        F.min("ts").alias("firing_from"), F.max("ts").alias("firing_to"), F.count(F.lit(1)).alias("samples"))
    held = F.unix_micros("firing_to") - F.unix_micros("firing_from") >= F.col("hold") * 1_000_000
    return spans.where(held).select("alert", "severity", "series", "firing_from", "firing_to", "samples")
