"""Streams with keyed state of their own: late flags in arrival order and alerts held by timers.

Needs the RocksDB state store (``STATE_STORE``). Rows travel through Python in Arrow batches as one struct
column, times as microseconds, so no value changes its type on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from marquee.streaming.monitors import RULES, Rule, breaches

STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}
MICROS = 1_000_000


def use_state_store(spark: SparkSession) -> None:
    """State with its own variables and timers lives in RocksDB."""
    for key, value in STATE_STORE.items():
        spark.conf.set(key, value)


def _times(schema: StructType) -> list[str]:
    return [f.name for f in schema.fields if f.dataType.typeName() == "timestamp"]


class LateFlags(StatefulProcessor):
    """Largest event time and number of late events of a source partition, over all batches."""

    def __init__(self, lateness_seconds: float):
        self.lateness = int(lateness_seconds * MICROS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "high_mark bigint, late bigint, events bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        mark, late, events = self.seen.get() if self.seen.exists() else (None, 0, 0)
        batch = pd.concat(list(rows), ignore_index=True).sort_values(["arrival_number", "instant"], kind="stable", ignore_index=True)
        known = batch["instant"].notna().to_numpy()
        least = np.iinfo(np.int64).min
        times = batch["instant"].fillna(least).astype("int64").to_numpy()
        high = np.maximum.accumulate(np.maximum(times, least if mark is None else mark))
        flags = known & (high > least) & (times < high - np.where(high > least, self.lateness, 0))
        counts = late + np.cumsum(flags)
        if len(batch):
            top = int(high[-1])
            self.seen.update((None if top == least else top, int(counts[-1]), int(events) + len(batch)))
            yield pd.DataFrame({"row": batch["row"], "is_late": pd.Series(flags).astype(object).where(pd.Series(known), None), "late_count": counts})

    def close(self) -> None:
        pass


def flag_late(df: DataFrame, order_col: str, lateness_seconds: float = 30.0, scope: list[str] = (), ts: str = "event_time") -> DataFrame:
    """A stream's rows with ``is_late`` and ``late_count``, the late events of the scope so far, this one included.

    The running maximum of ``ts`` per scope (a source partition) is state, so flags do not depend on
    how arrivals are cut into batches, and no row is dropped. Within a batch the rows of a scope are
    put in order of ``order_col``; a batch is bounded by the source's ``maxOffsetsPerTrigger``. A null
    time is neither late nor does it raise the maximum; its flag is null. Copies of an event change
    no other event's flag. ``df`` needs the setting in ``STATE_STORE``.
    """
    times = _times(df.schema)
    columns = [F.unix_micros(c).alias(c) if c in times else F.col(c) for c in df.columns]
    packed = df.select(_key(*scope).alias("scope"), F.col(order_col).cast("bigint").alias("arrival_number"), F.unix_micros(ts).alias("instant"), F.struct(*columns).alias("row"))
    made = StructType().add("row", packed.schema["row"].dataType).add("is_late", "boolean").add("late_count", "long")
    out = packed.groupBy("scope").transformWithStateInPandas(LateFlags(lateness_seconds), made, "append", "none")
    back = [F.timestamp_micros(f"row.`{c}`").alias(c) if c in times else F.col(f"row.`{c}`").alias(c) for c in df.columns]
    return out.select(*back, "is_late", "late_count")


def _key(*columns: str) -> Column:
    """Grouping columns as one text without nulls: rows of null keys would not stay together in pandas."""
    return F.to_json(F.struct(*columns)) if columns else F.lit("{}")


def late_totals(spark: SparkSession, checkpoint: str, scope: str = "") -> DataFrame:
    """(scope columns, high_mark, late, events) out of the state of a :func:`flag_late` stream, as its last batch left it.

    ``scope`` gives names and types of the scope columns.
    """
    state = spark.read.format("statestore").option("stateVarName", "seen").load(checkpoint)
    rows = state.select(F.from_json("key.scope", scope).alias("at"), "value.*") if scope else state.select("value.*")
    kept = [F.col("at.*")] if scope else []
    return rows.select(*kept, F.timestamp_micros("high_mark").alias("high_mark"), "late", "events")


class AlertTimers(StatefulProcessor):
    """One alert's series: samples in order of time, the open breach, and a timer for its hold.

    Samples wait in state until the watermark has passed them: the newest of a batch sets a timer at its time,
    rounded up to a millisecond. A breach sets the hold timer at its start plus the hold and a healthy sample deletes it.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rule = handle.getValueState("rule", "hold bigint, severity string")
        self.waiting = handle.getValueState("waiting", "ts array<bigint>, broken array<boolean>, samples array<bigint>")
        self.open = handle.getValueState("open", "since bigint, last bigint, samples bigint, held boolean")

    def _waiting(self) -> dict[int, tuple[bool, int]]:
        if not self.waiting.exists():
            return {}
        return {int(t): (bool(b), int(n)) for t, b, n in zip(*self.waiting.get())}

    def _keep(self, waiting: dict[int, tuple[bool, int]]) -> None:
        self.waiting.update((list(waiting), [b for b, _ in waiting.values()], [n for _, n in waiting.values()]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        waiting, newest = self._waiting(), None
        for frame in rows:
            if not self.rule.exists():
                self.rule.update((int(frame["hold"].iloc[0]) * MICROS, str(frame["severity"].iloc[0])))
            for ts, broken in zip(frame["ts"].tolist(), frame["broken"].tolist()):
                was, n = waiting.get(ts, (False, 0))
                waiting[ts] = bool(was or broken), n + 1
                newest = ts if newest is None else max(newest, ts)
        if newest is not None:
            self._keep(waiting)
            self.handle.registerTimer(_millis(newest))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        hold, severity = self.rule.get()
        row, held, firing, waiting = {"alert_key": key[0], "severity": severity}, [], {}, self._waiting()
        breach = tuple(self.open.get()) if self.open.exists() else None

        def outlived(b):
            held.append(row | {"since": b[0], "last": b[1], "samples": b[2], "state": "held"})
            return *b[:3], True

        due = sorted(t for t in waiting if _millis(t) <= now)
        for ts in due:
            broken, n = waiting.pop(ts)
            if breach and not breach[3] and ts + broken > breach[0] + hold:  # no healthy sample came before the hold was over
                breach = outlived(breach)
            if not broken:
                # a waiting sample may need the same millisecond; its timer stays
                if breach and not breach[3] and _millis(breach[0] + hold) > now and all(_millis(t) != _millis(breach[0] + hold) for t in waiting):
                    self.handle.deleteTimer(_millis(breach[0] + hold))
                breach = None
                continue
            if breach is None:
                breach = (ts, ts, 0, False)
                if _millis(ts + hold) > now:
                    self.handle.registerTimer(_millis(ts + hold))
            breach = (breach[0], ts, breach[2] + n, breach[3])
            if ts - breach[0] >= hold:
                firing[breach[0]] = row | {"since": breach[0], "last": ts, "samples": breach[2], "state": "firing"}
        if breach and not breach[3] and _millis(breach[0] + hold) <= now:
            breach = outlived(breach)
        if due:
            self._keep(waiting)
        if breach:
            self.open.update(breach)
        elif self.open.exists():
            self.open.clear()
        if held or firing:
            yield pd.DataFrame([*held, *firing.values()])

    def close(self) -> None:
        pass


def _millis(micros: int) -> int:
    return -(-micros // 1000)


def stream_alerts(metrics: DataFrame, rules: list[Rule] = RULES, delay: str = "1 minute") -> DataFrame:
    """Alerts of a metric stream (metric, series, ts, value): ``alert severity series firing_from firing_to samples state``.

    ``held``: a breach has outlived its hold, told once, when the hold timer expires. ``firing``: the interval
    of broken samples so far, told again as it grows, so the newest row of (alert, series, firing_from) is the one that
    ``evaluate_alerts`` finds. A null value counts as healthy; samples of one series with equal times are one, broken if any is.
    Samples behind the watermark (``delay``) are left out. Needs the setting in ``STATE_STORE``.
    """
    marked = breaches(metrics, rules).withWatermark("ts", delay)
    rows = marked.select(_key("alert", "series").alias("alert_key"), "severity", "hold", F.unix_micros("ts").alias("ts"),
                         F.coalesce("broken", F.lit(False)).alias("broken"), F.col("ts").alias("event_time"))
    made = StructType().add("alert_key", "string").add("severity", "string")
    for c, t in (("since", "long"), ("last", "long"), ("samples", "long"), ("state", "string")):
        made = made.add(c, t)
    out = rows.groupBy("alert_key").transformWithStateInPandas(AlertTimers(), made, "append", "eventTime")
    named = StructType().add("alert", "string").add("series", marked.schema["series"].dataType)
    return out.withColumn("at", F.from_json("alert_key", named)).select(
        "at.alert", "severity", "at.series", F.timestamp_micros("since").alias("firing_from"), F.timestamp_micros("last").alias("firing_to"), "samples", "state")


def firing_intervals(alerts: DataFrame) -> DataFrame:
    """The last word of every firing interval out of the stored rows of :func:`stream_alerts`."""
    newest = alerts.where("state = 'firing'").groupBy("alert", "severity", "series", "firing_from")
    return newest.agg(F.max("firing_to").alias("firing_to"), F.max("samples").alias("samples"))
