"""Counts of a running stream, taken from its own metrics, and a stop after so many events."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

RECEIVED, OBSERVED = "received", "playback"
LAST_NEWS = 120  # seconds for the events of a run that has ended


def observed(df: DataFrame, **counted: Column) -> DataFrame:
    """Count a stream's rows on their way: all of them (``received``) and those of each condition. No further pass is made."""
    measures = [F.sum(F.when(c, 1).otherwise(0)).cast("bigint").alias(n) for n, c in counted.items()]
    return df.observe(OBSERVED, F.count(F.lit(1)).alias(RECEIVED), *measures)


class Meter(StreamingQueryListener):
    """Adds up what the batches of a run observed; a batch told twice counts once.

    ``offset`` is where the last counted batch ended.
    """

    def __init__(self):
        self.run: str | None = None
        self.told: dict[tuple[str, int], dict[str, int]] = {}
        self.ends: dict[str, str] = {}
        self.over: set[str] = set()
        self.news = threading.Condition()

    @property
    def batches(self) -> dict[int, dict[str, int]]:
        return {batch: counts for (run, batch), counts in sorted(self.told.items()) if run == self.run}

    @property
    def totals(self) -> dict[str, int]:
        out = Counter()
        for counts in self.batches.values():
            out.update(counts)
        return dict(out)

    @property
    def offset(self) -> str | None:
        return self.ends.get(self.run)

    def wait(self, received: int | None, seconds: float | None) -> bool:
        """Until the run is over or has received so many events; False if neither came in time."""
        enough = lambda: self.run in self.over or (received is not None and self.totals.get(RECEIVED, 0) >= received)
        with self.news:
            return self.news.wait_for(enough, seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        counts = p.observedMetrics.get(OBSERVED)
        with self.news:
            if counts is not None:
                self.told[str(p.runId), p.batchId] = {k: v or 0 for k, v in counts.asDict().items()}
                if p.sources:
                    self.ends[str(p.runId)] = p.sources[0].endOffset
            self.news.notify_all()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.news:
            self.over.add(str(event.runId))
            self.news.notify_all()


def run_metered(spark: SparkSession, start: Callable[[], StreamingQuery], stop_after: int | None = None, seconds: float | None = None) -> Meter:
    """Run a query of an :func:`observed` stream until it ends, has received ``stop_after`` events, or ``seconds`` are over.

    A batch that is under way when the query is stopped is not counted unless it ends; the next run over the same
    checkpoint does it again and goes on from there. Counts that are not whole are an error.
    """
    meter = Meter()
    spark.streams.addListener(meter)
    try:
        query = start()
        meter.run = str(query.runId)
        meter.wait(stop_after, seconds)
        if query.isActive:
            query.stop()
        told = meter.wait(None, LAST_NEWS)  # the end is told after the last batch
        if query.exception() is not None:
            raise query.exception()
        if not told:
            raise TimeoutError(f"run {meter.run} ended, but its last counts did not come in {LAST_NEWS} seconds")
        return meter
    finally:
        spark.streams.removeListener(meter)
