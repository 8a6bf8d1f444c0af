"""The stopped and resumed stream over rows built here: no delivery left out, no failure told as a result."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from checks import streams
from checks.streams import in_batches
from marquee.session import scratch_path
from marquee.streaming import meter
from tests.test_repeated_keys import both


def events(spark, n):
    """Every fifth event has no time; keys come twice or are null."""
    start = dt.datetime(2024, 1, 1)
    data = [(i // 2 if i % 7 else None, None if i % 5 == 0 else start + dt.timedelta(minutes=i), i % 4, "view", float(i), '{"k": %d}' % (i % 100)) for i in range(n)]
    return spark.createDataFrame(data, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")


def test_batches_hold_rows_without_a_place(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else i) for i in range(40)], "id bigint, at bigint")
    out = str(tmp_path / "o")
    streams.run_to_end(in_batches(df, F.col("at"), 4), lambda batch, n: batch.withColumn("n", F.lit(n)).write.mode("append").parquet(out))
    got = rows(spark.read.parquet(out), "id", "n")
    assert sorted(i for i, _ in got) == list(range(40))
    assert {n for i, n in got if i % 3 == 0} == {0} and {n for _, n in got} == {0, 1, 2, 3}


def test_every_delivery_is_stored(spark, tmp_path):
    got, want = both(spark, "t10_stop_and_resume", tmp_path, events=events(spark, 200))
    assert got == want and len(got[1]) > 80


def test_no_events_give_no_rows(spark, tmp_path):
    got, want = both(spark, "t10_stop_and_resume", tmp_path, events=events(spark, 0))
    assert got == want


def test_lost_counts_and_rows_are_told(spark, tmp_path, monkeypatch):
    events(spark, 200).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    run = streams.stopped_and_resumed
    found = []
    monkeypatch.setattr(streams, "stopped_and_resumed", lambda g: found.append(run(g)) or found[-1])
    build = lambda: {r.all_counted for r in queries()["t10_stop_and_resume"](spark, str(tmp_path)).collect()}
    assert build() == {True}
    stored, sent, first, second = found[0]
    monkeypatch.setattr(streams, "stopped_and_resumed", lambda g: (stored, sent, first, meter.Meter()))
    assert build() == {False}
    monkeypatch.setattr(streams, "stopped_and_resumed", lambda g: (stored.where("event_id < 90"), sent, first, second))
    assert build() == {False}


def test_counts_that_do_not_come_are_an_error(spark, monkeypatch):
    src = meter.observed(in_batches(spark.range(10).toDF("id"), F.col("id"), 2))
    start = lambda: src.writeStream.format("noop").option("checkpointLocation", scratch_path(spark, "c")).trigger(processingTime="1 second").start()
    monkeypatch.setattr(meter, "LAST_NEWS", 0.5)
    monkeypatch.setattr(meter.Meter, "onQueryTerminated", lambda self, event: None)
    with pytest.raises(TimeoutError):
        meter.run_metered(spark, start, seconds=1)
