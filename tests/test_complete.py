"""The loss-free playback stream: late events, redeliveries, repeated batches and a new checkpoint."""

from pyspark.sql import functions as F

from checks.streams import in_batches
from marquee.operators import sessions
from marquee.operators.staging import validate_events
from marquee.streaming import complete, meter
from tests.fixtures import AS_OF, EVENT_DDL, content_df, event, events_df

FIRST = [event("e1", play=10.0, pos=10.0), event("e7", user="u2", session="s2", content="c2", play=5.0, time="2024-03-01 11:00:00")]
LATE = [event("e2", play=4.0, pos=90.0, time="2024-03-01 10:01:00"), event("e1", play=10.0, pos=10.0), event("bad", content=None)]


def arriving(spark, items, start=0):
    return spark.createDataFrame([(*i, start + n) for n, i in enumerate(items)], f"{EVENT_DDL}, arrival bigint")


def check_tables(spark, root, rows, received):
    assert rows(complete.stored_events(spark, root), "event_id", "is_late", "content_title") == [
        ("e1", False, "One"), ("e2", True, "One"), ("e7", False, "Two")]
    assert rows(complete.stored_dead_letters(spark, root), "failure_reason") == [("Missing required field: 'content_id'",)]
    assert rows(complete.stored_counts(spark, root), "received", "dead_lettered", "stored", "late", "redelivered") == [(received, 1, 3, 1, received - 4)]
    want = events_df(spark, FIRST + LATE[:1])
    assert rows(complete.stored_sessions(spark, root, content_df(spark))) == rows(sessions.play_sessions(want, content_df(spark)))
    assert rows(complete.stored_windows(spark, root)) == rows(sessions.tumbling_metrics(want))


def test_late_and_repeated_batches(spark, tmp_path, rows):
    root = str(tmp_path / "out")
    flags = {"e2": True}

    def batch(items, start):
        df = validate_events(arriving(spark, items, start), AS_OF)
        return df.withColumn("is_late", F.col("event_id").isin([k for k, v in flags.items() if v])).withColumn("late_count", F.lit(0).cast("bigint"))

    def sink(run):
        return complete.complete_sink(content_df(spark), root, run, "arrival", AS_OF)

    sink("a")(batch(FIRST, 0), 0)
    sink("a")(batch(LATE, 10), 1)
    sink("a")(batch(LATE, 10), 1)
    sink("b")(batch(FIRST, 20), 0)  # a new checkpoint delivers old events again
    check_tables(spark, root, rows, 7)


def test_stream_over_batches_and_runs(spark, tmp_path, rows):
    root = str(tmp_path / "out")

    def run(items, check, start=0):
        src = in_batches(arriving(spark, items, start), F.col("arrival"), 2)
        go = lambda: complete.run_complete_stream(
            src, content_df(spark), root, str(tmp_path / check), order_col="arrival", as_of=AS_OF, availableNow=True)
        return meter.run_metered(spark, go)

    spark.conf.set("spark.sql.shuffle.partitions", "2")
    seen = run(FIRST + LATE, "c1")
    assert seen.totals == {"received": 5, "dead_lettered": 1} and len(seen.batches) == 2
    check_tables(spark, root, rows, 5)
    run(FIRST, "c2", 90)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    check_tables(spark, root, rows, 7)
