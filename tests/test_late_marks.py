"""Late flags of the loss-free stream: scopes, null scopes and ties over several batches, without a stateful operator."""

import os

from pyspark.sql import functions as F

from checks.streams import in_batches
from marquee.streaming import complete, meter
from tests.fixtures import AS_OF, EVENT_DDL, content_df, event


def test_flags_over_batches_equal_brute_force(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(complete, "CHUNK_ROWS", 3)
    minutes = [5, 1, 9, 9, 2, 8, 14, 3, 13, 14, 0, 20, 19, 6, 21, 20]
    scopes = ["x", None, "y"]
    items = [(*event(f"e{n}", time=f"2024-03-01 10:{m:02d}:00"), n // 2, scopes[n % 3]) for n, m in enumerate(minutes)]
    df = spark.createDataFrame(items, f"{EVENT_DDL}, arrival bigint, part string")
    src, root, check = in_batches(df, F.col("arrival"), 3), str(tmp_path / "out"), str(tmp_path / "check")
    meter.run_metered(spark, lambda: complete.run_complete_stream(
        src, content_df(spark), root, check, order_col="arrival", scope=["part"], as_of=AS_OF, availableNow=True))
    want, high = [], {}
    for n, m in sorted(enumerate(minutes), key=lambda x: (x[0] // 2, x[1])):
        top = high[scopes[n % 3]] = max(m, high.get(scopes[n % 3], 0))
        want.append((f"e{n}", m < top - 0.5))
    assert rows(complete.stored_events(spark, root), "event_id", "is_late") == sorted(want)
    assert not os.path.exists(f"{check}/state")
