"""The stored tables of the erasure queries are written on all cores."""

import os
from types import SimpleNamespace

from checks import registry


def test_every_core_writes_a_file(spark):
    users = spark.range(400).withColumnRenamed("id", "user_id")
    subs = spark.sql("SELECT CASE WHEN id < 2000 THEN id % 400 ELSE (id - 2000) * 10 END AS user_id, 'canceled' AS status, timestamp '2024-01-01' AS updated_at FROM range(2040)")
    g = SimpleNamespace(spark=spark, users=users, subs=subs, raw=users, sessions=users)
    paths, audit = registry.erased_files(g)
    gone = {r.user_id for r in registry.requested(g).collect()}
    assert {(r.table_name, r.user_id, r.rows_erased) for r in audit.collect() if r.table_name != "subscriptions"} == {
        (t, u, 1) for t in ("users", "raw_playback_events", "fact_watch_sessions") for u in gone} and len(gone) == 40
    cores = spark.sparkContext.defaultParallelism
    for path in paths.values():
        assert len([f for f in os.listdir(path.removeprefix("file:")) if f.endswith(".parquet")]) >= cores > 6
