"""Headline queries at one scale factor; prints one JSON line.

The derived source tables are first written as Parquet, as a platform would
hold them; that time is reported apart. Every query then runs twice to warm
up and BENCH_RUNS times for the median. All result rows are computed (written to
a sink that drops them).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from checks.given import Given, finish
from checks.registry import BUILDERS
from marquee.session import SETTINGS
from marquee.sources.lake import sorted_playback

HEADLINE = [
    "a17_recent_play_stats", "a18_device_breakdown", "w09_top_active_users", "w01_stg_playback_events",
    "a01_watch_sessions", "a05_churn_features", "a06_daily_platform_metrics", "a11_content_hourly",
    "w03_content_performance", "t04_late_flag", "t05_play_sessions", "d05_find_violations", "g06_mask_text",
    "r02_association_rules", "v02_knn",
]


class Stored(Given):
    """The derived tables read back from Parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str):
        super().__init__(spark, sf_dir)
        given, self.root = Given(spark, sf_dir), root
        sorted_playback(given.raw, f"{root}/raw")
        self._kept = {"raw": spark.read.parquet(f"{root}/raw").drop("month")}
        for name in ("content", "searches", "recs", "purchases"):
            getattr(given, name).write.parquet(f"{root}/{name}")
            self._kept[name] = spark.read.parquet(f"{root}/{name}")

    raw = property(lambda self: self._kept["raw"])
    content = property(lambda self: self._kept["content"])
    searches = property(lambda self: self._kept["searches"])
    recs = property(lambda self: self._kept["recs"])
    purchases = property(lambda self: self._kept["purchases"])


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "7"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("bench")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = (builder.config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
             .config("spark.ui.enabled", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    stored = Stored(spark, sf_dir, tempfile.mkdtemp(prefix="bench-"))
    load = time.perf_counter() - start
    times = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 2):
            start = time.perf_counter()
            run(finish(BUILDERS[name](stored)))
            taken.append(time.perf_counter() - start)
        times[name] = round(statistics.median(taken[2:]), 4)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"), "load_sec": round(load, 2), "cpus": int(cpus),
        "runs": runs, "shuffle_partitions": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
