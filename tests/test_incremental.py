"""The daily batch by changed days against a rebuild of everything."""

import glob
import os
import shutil

from pyspark.sql import functions as F

from marquee.plans import incremental
from tests.fixtures import AS_OF, content_df, event, events_df

TABLES = ["session_parts", "int_watch_sessions", "int_daily_user_activity", "int_content_engagement", "mart_daily_platform_metrics",
          "mart_content_performance", "rollup_content_hourly", "rollup_platform_daily"]


def some_days(days, users=2):
    return [event(f"{d}-{u}-{n}", ["video_play", "video_pause", "video_complete"][n % 3], user=f"u{u}", session=f"s{d}-{u}", content=f"c{u + 1}", play=30.0 * (n + d),
                  pos=100.0 * n, time=f"2024-02-{d:02} 1{n}:00:00") for d in days for u in range(users) for n in range(3)]


def test_only_changed_days_are_done_again(spark, tmp_path, rows):
    raw, root = str(tmp_path / "raw"), str(tmp_path / "out")
    put = lambda events: incremental.write_events(events_df(spark, events).coalesce(1), raw)
    refresh = lambda to: incremental.refresh(spark, raw, to, content_df(spark), AS_OF)
    put(some_days(range(1, 15)) + [event("n", time="2024-02-03 23:50:00", user="u9", session="night"), event("m", time="2024-02-04 00:10:00", user="u9", session="night", play=9.0)])
    assert len(refresh(root)["events"]) == 14
    assert refresh(root) == {}

    def same():
        whole = str(tmp_path / f"whole{len(os.listdir(tmp_path))}")
        refresh(whole)
        for t in TABLES:
            assert rows(incremental.stored(spark, root, t)) == rows(incremental.stored(spark, whole, t)), t

    before = {t: {f: os.path.getmtime(f) for f in glob.glob(f"{root}/{t}/*/*.parquet")} for t in TABLES}
    # a late event of a session across midnight, a second delivery of an old one, and a new title on another day
    put([event("late", time="2024-02-04 00:20:00", user="u9", session="night", play=7.0), event("4-0-1", "video_pause", time="2024-02-04 11:00:00", user="u0", session="s4-0", content="c2",
         arrived="2024-02-20 00:00:00"), event("new", time="2024-02-12 10:00:00", content="c9")])
    done = refresh(root)
    assert done["events"] == ["2024-02-04", "2024-02-12"]
    assert done["int_watch_sessions"] == [f"2024-02-{d:02}" for d in (3, 4, 5, 11, 12, 13)]
    same()
    for t in TABLES[:6]:  # the files of all other days are still the old ones
        allowed = set(done["events"] if t == "session_parts" else done["mart_content_performance"] if t == "mart_content_performance" else done["int_watch_sessions"])
        for f in set(before[t]) ^ set(glob.glob(f"{root}/{t}/*/*.parquet")):
            assert f.split("event_day=")[1][:10] in allowed
    # a day whose files are gone loses its rows everywhere
    shutil.rmtree(f"{raw}/event_day=2024-02-12")
    assert refresh(root)["events"] == ["2024-02-12"]
    same()
    assert incremental.stored(spark, root, "mart_daily_platform_metrics").where(F.col("metric_date") == "2024-02-12").isEmpty()


def test_only_the_folders_of_changed_days_are_read(spark, tmp_path):
    raw = str(tmp_path / "raw")
    incremental.write_events(events_df(spark, some_days([1, 2, 3, 4])), raw)
    read = incremental.read_days(spark, raw, ["2024-02-02", "2024-02-04", "2024-02-09"])
    assert {f.split("event_day=")[1][:10] for f in read.inputFiles()} == {"2024-02-02", "2024-02-04"}
    prints = incremental.fingerprints(spark, raw)
    assert "content" not in prints._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1]
    assert incremental.changed_days(prints, prints) == [] and len(incremental.changed_days(prints, None)) == 4


def test_nothing_at_all(spark, tmp_path):
    assert incremental.refresh(spark, str(tmp_path / "none"), str(tmp_path / "out"), content_df(spark), AS_OF) == {}
