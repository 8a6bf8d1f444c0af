"""Stream jobs run over files in several micro-batches and compared with batch results."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from marquee.operators import rollups, sessions
from marquee.operators.staging import stg_playback_events
from marquee.sources.events import decode_json, read_event_stream
from marquee.sources.lake import read_lake, write_lake
from marquee.streaming import jobs, sinks
from tests.fixtures import AS_OF, as_json, at, content_df, event, events_df

NOW = {"availableNow": True}


def put(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    # the file source takes files by modification time
    stamp = 1_700_000_000 + len(os.listdir(folder))
    os.utime(path, (stamp, stamp))


def source(spark, folder):
    return read_event_stream(spark, "playback", "text", path=folder, maxFilesPerTrigger="1")


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def collect_stream(df, out, checkpoint, mode="append"):
    sink = sinks.foreach_batch_sink({"t": lambda d: d}, out)
    finish(df.writeStream.foreachBatch(sink).outputMode(mode).option("checkpointLocation", checkpoint).trigger(**NOW).start())
    return df.sparkSession.read.parquet(f"{out}/t")


@pytest.fixture
def folder(tmp_path):
    """Three files: a session with a copy and faults, a later session, and one that moves the watermark."""
    src = str(tmp_path / "src")
    put(src, "1.txt", [
        as_json(event("e1", play=120.0, pos=120.0)), as_json(event("e1", play=120.0, pos=120.0)),
        as_json(event("e2", content=None)), "garbage", as_json(event("e3", "video_pause", pos=130.0, play=5.0, time="2024-03-01 10:02:00")),
        as_json(event("e4", "video_jump")), as_json(event("e5", time="2024-03-01 23:00:00")), as_json(event("e6", time="2024-03-01 10:02:00"), event_time="soon"),
    ])
    put(src, "2.txt", [
        as_json(event("e7", user="u2", session="s2", content="c2", play=60.5, pos=900.0, time="2024-03-01 10:05:00")),
        as_json(event("e8", "video_seek", pos=500.0, time="2024-03-01 10:03:10")),
    ])
    put(src, "3.txt", [as_json(event("e9", user="u3", session="s3", content="c9", play=1.0, time="2024-03-01 11:30:00"))])
    return src


def test_whole_stream(spark, folder, tmp_path, rows):
    root, check = str(tmp_path / "out"), str(tmp_path / "check")
    src = source(spark, folder).withColumn("arrival", F.regexp_extract("event_id", r"\d+", 0).cast("bigint"))
    running = jobs.run_playback_stream(src, content_df(spark), root, check, as_of=AS_OF, order_col="arrival", timeout="10 minutes", **NOW)
    for q in running.values():
        finish(q)
    dead = rows(sinks.read_batches(spark, f"{root}/dead_letters").select("failure_reason"))
    assert dead == [
        ("Event timestamp is too far in future: 2024-03-01 23:00:00",), ("Invalid event_time format: soon",),
        ("Invalid event_type: 'video_jump'",), ("Missing required field: 'content_id'",), ("Payload is not a valid JSON dictionary",)]
    clean = sinks.read_batches(spark, f"{root}/events")
    # e8 comes behind e7: flagged as late, still kept
    assert rows(clean, "event_id", "content_title", "is_late") == [
        ("e1", "One", False), ("e3", "One", False), ("e7", "Two", False), ("e8", "One", True), ("e9", "Unknown Title", False)]
    done = jobs.merge_segments(sinks.read_batches(spark, f"{root}/sessions"))
    assert rows(done, "user_id", "session_id", "watch_seconds", "pause_count", "seek_count", "completion_percentage") == [
        ("u1", "s1", 120.0, 1, 1, 6.94), ("u2", "s2", 60.5, 0, 0, 25.0)]
    windows = sinks.read_batches(spark, f"{root}/windows")
    assert rows(windows, "window_start", "content_id", "events_count", "plays", "watch_seconds") == [
        (at("2024-03-01 10:00:00"), "c1", 1, 1, 120.0), (at("2024-03-01 10:02:00"), "c1", 1, 0, 0.0),
        (at("2024-03-01 10:03:00"), "c1", 1, 0, 0.0), (at("2024-03-01 10:05:00"), "c2", 1, 1, 60.5)]


def test_restart_does_not_repeat(spark, folder, tmp_path, rows):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    ok, _ = jobs.stream_split(source(spark, folder), AS_OF)
    first = rows(collect_stream(jobs.stream_dedup(jobs.typed(ok), "1 hour"), out, check), "event_id")
    put(folder, "4.txt", [as_json(event("e9", user="u3", time="2024-03-01 11:30:00")), as_json(event("e10", time="2024-03-01 11:31:00"))])
    ok, _ = jobs.stream_split(source(spark, folder), AS_OF)
    second = rows(collect_stream(jobs.stream_dedup(jobs.typed(ok), "1 hour"), out, check), "event_id")
    assert second == sorted(first + [("e10",)])


def test_repeated_batch_is_written_once(spark, tmp_path, rows):
    df = events_df(spark, [event("a"), event("b")])
    sink = sinks.foreach_batch_sink({"raw": lambda d: d, "ids": lambda d: d.select("event_id")}, str(tmp_path))
    sink(df, 0)
    sink(df, 0)
    sink(df.where("event_id = 'a'"), 1)
    assert rows(spark.read.parquet(f"{tmp_path}/raw"), "event_id") == [("a",), ("a",), ("b",)]
    assert rows(spark.read.parquet(f"{tmp_path}/ids"), "event_id") == [("a",), ("a",), ("b",)]


def test_new_checkpoint_replaces_nothing(spark, tmp_path, rows):
    """Batch numbers start anew with a checkpoint; what an earlier run wrote stays."""
    out = str(tmp_path / "out")
    for name in ("a", "b"):
        put(str(tmp_path / name), "1.txt", [as_json(event(name))])
        collect_stream(source(spark, str(tmp_path / name)).select("event_id"), out, str(tmp_path / f"check-{name}"))
    assert rows(sinks.read_batches(spark, f"{out}/t")) == [("a",), ("b",)]


def test_archive_of_several_writers(spark, tmp_path, rows):
    """Two streams and a batch job fill one archive; a batch that comes again replaces itself."""
    lake, topic = str(tmp_path / "lake"), F.lit("ott.playback.events.v1")
    write_lake(events_df(spark, [event("batch")]).withColumn("topic", topic), lake, AS_OF)

    def archive(name):
        stream = source(spark, str(tmp_path / name)).withColumn("topic", topic).drop("_corrupt_record")
        finish(jobs.write_lake_stream(stream, lake, str(tmp_path / f"check-{name}"), **NOW))

    for name in ("a", "b"):
        put(str(tmp_path / name), "1.txt", [as_json(event(f"{name}1"))])
        put(str(tmp_path / name), "2.txt", [as_json(event(f"{name}2"))])
        archive(name)
    write_lake(events_df(spark, [event("more")]).withColumn("topic", topic), lake, AS_OF)
    # the last batch of one stream was written, but its commit is lost
    for commit in ("1", ".1.crc"):
        os.remove(tmp_path / "check-a/commits" / commit)
    archive("a")
    got = read_lake(spark, lake, "2024-03-01", "playback")
    assert rows(got, "event_id") == [("a1",), ("a2",), ("b1",), ("b2",), ("batch",), ("more",)]
    assert "written_by" not in got.columns


def test_windows_equal_batch(spark, tmp_path, rows):
    rows_in = [event(f"e{i}", ["video_play", "video_pause"][i % 2], user=f"u{i % 3}", content=f"c{i % 2}", play=float(i),
                     time=str(at("2024-03-01 10:00:00") + dt.timedelta(seconds=i * 25))) for i in range(40)]
    src = str(tmp_path / "src")
    for part in range(4):
        put(src, f"{part}.txt", [as_json(r) for r in rows_in[part * 10:part * 10 + 10]])
    put(src, "end.txt", [as_json(event("end", user="z", content="zz", time="2024-03-01 20:00:00"))])
    stream = jobs.typed(source(spark, src)).withWatermark("event_time", "30 seconds")
    got = collect_stream(sessions.tumbling_metrics(stream), str(tmp_path / "o"), str(tmp_path / "c"))
    want = sessions.tumbling_metrics(events_df(spark, rows_in))
    assert rows(got.drop("batch_id", "run_id")) == rows(want)


def test_rollup_streams(spark, tmp_path, rows):
    rows_in = [event(f"e{i}", ["video_play", "video_complete"][i % 2], user=f"u{i % 5}", content=f"c{i % 2}", play=float(i),
                     time=str(at("2024-03-01 10:00:00") + dt.timedelta(minutes=i * 7))) for i in range(60)]
    src = str(tmp_path / "src")
    for part in range(3):
        put(src, f"{part}.txt", [as_json(r) for r in rows_in[part * 20:part * 20 + 20]])
    put(src, "end.txt", [as_json(event("end", user="z", content="zz", time="2024-03-04 20:00:00"))])
    batch = events_df(spark, rows_in)
    for grain, make, exact in (("content_hourly", jobs.stream_content_hourly, rollups.content_hourly),
                               ("platform_daily", jobs.stream_platform_daily, rollups.platform_daily)):
        stream = jobs.typed(source(spark, src)).withWatermark("event_time", "30 seconds")
        state = collect_stream(make(stream), str(tmp_path / f"o{grain}"), str(tmp_path / f"c{grain}")).drop("batch_id", "run_id")
        assert rows(rollups.rollup_finish(state, grain)) == rows(exact(batch))
        # partial states per batch, merged on read
        path = str(tmp_path / f"p{grain}")
        stream = jobs.typed(source(spark, src)).where("event_id <> 'end'")
        finish(stream.writeStream.foreachBatch(sinks.rollup_sink(grain, path)).option("checkpointLocation", path + "-c").trigger(**NOW).start())
        assert rows(rollups.rollup_finish(sinks.read_rollup(spark, grain, path), grain)) == rows(exact(batch))


def test_sessions_split_and_merge(spark, tmp_path, rows):
    """A session that pauses longer than the timeout gives two segments and one merged row."""
    rows_in = [
        event("a", play=10.0, pos=10.0), event("b", play=5.0, pos=20.0, time="2024-03-01 10:01:00"),
        event("c", "video_seek", pos=700.0, time="2024-03-01 11:00:00"), event("d", play=7.0, pos=720.0, time="2024-03-01 11:01:00")]
    src = str(tmp_path / "src")
    put(src, "1.txt", [as_json(r) for r in rows_in[:2]])
    put(src, "2.txt", [as_json(r) for r in rows_in[2:]])
    put(src, "3.txt", [as_json(event("z", user="z", session="z", time="2024-03-01 15:00:00"))])
    stream = jobs.typed(source(spark, src)).withWatermark("event_time", "30 seconds")
    segments = collect_stream(jobs.stream_sessions(stream, content_df(spark), "10 minutes"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert segments.count() == 2
    want = sessions.play_sessions(events_df(spark, rows_in), content_df(spark))
    assert rows(jobs.merge_segments(segments)) == rows(want)


def test_archive_and_reconcile(spark, tmp_path, rows):
    src, lake = str(tmp_path / "src"), str(tmp_path / "lake")
    day1 = [event("a", play=60.0), event("b", user="u2", play=30.0, time="2024-03-01 11:00:00")]
    put(src, "1.txt", [as_json(r) for r in day1 + [event("x", play=5.0, time="2024-02-29 08:00:00")]])
    def archive():
        stream = source(spark, src).withColumn("topic", F.lit("ott.playback.events.v1")).drop("_corrupt_record")
        finish(jobs.write_lake_stream(stream, lake, str(tmp_path / "ck"), **NOW))
    archive()
    assert rows(read_lake(spark, lake, "2024-03-01", "playback"), "event_id", "hour") == [("a", "10"), ("b", "11")]
    models = {"platform_daily": rollups.platform_daily}
    build = lambda days: jobs.reconcile(spark, lake, days, models, str(tmp_path / "out"), AS_OF)
    build(["2024-02-29", "2024-03-01"])
    # an event of the first day arrives late
    put(src, "2.txt", [as_json(event("late", user="u9", play=10.0, time="2024-02-29 09:00:00"))])
    archive()
    build(["2024-02-29"])
    got = spark.read.parquet(str(tmp_path / "out/platform_daily")).select(F.col("metric_date").cast("string"), "total_events")
    assert rows(got) == [("2024-02-29", 2), ("2024-03-01", 2)]


def test_late_flag_across_batches(spark, tmp_path, rows):
    def batch(items):
        df = events_df(spark, [event(i, time=t) for i, t, _, _ in items])
        extra = spark.createDataFrame([(i, n, p) for i, _, n, p in items], "event_id string, n bigint, p int")
        return df.join(extra, "event_id")

    sink = jobs.late_flag_sink(str(tmp_path), 30.0, "n", ["p"], lambda d, b: sinks.write_batch(d, b, f"{tmp_path}/o"))
    first = batch([("a", "2024-03-01 10:10:00", 1, 0), ("b", "2024-03-01 10:00:00", 1, 1)])
    sink(first, 0)
    sink(first, 0)
    sink(batch([("c", "2024-03-01 10:09:30", 2, 0), ("d", "2024-03-01 10:09:29", 3, 0), ("e", "2024-03-01 10:00:00", 2, 1)]), 1)
    assert rows(spark.read.parquet(f"{tmp_path}/o"), "event_id", "is_late") == [
        ("a", False), ("b", False), ("c", False), ("d", True), ("e", False)]


def test_upsert_sink_keeps_newest(spark, tmp_path, rows):
    sink = sinks.upsert_sink(str(tmp_path / "t"), ["k"], ["p"])
    make = lambda data: spark.createDataFrame(data, "k int, v int, p string")
    sink(make([(1, 1, "a"), (2, 1, "a"), (3, 1, "b")]), 0)
    sink(make([(2, 2, "a"), (4, 2, "a")]), 1)
    sink(make([(2, 2, "a"), (4, 2, "a")]), 1)
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "v") == [(1, 1), (2, 2), (3, 1), (4, 2)]


def test_session_segments_upserted(spark, tmp_path, rows):
    """Segments of a stateful stream kept by key, in two tables at once and after a repeated batch."""
    src = str(tmp_path / "src")
    put(src, "1.txt", [as_json(event("a", play=10.0)), as_json(event("b", user="u2", session="s2", play=5.0, time="2024-03-01 10:01:00"))])
    put(src, "2.txt", [as_json(event("z", user="z", session="z", time="2024-03-01 15:00:00"))])
    stream = jobs.typed(source(spark, src)).withColumn("user_id", F.concat(F.lit("x"), "user_id")).withWatermark("event_time", "30 seconds")
    segments = jobs.stream_sessions(stream, content_df(spark), "10 minutes").withColumn("day", F.to_date("session_start"))
    keep = sinks.upsert_sink(str(tmp_path / "t"), ["user_id", "session_id", "segment_start"], ["day"])
    two = sinks.foreach_batch_sink({"all": lambda d: d, "users": lambda d: d.select("user_id")}, str(tmp_path / "two"))

    def sink(batch, batch_id):
        keep(batch, batch_id)
        keep(batch, batch_id)
        two(batch, batch_id)

    finish(segments.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "c")).trigger(**NOW).start())
    done = jobs.merge_segments(spark.read.parquet(str(tmp_path / "t")))
    assert rows(done, "user_id", "watch_seconds") == [("xu1", 10.0), ("xu2", 5.0)]
    assert rows(sinks.read_batches(spark, str(tmp_path / "two/users"))) == [("xu1",), ("xu2",)]


def test_change_feed_stream(spark, tmp_path, rows):
    from marquee.sources.upsert import read_changed

    path = str(tmp_path / "t")
    sink = sinks.changes_sink(path, ["k"], ["v"])
    make = lambda data: spark.createDataFrame(data, "k int, name string, v bigint, op string")
    first = make([(1, "a", 1, "c"), (2, "b", 2, "c"), (1, "a2", 5, "u")])
    sink(first, 0)
    sink(make([(2, None, 6, "d"), (3, "c", 7, "c")]), 1)
    sink(first, 2)  # old changes again: the deleted key stays deleted
    assert rows(read_changed(spark, path)) == [(1, "a2", 5), (3, "c", 7)]


def test_trigger_and_timeout(spark, tmp_path):
    assert jobs.trigger() == {"processingTime": "2 seconds"}
    assert jobs.trigger(available_now=True) == {"availableNow": True}
    put(str(tmp_path / "s"), "1.txt", [as_json(event("a"))])
    endless = source(spark, str(tmp_path / "s")).writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(**jobs.trigger("1 second")).start()
    assert jobs.run_until([endless], 3) is False
    assert not endless.isActive


def test_batch_equals_stream_decode(spark, rows):
    lines = spark.createDataFrame([(as_json(event("a")),), ("nope",), ("[1]",), ("",)], "value string")
    got = decode_json(lines, "playback")
    assert rows(got.where("_corrupt_record is not null"), "_corrupt_record") == [("",), ("[1]",), ("nope",)]
    assert stg_playback_events(jobs.typed(got), AS_OF).count() == 1
