"""Hand-made events."""

import datetime as dt
import json

AS_OF = "2024-03-01 12:00:00"
EVENT_DDL = (
    "event_id string, event_type string, schema_version string, user_id string, session_id string, device_id string,"
    " device_type string, app_version string, content_id string, position_seconds double, playback_seconds double,"
    " event_time timestamp, ingestion_time timestamp"
)


def at(text):
    return dt.datetime.fromisoformat(text)


def event(event_id, kind="video_play", user="u1", session="s1", content="c1", pos=0.0, play=0.0, time="2024-03-01 10:00:00",
          arrived=None, device="web", version="1.0.0"):
    return (event_id, kind, "1.0.0", user, session, "d1", device, version, content, pos, play, at(time), at(arrived or time))


def as_json(row, **extra):
    names = [p.split()[0] for p in EVENT_DDL.split(", ")]
    doc = {n: (v.isoformat(sep=" ") if isinstance(v, dt.datetime) else v) for n, v in zip(names, row)}
    doc.update(extra)
    return json.dumps(doc)


def events_df(spark, rows):
    return spark.createDataFrame(rows, EVENT_DDL)


def content_df(spark, rows=(("c1", "One", 7200), ("c2", "Two", 3600))):
    docs = [(c, t, ["Drama"], "en", 2020, "Dir", d, "U/A 13+") for c, t, d in rows]
    return spark.createDataFrame(
        docs, "content_id string, title string, genres array<string>, language string, release_year int, director string,"
              " duration_seconds int, maturity_rating string")
