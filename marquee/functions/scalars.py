"""Time, number and text expressions.

Sums and averages of seconds run on whole ten-thousandths held in a bigint:
such sums do not depend on the order in which partitions arrive, and long
buffers keep the aggregation on the fast hash path.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

UNITS_PER_SECOND = 10_000.0


def round_half_up(x: Column, digits: int = 0) -> Column:
    """Round by adding half and flooring, the same in every engine."""
    scale = F.lit(float(10**digits))
    return F.floor(x * scale + F.lit(0.5)) / scale


def to_units(x: Column, scale: float = UNITS_PER_SECOND) -> Column:
    """A number as whole parts of 1/scale."""
    return F.floor(x * F.lit(scale) + F.lit(0.5)).cast("bigint")


def exact_sum(x: Column, scale: float = UNITS_PER_SECOND) -> Column:
    return F.sum(to_units(x, scale)) / F.lit(scale)


def exact_avg(x: Column, scale: float = UNITS_PER_SECOND) -> Column:
    return F.sum(to_units(x, scale)) / F.lit(scale) / F.count(x)


def safe_ratio(num: Column, den: Column) -> Column:
    """num / max(den, 1)."""
    return num / F.greatest(den, F.lit(1))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return round_half_up(safe_ratio(num, den) * F.lit(100.0), digits)


def completion_pct(position: Column, duration: Column, digits: int = 2) -> Column:
    """Share of the title seen, at most 100; 0 where the length is unknown."""
    share = F.least(F.lit(100.0), round_half_up(position / duration * F.lit(100.0), digits))
    return F.when(duration > 0, share).otherwise(F.lit(0.0))


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def to_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def to_monday(day: Column) -> Column:
    return F.date_trunc("week", day).cast("date")


def to_yyyymm(ts: Column) -> Column:
    return (F.year(ts) * 100 + F.month(ts)).cast("int")


def minute_diff(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed between two times."""
    minute = lambda c: F.unix_seconds(F.date_trunc("minute", c.cast("timestamp")))
    return ((minute(end) - minute(start)) / 60).cast("bigint")


def week_diff(start_monday: Column, end_monday: Column) -> Column:
    """Whole weeks between two Mondays."""
    return (F.datediff(end_monday, start_monday) / 7).cast("bigint")


def as_time(value) -> Column:
    """A point in time given as text, datetime or Column."""
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def shift(ts: Column, **parts: float) -> Column:
    """ts plus an interval, e.g. ``shift(t, days=-7)``."""
    names = {"weeks": 2, "days": 3, "hours": 4, "mins": 5, "secs": 6}
    args = [F.lit(0)] * 7
    for name, n in parts.items():
        args[names[name]] = F.lit(n)
    return ts + F.make_interval(*args)


def parse_event_time(text: Column) -> Column:
    """ISO text with Z, offset or blank; else its first 19 characters; else null."""
    text = text.cast("string")
    return F.coalesce(
        F.try_to_timestamp(text),
        F.try_to_timestamp(F.substring(text, 1, 19), F.lit("yyyy-MM-dd HH:mm:ss")),
    )


def is_missing(c: Column) -> Column:
    """Null, empty or the all-zero UUID."""
    text = c.cast("string")
    return text.isNull() | text.isin("", "00000000-0000-0000-0000-000000000000")


# Lake categories and the topics they are replayed to.
PLAYBACK_TOPIC = "ott.playback.events.v1"
SEARCH_TOPIC = "ott.search.events.v1"
SUBSCRIPTION_TOPIC = "ott.subscription.cdc.v1"
DLQ_TOPIC = "ott.playback.dlq.v1"


def category_of(topic: Column) -> Column:
    """Lake category from a topic name."""
    return (
        F.when(topic.contains("playback"), F.lit("playback"))
        .when(topic.contains("search"), F.lit("search"))
        .otherwise(F.lit("subscriptions"))
    )


def topic_of(category: Column) -> Column:
    """Topic a lake category is replayed to."""
    return (
        F.when(category == "playback", F.lit(PLAYBACK_TOPIC))
        .when(category == "search", F.lit(SEARCH_TOPIC))
        .otherwise(F.lit(SUBSCRIPTION_TOPIC))
    )


def partition_time(event_time: Column, ingestion_time: Column, as_of) -> Column:
    """Time that files a record into the lake: event, else ingestion, else now."""
    return F.coalesce(event_time, ingestion_time, as_time(as_of))
