"""Intermediate models and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.masking import mask_email, mask_phone
from marquee.functions.scalars import (
    UNITS_PER_SECOND, as_time, exact_avg, exact_sum, pct, round_half_up, shift, to_day, to_monday, to_units, week_diff,
)
from marquee.operators.sessions import DEFAULT_DURATION, count_type
from marquee.operators.staging import dense_rank_by_range, latest_by_key, top_k, union_all


def daily_user_activity(sessions: DataFrame) -> DataFrame:
    day = to_day(F.col("session_start")).alias("activity_date")
    return sessions.groupBy("user_id", day).agg(
        F.count("session_id").alias("sessions_count"),
        exact_sum(F.col("total_watch_seconds")).alias("daily_watch_seconds"),
        exact_avg(F.col("completion_percentage")).alias("avg_completion_pct"),
    ).select(
        "user_id", "activity_date", "sessions_count", "daily_watch_seconds",
        round_half_up(F.col("daily_watch_seconds") / 3600.0, 2).alias("daily_watch_hours"), "avg_completion_pct",
    )


def content_engagement(sessions: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per title and day, with the day's popularity rank (``ranges`` as in :func:`daily_content_rank`)."""
    day = to_day(F.col("session_start")).alias("engagement_date")
    grouped = sessions.groupBy("content_id", "content_title", day).agg(
        F.count("session_id").alias("total_sessions"),
        F.countDistinct("user_id").alias("unique_viewers"),
        exact_sum(F.col("total_watch_seconds")).alias("total_watch_seconds"),
        round_half_up(exact_avg(F.col("completion_percentage")), 2).alias("avg_completion_percentage"),
    )
    return daily_content_rank(grouped, ranges).withColumn(
        "total_watch_hours", round_half_up(F.col("total_watch_seconds") / 3600.0, 2)
    )


def daily_content_rank(engagement: DataFrame, ranges: int | None = None) -> DataFrame:
    """Dense rank by watch time within a day; a day holds at most one row per title.

    With ``ranges`` no task holds a whole day: for catalogs whose titles of a day outgrow one.
    """
    if ranges is not None:
        return dense_rank_by_range(engagement, "engagement_date", "total_watch_seconds", "daily_rank", ranges)
    w = Window.partitionBy("engagement_date").orderBy(F.col("total_watch_seconds").desc())
    return engagement.withColumn("daily_rank", F.dense_rank().over(w).cast("bigint"))


def content_performance(engagement: DataFrame, content: DataFrame, range_days: int | None = None) -> DataFrame:
    """Engagement with catalog data and rolling hours.

    The rolling sum covers the last seven rows of a title; ``range_days``
    makes it that many calendar days instead.
    """
    w = Window.partitionBy("content_id")
    if range_days is None:
        w = w.orderBy("engagement_date", "content_title").rowsBetween(-6, 0)
    else:
        w = w.orderBy(F.datediff("engagement_date", F.lit("1970-01-01"))).rangeBetween(1 - range_days, 0)
    info = content.select("content_id", "genres", "language", "release_year", "director")
    # the title joins after the window: it adds columns, not rows
    hours = F.sum(to_units(F.col("total_watch_hours"))).over(w) / F.lit(UNITS_PER_SECOND)
    rolled = engagement.withColumn("rolling_7d_watch_hours", hours)
    return rolled.join(info, "content_id", "left").select(
        "content_id", "content_title", "engagement_date", "genres", "language", "release_year", "director",
        "total_sessions", "unique_viewers", "total_watch_hours", "avg_completion_percentage", "daily_rank",
        "rolling_7d_watch_hours",
    )


def subscription_history(sessions: DataFrame, subs: DataFrame | None = None) -> DataFrame:
    """First start and last end per user; real plan and status when given.

    ``subs`` has one current row per user: user_id, subscription_tier, current_status.
    """
    spans = sessions.groupBy("user_id").agg(
        F.min("session_start").alias("subscription_started_at"), F.max("session_end").alias("last_active_at")
    )
    tier, status = F.lit("premium"), F.lit("active")
    if subs is not None:
        current = subs.select("user_id", F.col("subscription_tier").alias("_tier"), F.col("current_status").alias("_status"))
        spans = spans.join(current, "user_id", "left")
        tier, status = F.coalesce("_tier", tier), F.coalesce("_status", status)
    return spans.select(
        "user_id", tier.alias("subscription_tier"), status.alias("current_status"),
        "subscription_started_at", "last_active_at",
    )


def churn_features(sessions: DataFrame, searches: DataFrame, recs: DataFrame, as_of) -> DataFrame:
    """Per user: watch minutes, completion, active days, searches and click rate.

    Sessions are first summed per user and day: the distinct-day count then
    needs no row expansion and a very active user is combined map-side.
    """
    week, month = shift(as_time(as_of), days=-7), shift(as_time(as_of), days=-30)
    start, seconds = F.col("session_start"), F.col("total_watch_seconds")
    units = to_units(seconds)
    daily = sessions.groupBy("user_id", to_day(start).alias("d")).agg(
        F.sum(F.when(start >= week, units).otherwise(F.lit(0))).alias("u7"),
        F.sum(F.when(start >= month, units).otherwise(F.lit(0))).alias("u30"),
        F.sum(units).alias("u"),
        F.sum(to_units(F.col("completion_percentage"))).alias("c"),
        F.count(F.lit(1)).alias("n"),
        F.max(start >= month).alias("recent"),
    )
    minutes = lambda c: round_half_up(c / F.lit(UNITS_PER_SECOND) / 60.0, 2)
    watch = daily.groupBy("user_id").agg(
        minutes(F.sum("u7")).alias("genre_watch_minutes_7d"),
        minutes(F.sum("u30")).alias("genre_watch_minutes_30d"),
        round_half_up(F.sum("c") / F.lit(UNITS_PER_SECOND) / F.sum("n"), 2).alias("content_completion_rate"),
        round_half_up(F.sum("u") / F.lit(UNITS_PER_SECOND) / F.sum("n") / 60.0, 2).alias("average_session_length"),
        F.count_if("recent").alias("active_days_30d"),
    )
    found = searches.groupBy("user_id").agg(F.count_if(F.col("event_time") >= week).alias("search_count_7d"))
    shown = recs.groupBy("user_id").agg(
        pct(F.count_if(F.col("event_type") == "recommendation_click"), F.count(F.lit(1))).alias("recommendation_ctr")
    )
    return watch.join(found, "user_id", "left").join(shown, "user_id", "left").select(
        "user_id", "genre_watch_minutes_7d", "genre_watch_minutes_30d", "content_completion_rate",
        F.coalesce("search_count_7d", F.lit(0)).alias("search_count_7d"), "active_days_30d",
        F.coalesce("recommendation_ctr", F.lit(0.0)).alias("recommendation_ctr"), "average_session_length",
    )


def daily_platform_metrics(activity: DataFrame) -> DataFrame:
    """Per day; activity has one row per user and day, so users are rows."""
    return activity.groupBy(F.col("activity_date").alias("metric_date")).agg(
        F.count("user_id").alias("daily_active_users"),
        F.sum("sessions_count").alias("total_watch_sessions"),
        round_half_up(exact_sum(F.col("daily_watch_hours")), 2).alias("total_watch_hours"),
        round_half_up(exact_avg(F.col("daily_watch_seconds")) / 60.0, 2).alias("avg_daily_watch_minutes"),
        round_half_up(exact_avg(F.col("avg_completion_pct"), 1e7), 2).alias("avg_platform_completion_pct"),
    )


def recommendation_performance(recs: DataFrame) -> DataFrame:
    clicks = F.count_if(F.col("event_type") == "recommendation_click")
    shown = F.count(F.lit(1))
    return recs.groupBy(to_day(F.col("event_time")).alias("event_date"), "model_version").agg(
        shown.alias("total_recommendations_shown"), clicks.alias("total_clicks"),
        pct(clicks, shown).alias("recommendation_ctr"),
    )


def weekly_retention(activity: DataFrame) -> DataFrame:
    """Users of each weekly cohort active in each later week.

    After the user×week step every pair is unique, so counting rows is counting
    users, and a user's window spans their weeks only.
    """
    weekly = activity.groupBy("user_id", to_monday(F.col("activity_date")).alias("activity_week")).agg(F.lit(1).alias("_"))
    first = F.min("activity_week").over(Window.partitionBy("user_id"))
    return weekly.select("activity_week", first.alias("cohort_week")).groupBy("cohort_week", "activity_week").agg(
        F.count(F.lit(1)).alias("active_users_in_cohort")
    ).select(
        "cohort_week", "activity_week", week_diff(F.col("cohort_week"), F.col("activity_week")).alias("week_number"),
        "active_users_in_cohort",
    )


def day_n_retention(activity: DataFrame, days: tuple[int, ...] = (1, 7, 14, 30)) -> DataFrame:
    """Cohort size and users back exactly n days after their first day."""
    first = F.min("activity_date").over(Window.partitionBy("user_id"))
    ages = activity.select(first.alias("cohort_date"), F.datediff("activity_date", first).alias("age"))
    size = F.count_if(F.col("age") == 0)
    counts = [F.count_if(F.col("age") == n).alias(f"day_{n}_retained") for n in days]
    grouped = ages.groupBy("cohort_date").agg(size.alias("total_cohort_users"), *counts)
    rates = [pct(F.col(f"day_{n}_retained"), F.col("total_cohort_users")).alias(f"day_{n}_retention_rate") for n in days]
    return grouped.select("*", *rates)


def gold_content_daily(silver: DataFrame, content: DataFrame, as_of) -> DataFrame:
    """Daily plays, completions, viewers, hours and mean progress per title."""
    grouped = silver.groupBy(to_day(F.col("event_time")).alias("metric_date"), "content_id").agg(
        count_type("video_play").alias("total_plays"),
        count_type("video_complete").alias("total_completions"),
        F.countDistinct("user_id").alias("unique_viewers"),
        round_half_up(exact_sum(F.col("playback_seconds")) / 3600.0, 2).alias("total_watch_hours"),
        round_half_up(exact_avg(F.col("completion_percentage")), 2).alias("avg_completion_rate"),
    )
    info = content.select("content_id", "title", "genres", "release_year")
    return grouped.join(info, "content_id", "left").select(
        "metric_date", "content_id", "title", "genres", "release_year", "total_plays", "total_completions",
        "unique_viewers", "total_watch_hours", "avg_completion_rate", as_time(as_of).alias("created_at"),
    )


def event_distribution(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("event_count"),
        round_half_up(exact_avg(F.col("position_seconds")), 2).alias("avg_position_sec"),
        round_half_up(exact_avg(F.col("playback_seconds")), 2).alias("avg_played_sec"),
    ).orderBy(F.col("event_count").desc(), "event_type")


def recent_play_stats(events: DataFrame, as_of, days: int = 14, event_type: str = "video_play") -> DataFrame:
    """Count and mean play length of one event type over the last days."""
    recent = events.where((F.col("event_type") == event_type) & (F.col("event_time") >= shift(as_time(as_of), days=-days)))
    return recent.agg(
        F.count(F.lit(1)).alias("event_cnt"), round_half_up(exact_avg(F.col("playback_seconds")), 2).alias("avg_played")
    )


def device_breakdown(events: DataFrame) -> DataFrame:
    return events.groupBy("device_type").agg(
        F.count(F.lit(1)).alias("event_cnt"),
        round_half_up(exact_sum(F.col("playback_seconds")), 2).alias("total_watch"),
    ).orderBy(F.col("total_watch").desc(), "device_type")


def top_active_users(events: DataFrame, n: int = 10) -> DataFrame:
    plays = events.where(F.col("event_type") == "video_play")
    return plays.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("play_count"), exact_sum(F.col("playback_seconds")).alias("total_seconds")
    ).orderBy(F.col("total_seconds").desc(), "user_id").limit(n)


def latest_events(events: DataFrame, n: int = 5) -> DataFrame:
    return events.select(
        "event_id", "event_type", "user_id", "content_id", "device_type", "position_seconds", "event_time"
    ).orderBy(F.col("event_time").desc(), "event_id").limit(n)


def platform_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each named table."""
    return union_all([df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
                      for name, df in tables.items()])


def refresh_features(store: DataFrame, features: DataFrame, as_of) -> DataFrame:
    """Add features stamped with the update time; the newest row of a user wins."""
    stamped = features.withColumn("features_updated_at", as_time(as_of))
    return latest_by_key(store.unionByName(stamped), ["user_id"], ["features_updated_at"])


def watch_progress(events: DataFrame, content: DataFrame) -> DataFrame:
    """Last position per user and title with progress to one digit."""
    last = F.max_by(F.struct("position_seconds", "event_time"), F.struct("event_time", "event_id")).alias("last")
    grouped = events.groupBy("user_id", "content_id").agg(last)
    info = content.select("content_id", F.col("duration_seconds").cast("double").alias("_d"))
    length = F.coalesce("_d", F.lit(float(DEFAULT_DURATION)))
    share = round_half_up(F.col("last.position_seconds") / F.greatest(length, F.lit(1.0)) * 100.0, 1)
    return grouped.join(info, "content_id", "left").select(
        "user_id", "content_id", F.col("last.position_seconds").alias("position_seconds"),
        length.alias("duration_seconds"), share.alias("completion_percentage"), F.col("last.event_time").alias("updated_at"),
    )


def continue_watching(progress: DataFrame, movies: DataFrame, series: DataFrame, n: int = 6) -> DataFrame:
    """Newest unfinished titles per user that the catalog knows."""
    open_ = progress.where((F.col("position_seconds") > 0) & (F.col("completion_percentage") < 95))
    newest = top_k(open_, ["user_id"], [F.col("updated_at").desc(), F.col("content_id")], n)
    return lookup_catalog(newest, movies, series).where(F.col("title").isNotNull())


def lookup_catalog(ids: DataFrame, movies: DataFrame, series: DataFrame, default_title: str | None = None) -> DataFrame:
    """Title and type of each ``content_id``: movies first, then series, then the default."""
    m = movies.select("content_id", F.col("title").alias("_m"))
    s = series.select("content_id", F.col("title").alias("_s"))
    kind = F.when(F.col("_m").isNotNull(), F.lit("movie")).when(F.col("_s").isNotNull(), F.lit("series"))
    return (
        ids.join(m, "content_id", "left").join(s, "content_id", "left")
        .withColumns({"title": F.coalesce("_m", "_s", F.lit(default_title).cast("string")), "type": kind})
        .drop("_m", "_s")
    )


def lookup_content(ids: DataFrame, content: DataFrame) -> DataFrame:
    """Catalog rows of the wanted ids."""
    return content.join(ids.select("content_id"), "content_id", "left_semi")


def catalog(movies: DataFrame, series: DataFrame, genre: str | None = None, content_type: str | None = None,
            n: int = 60) -> DataFrame:
    """First ``n`` movies, then series, by id; optional genre and type."""
    parts = []
    for order, (kind, df) in enumerate((("movie", movies), ("series", series))):
        if content_type in (None, kind):
            if genre and genre != "All":
                df = df.where(F.array_contains("genres", genre))
            parts.append(df.withColumns({"type": F.lit(kind), "_o": F.lit(order)}))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1], allowMissingColumns=True)
    return both.orderBy("_o", "content_id").limit(n).drop("_o")


def active_subscribers(users: DataFrame, subs: DataFrame, plans: DataFrame, n: int | None = None,
                       status: str = "active") -> DataFrame:
    """Subscribers of one status, newest account first, with masked contacts."""
    chosen = subs.where(F.col("status") == status).select("user_id", "plan_id", F.col("status").alias("subscription_status"))
    rows = chosen.join(plans.select("plan_id", "plan_name"), "plan_id").join(
        users.select("user_id", "email", "phone", "country_code", "created_at"), "user_id"
    )
    if n is not None:
        rows = rows.orderBy(F.col("created_at").desc(), "user_id", "plan_id").limit(n)
    return rows.select(
        "user_id", mask_email(F.col("email")).alias("email"), mask_phone(F.col("phone")).alias("phone"),
        "country_code", "subscription_status", "plan_name",
    )
