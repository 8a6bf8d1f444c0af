"""The daily batch: gate, staging, models, checks, features, row counts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators.quality import check_marts, validate_partition
from marquee.operators.sessions import watch_sessions
from marquee.operators.staging import stg_content, stg_playback_events, stg_search_events, stg_users
from marquee.plans import marts


class GateFailed(RuntimeError):
    """The day's data or marts did not pass their checks."""


def build_models(tables: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """Every model of the day as lazy DataFrames, by name.

    tables: raw_playback_events, raw_search_events, raw_recommendation_events, dim_content.
    """
    events = stg_playback_events(tables["raw_playback_events"], as_of)
    content = stg_content(tables["dim_content"])
    searches = stg_search_events(tables["raw_search_events"])
    recs = tables["raw_recommendation_events"]
    sessions = watch_sessions(events, content).persist(StorageLevel.MEMORY_AND_DISK)
    activity = marts.daily_user_activity(sessions)
    engagement = marts.content_engagement(sessions)
    return {
        "stg_playback_events": events,
        "stg_search_events": searches,
        "stg_content": content,
        "stg_users": stg_users(events),
        "int_watch_sessions": sessions,
        "int_daily_user_activity": activity,
        "int_content_engagement": engagement,
        "int_subscription_history": marts.subscription_history(sessions),
        "mart_daily_platform_metrics": marts.daily_platform_metrics(activity),
        "mart_content_performance": marts.content_performance(engagement, content),
        "mart_user_retention": marts.weekly_retention(activity),
        "mart_recommendation_performance": marts.recommendation_performance(recs),
        "mart_churn_features": marts.churn_features(sessions, searches, recs, as_of),
    }


def run_daily(spark: SparkSession, tables: dict[str, DataFrame], ds: str, as_of, root: str | None = None) -> DataFrame:
    """Run the day and return the row count of every model.

    Stops with :class:`GateFailed` when the raw data or the marts fail. With
    ``root`` each mart is written as Parquet and the counts read the files.
    """
    gate = validate_partition(tables["raw_playback_events"], ds).first()
    if not gate["passed"]:
        raise GateFailed(f"{ds}: {gate['total_rows']} rows, {gate['null_users']} without user")
    models = build_models(tables, as_of)
    try:
        checks = check_marts(models["mart_churn_features"], models["mart_daily_platform_metrics"])
        failed = [r["check"] for r in checks.where(F.col("status") != "PASS").collect()]
        if failed:
            raise GateFailed(f"{ds}: {', '.join(sorted(failed))}")
        features = models["mart_churn_features"]
        store = tables.get("ml_user_features")
        if store is None:
            store = features.withColumn("features_updated_at", F.lit(None).cast("timestamp")).limit(0)
        models["ml_user_features"] = marts.refresh_features(store, features, as_of)
        if root is not None:
            for name, df in models.items():
                if name.startswith(("mart_", "ml_")):
                    df.write.mode("overwrite").parquet(f"{root}/{name}")
                    models[name] = spark.read.parquet(f"{root}/{name}")
        return marts.platform_stats(models)
    finally:
        if root is not None:
            models["int_watch_sessions"].unpersist()
