"""Blending of candidate sets and home shelves for all users at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.functions.scalars import round_half_up
from marquee.operators.rules import co_watched
from marquee.operators.staging import top_k, union_all

# Strategy labels, shelf names and defaults.
LIFT_ONLY = "MARKET_BASKET_LIFT"
SEMANTIC_ONLY = "PGVECTOR_SEMANTIC"
LIFT_AND_SEMANTIC = "HYBRID_CO_WATCH_SEMANTIC"
CF_ONLY = "COLLABORATIVE_SVD"
CO_WATCH_ONLY = "CO_WATCH_ASSOCIATION"
CF_AND_CO_WATCH = "HYBRID_ENSEMBLE"
SHELVES = ("because_you_watched", "collaborative_picks", "hybrid_discoveries")
FALLBACK_ITEM = "cnt_mov_0001"
DEFAULTS = {"release_year": 2024, "duration_seconds": 5400, "maturity_rating": "PG-13"}
KNOWN_THEME = "Award winning compelling thriller and drama with high completion rate"
NEW_THEME = "Top trending movies and series across all genres"


def merge_candidates(left: DataFrame, right: DataFrame, keys: list[str], w_left: float, w_right: float,
                     labels: tuple[str, str, str], step_round: bool = False) -> DataFrame:
    """Full outer merge of two scored sets (keys, ``score``) with weights and a label by presence.

    ``step_round`` rounds each side before adding instead of the sum. Other
    columns of either side are carried along; their names must differ.
    """
    part = (lambda c, w: round_half_up(c * w, 4)) if step_round else (lambda c, w: c * w)
    a = left.withColumn("_a", part(F.col("score"), w_left)).drop("score")
    b = right.withColumn("_b", part(F.col("score"), w_right)).drop("score")
    carried = [c for c in a.columns + b.columns if c not in (*keys, "_a", "_b")]
    total = F.coalesce("_a", F.lit(0.0)) + F.coalesce("_b", F.lit(0.0))
    label = (
        F.when(F.col("_b").isNull(), F.lit(labels[0]))
        .when(F.col("_a").isNull(), F.lit(labels[1]))
        .otherwise(F.lit(labels[2]))
    )
    return a.join(b, keys, "full").select(
        *keys, *carried, round_half_up(total, 4).alias("score"), label.alias("strategy"))


def item_hybrid(items: DataFrame, rules: DataFrame, sims: DataFrame, content: DataFrame, k: int = 8,
                w_lift: float = 0.6, w_sim: float = 0.4) -> DataFrame:
    """Items next to each item: co-watch lift blended with text similarity.

    sims: item_id, content_id, similarity_score — hits of each item's query.
    Several hits of one title count once, with the best score.
    """
    keys = ["item_id", "content_id"]
    other = F.col("content_id") != F.col("item_id")
    watched = co_watched(rules, items, 2 * k).where(other).groupBy(*keys).agg(
        F.max("lift").alias("lift"), F.max("confidence").alias("confidence"))
    similar = sims.where(other).groupBy(*keys).agg(F.max("similarity_score").alias("semantic_score"))
    merged = merge_candidates(
        watched.withColumn("score", F.least(F.col("lift") / 10.0, F.lit(1.0))),
        similar.withColumn("score", F.col("semantic_score")),
        keys, w_lift, w_sim, (LIFT_ONLY, SEMANTIC_ONLY, LIFT_AND_SEMANTIC),
    )
    best = top_k(merged, ["item_id"], [F.col("score").desc(), F.col("content_id")], k)
    info = content.select("content_id", "title", "release_year")
    return (
        best.join(info, "content_id", "left")
        .select("item_id", "content_id", "title", "release_year", F.coalesce("lift", F.lit(1.0)).alias("lift"),
                F.coalesce("confidence", F.lit(0.0)).alias("confidence"),
                F.coalesce("semantic_score", F.lit(0.0)).alias("semantic_score"), "score", "strategy", "rank")
    )


def recent_watches(events: DataFrame, n: int = 2, distinct: bool = False) -> DataFrame:
    """Newest watched titles per user; repeats stay unless ``distinct``."""
    rows = events.select("user_id", "content_id", "event_time", "event_id")
    if distinct:
        rows = rows.groupBy("user_id", "content_id").agg(
            F.max("event_time").alias("event_time"), F.max("event_id").alias("event_id"))
    return top_k(rows, ["user_id"], [F.col("event_time").desc(), F.col("event_id").desc()], n)


def user_top(scores: DataFrame, k: int = 10) -> DataFrame:
    """Stored scores of each user in rank order."""
    return scores.where(F.col("rank") <= k).select("user_id", "content_id", "cf_score", "rank")


def personal_shelves(users: DataFrame, recent: DataFrame, cf: DataFrame, item_recs: DataFrame, content: DataFrame,
                     k: int = 10, fallback_item: str = FALLBACK_ITEM) -> DataFrame:
    """Three shelves per user: next to the last watch, collaborative picks, and both blended."""
    last = recent.where(F.col("rank") == 1).select("user_id", F.col("content_id").alias("item_id"))
    anchors = users.select("user_id").distinct().join(last, "user_id", "left").select(
        "user_id", F.coalesce("item_id", F.lit(fallback_item)).alias("item_id"))
    near = anchors.join(item_recs.where(F.col("rank") <= k), "item_id").select(
        "user_id", "content_id", "score", F.lit(CO_WATCH_ONLY).alias("strategy"), "rank")
    picks = cf.where(F.col("rank") <= k).join(users.select("user_id").distinct(), "user_id", "left_semi").select(
        "user_id", "content_id", F.col("cf_score").alias("score"), F.lit(CF_ONLY).alias("strategy"), "rank")
    plain = ["user_id", "content_id", "score"]
    blend = merge_candidates(picks.select(plain), near.select(plain), plain[:2], 0.5, 0.5,
                             (CF_ONLY, CO_WATCH_ONLY, CF_AND_CO_WATCH), step_round=True)
    blend = top_k(blend, ["user_id"], [F.col("score").desc(), F.col("content_id")], k)
    shelves = union_all([
        df.select(F.lit(name).alias("shelf"), "user_id", "content_id", "score", "strategy", "rank")
        for name, df in zip(SHELVES, (near, picks, blend))
    ])
    info = content.select("content_id", "title", *DEFAULTS)
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in DEFAULTS.items()}
    return shelves.join(info, "content_id", "left").withColumns(filled).withColumn("title", F.coalesce("title", F.lit("")))


def themed_recommendations(users: DataFrame, features: DataFrame, theme_hits: DataFrame,
                           known_theme: str = KNOWN_THEME, new_theme: str = NEW_THEME, k: int = 6) -> DataFrame:
    """The first ``k`` hits of the theme that fits each user's profile, with a reason.

    theme_hits: theme, content_id, genre, similarity_score, rank.
    """
    # at most k hits of each of two themes, so sending them everywhere is safe
    wanted = F.col("theme").isin(known_theme, new_theme) & (F.col("rank") <= k)
    hits = F.broadcast(theme_hits.where(wanted))
    profile = features.select("user_id", F.col("genre_watch_minutes_30d").alias("_m"), F.col("content_completion_rate").alias("_c"))
    known = F.col("_m").isNotNull()
    base = users.select("user_id").join(profile, "user_id", "left").select(
        "user_id", F.when(known, known_theme).otherwise(new_theme).alias("theme"),
        F.coalesce("_m", F.lit(0.0)).alias("watch_minutes_30d"), F.coalesce("_c", F.lit(0.0)).alias("completion_rate"))
    share = F.floor(F.col("similarity_score") * 100.0 + 0.5).cast("bigint")
    # Fixed value: the sentence shown with a recommendation.
    reason = F.concat(
        F.lit("Recommended based on your "), F.col("watch_minutes_30d").cast("string"), F.lit("m watch history in "),
        F.col("genre"), F.lit(" with "), share.cast("string"), F.lit("% vector match."))
    return base.join(hits, "theme").select(
        "user_id", "theme", "watch_minutes_30d", "completion_rate", "content_id", "similarity_score", "rank",
        reason.alias("explain_reason"))
