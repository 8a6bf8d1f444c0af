"""Co-watch association rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from marquee.functions.scalars import is_missing, round_half_up
from marquee.operators.staging import top_k
from marquee.session import cut_lineage


def baskets(events: DataFrame, user: str = "user_id", item: str = "content_id") -> DataFrame:
    """Distinct (user, title) pairs of users with at least two titles, long form."""
    pairs = events.select(F.col(user).alias("user_id"), F.col(item).alias("content_id"))
    pairs = pairs.where(F.col("user_id").isNotNull() & ~is_missing(F.col("content_id"))).distinct()
    size = F.count(F.lit(1)).over(Window.partitionBy("user_id"))
    return pairs.withColumn("_n", size).where("_n >= 2").drop("_n")


def association_rules(pairs: DataFrame, min_support: float = 0.005, min_lift: float = 1.0) -> DataFrame:
    """Rules a -> b in both directions with support, confidence and lift.

    A pair is never more frequent than its rarer item, so items below the
    support are dropped first without loss. What is left of a basket is bounded
    (frequent items number at most mean basket size / min_support); its pairs
    are formed and counted inside the map task, and only counts are shuffled.
    """
    pairs = cut_lineage(pairs)  # read by three counts below
    n = F.lit(float(pairs.select("user_id").distinct().count()))
    need = F.lit(min_support) * n
    counts = pairs.groupBy("content_id").agg(F.count(F.lit(1)).alias("item_n")).where(F.col("item_n") >= need)
    # frequent items are few: number them, so pairs are two ints while counting
    numbered = counts.withColumn("code", F.row_number().over(Window.orderBy(F.col("item_n").desc(), "content_id")))
    kept = pairs.join(numbered.select("content_id", "code"), "content_id")
    lists = kept.groupBy("user_id").agg(F.sort_array(F.collect_list("code")).alias("items"))
    firsts = lists.select("items", F.posexplode("items").alias("i", "x"))
    rest = F.slice(F.col("items"), F.col("i") + 2, F.size("items"))
    both = firsts.select("x", F.explode(rest).alias("y"))
    joint = both.groupBy("x", "y").agg(F.count(F.lit(1)).alias("co")).where(F.col("co") >= need)
    named = lambda code, item, n: numbered.select(F.col("code").alias(code), F.col("content_id").alias(item), F.col("item_n").alias(n))
    strong = joint.join(named("x", "p", "np"), "x").join(named("y", "q", "nq"), "y")
    # the same order of items as in their names, so lift is one number for both directions
    swap = F.col("p") > F.col("q")
    either = lambda yes, no: F.when(swap, F.col(yes)).otherwise(F.col(no))
    strong = strong.select("co", either("q", "p").alias("a"), either("p", "q").alias("b"), either("nq", "np").alias("na"), either("np", "nq").alias("nb"))
    lift = (F.col("co") / n) / ((F.col("na") / n) * (F.col("nb") / n))
    strong = strong.withColumns({"lift": lift, "support": F.col("co") / n}).where(F.col("lift") >= min_lift)
    # each unordered pair gives two rules; confidence depends on the antecedent
    directions = F.array(
        F.struct(F.col("a").alias("x"), F.col("b").alias("y"), F.col("na").alias("nx")),
        F.struct(F.col("b").alias("x"), F.col("a").alias("y"), F.col("nb").alias("nx")),
    )
    rows = strong.select("co", "lift", "support", F.explode(directions).alias("d"))
    confidence = F.col("support") / (F.col("d.nx") / n)
    return rows.select(
        F.col("d.x").alias("antecedent_content_id"), F.col("d.y").alias("consequent_content_id"),
        round_half_up(F.col("support"), 5).alias("support"), round_half_up(confidence, 4).alias("confidence"),
        round_half_up(F.col("lift"), 3).alias("lift"), F.col("co").alias("co_watch_count"),
    )


def co_watched(rules: DataFrame, items: DataFrame, k: int = 6) -> DataFrame:
    """Best consequents of every item; catalog-wide best rules for items without any.

    Rules come in both directions, so an item without rules is no consequent
    either and the fallback needs no check against itself.
    """
    wanted = items.select(F.col("content_id").alias("item_id")).distinct()
    own = rules.withColumnRenamed("antecedent_content_id", "item_id").join(wanted, "item_id", "left_semi")
    best = top_k(own, ["item_id"], [F.col("lift").desc(), F.col("confidence").desc(), F.col("consequent_content_id")], k)
    bare = wanted.join(rules.select(F.col("antecedent_content_id").alias("item_id")), "item_id", "left_anti")
    overall = rules.orderBy(
        F.col("lift").desc(), F.col("co_watch_count").desc(), "antecedent_content_id", "consequent_content_id"
    ).limit(k)
    # k rows folded into one, then unfolded next to each item without rules
    order = [-F.col("lift"), -F.col("co_watch_count"), F.col("antecedent_content_id"), F.col("consequent_content_id")]
    fields = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], "support", "confidence", "lift", "co_watch_count",
                      "consequent_content_id")
    folded = overall.agg(F.sort_array(F.collect_list(fields)).alias("r"))
    filled = bare.select("item_id", F.posexplode(folded.scalar()).alias("p", "r")).select(
        "item_id", "r.consequent_content_id", "r.support", "r.confidence", "r.lift", "r.co_watch_count",
        (F.col("p") + 1).cast("bigint").alias("rank"), F.lit(True).alias("is_fallback"),
    )
    columns = ["item_id", "consequent_content_id", "support", "confidence", "lift", "co_watch_count", "rank"]
    return best.select(*columns, F.lit(False).alias("is_fallback")).unionByName(filled).withColumnRenamed(
        "consequent_content_id", "content_id")
