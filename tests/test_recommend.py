"""Rules, factorization, shelves, search and answers against brute force."""

from collections import Counter
from itertools import combinations
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import registry
from marquee.functions import vectors
from marquee.operators import factors, hybrid, rules, text, vector


def r(x, n):
    return float(np.floor(x * 10**n + 0.5) / 10**n)


def brute_rules(baskets, min_support, min_lift):
    n = len(baskets)
    single = Counter(i for b in baskets for i in b)
    pair = Counter(p for b in baskets for p in combinations(sorted(b), 2))
    out = set()
    for (a, b), c in pair.items():
        support, lift = c / n, (c / n) / ((single[a] / n) * (single[b] / n))
        if support >= min_support and lift >= min_lift:
            for x, y in ((a, b), (b, a)):
                out.add((x, y, r(support, 5), r(support / (single[x] / n), 4), r(lift, 3), c))
    return out


@pytest.mark.parametrize("support", [0.005, 0.1, 0.3])
def test_rules_equal_brute_force(spark, support):
    rng = np.random.default_rng(3)
    # one user has watched everything, one item is in every basket
    baskets = {f"u{u}": {"i0"} | {f"i{i}" for i in rng.choice(30, rng.integers(1, 12), replace=False)} for u in range(60)}
    baskets["whale"] = {f"i{i}" for i in range(30)}
    baskets["single"] = {"i5"}
    rows = [(u, i) for u, items in baskets.items() for i in items] * 2
    df = spark.createDataFrame(rows, "user_id string, content_id string")
    got = {tuple(x) for x in rules.association_rules(rules.baskets(df), support).collect()}
    assert got == brute_rules([b for b in baskets.values() if len(b) >= 2], support, 1.0)
    lifts = {(x[0], x[1]): x[4] for x in got}
    assert all(lifts[(b, a)] == v for (a, b), v in lifts.items())
    assert all(x[3] <= 1.0 for x in got)


def test_co_watched_fallback(spark, rows):
    df = spark.createDataFrame([("a", "b", .1, .5, 2.0, 3), ("b", "a", .1, .4, 2.0, 3), ("a", "c", .1, .9, 1.5, 2), ("c", "a", .1, .2, 1.5, 2)],
                               "antecedent_content_id string, consequent_content_id string, support double, confidence double, lift double, co_watch_count bigint")
    items = spark.createDataFrame([("a",), ("new",)], "content_id string")
    assert rows(rules.co_watched(df, items, 2), "item_id", "content_id", "rank", "is_fallback") == [
        ("a", "b", 1, False), ("a", "c", 2, False), ("new", "a", 2, True), ("new", "b", 1, True)]


def test_implicit_scores(spark, rows):
    df = spark.createDataFrame([("u", "a", 2700.0, 99.0), ("u", "a", 100.0, 10.0), ("u", "b", 0.0, 1800.0), ("u", "c", 9000.0, 0.0)],
                               "user_id string, content_id string, position_seconds double, playback_seconds double")
    got = dict((c, s) for _, c, s in rows(factors.implicit_scores(df)))
    assert got == pytest.approx({"a": 0.5 * np.log1p(100), "b": 0.5 * np.log1p(1801), "c": np.log1p(1)})


def matrix(spark, users=40, items=25, seed=5, density=0.4):
    rng = np.random.default_rng(seed)
    m = rng.random((users, items)) * (rng.random((users, items)) < density)
    m[0, :] = rng.random(items)  # a user who has seen everything
    m[:, 0] = rng.random(users)  # a title everyone has seen
    data = [(f"u{u:03d}", f"i{i:03d}", float(m[u, i])) for u in range(users) for i in range(items) if m[u, i]]
    return m, spark.createDataFrame(data, "user_id string, content_id string, score double")


def test_svd_equals_numpy(spark):
    m, df = matrix(spark)
    k = 6
    u, s, vt = np.linalg.svd(m, full_matrices=False)
    want = (u[:, :k] * s[:k]) @ vt[:k]
    got = factors.svd_recommend(df, k=k, top=5, iterations=12).collect()
    by_user = {}
    for row in got:
        by_user.setdefault(row["user_id"], []).append(row)
    assert "u000" not in by_user  # nothing unseen is left
    for n in range(1, 40):
        unseen = [i for i in range(25) if m[n, i] == 0]
        best = sorted(unseen, key=lambda i: -want[n, i])[:5]
        mine = sorted(by_user[f"u{n:03d}"], key=lambda x: x["rank"])
        assert [x["content_id"] for x in mine] == [f"i{i:03d}" for i in best]
        assert [x["cf_score"] for x in mine] == pytest.approx([want[n, i] for i in best], abs=2e-4)


def test_als_leaves_out_seen_titles(spark):
    m, df = matrix(spark)
    got = factors.als_recommend(df, rank=4, top=3, maxIter=3).collect()
    assert {x["user_id"] for x in got} == {f"u{n:03d}" for n in range(1, 40)}
    assert all(m[int(x["user_id"][1:]), int(x["content_id"][1:])] == 0 and 1 <= x["rank"] <= 3 for x in got)


def test_recommenders_fit_on_all_events(spark, rows):
    """A pair whose only event has a negative or no position is scored, fitted and left out as seen."""
    data = [(f"u{u}", f"i{i}", 100.0 * (u + i + 1), 60.0) for u in range(8) for i in range(6) if (u + i) % 3]
    data += [("u0", "i3", -5.0, 1200.0), ("u1", "i2", None, 900.0), ("u9", "i1", -1.0, 0.0)]
    df = spark.createDataFrame(data, "user_id string, content_id string, position_seconds double, playback_seconds double")
    scores = registry.watch_scores(SimpleNamespace(events=df)).cache()
    assert rows(scores, "user_id", "content_id", "score") == rows(factors.implicit_scores(df), "user_id", "content_id", "score")
    seen = {(u, i) for u, i, _, _ in data}
    assert {(x["user_id"], x["content_id"]) for x in scores.collect()} == seen
    every = {(u, f"i{i}") for u in [*(f"u{u}" for u in range(8)), "u9"] for i in range(6)}
    for got in (factors.svd_recommend(scores, k=2, top=6), factors.als_recommend(scores, rank=2, top=6, maxIter=2)):
        assert {(x["user_id"], x["content_id"]) for x in got.collect()} == every - seen


def points(spark, n, dim, id_name, seed, copies=0):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(n, dim))
    if copies:
        v[-copies:] = v[0]  # a crowd of equal vectors
    data = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    return v, spark.createDataFrame(data, f"{id_name} bigint, vec array<double>")


def brute_knn(a, b, k):
    a, b = a / np.linalg.norm(a, axis=1, keepdims=True), b / np.linalg.norm(b, axis=1, keepdims=True)
    s = np.floor((a @ b.T) * 1e10 + 0.5) / 1e10
    return {(q, int(c), n + 1) for q in range(len(a)) for n, c in enumerate(np.lexsort((np.arange(len(b)), -s[q]))[:k])}


@pytest.mark.parametrize("block,copies", [(32768, 0), (16, 0), (7, 60)])
def test_knn_equals_brute_force(spark, block, copies):
    a, queries = points(spark, 30, 8, "query_id", 1)
    b, chunks = points(spark, 100, 8, "chunk_id", 2, copies)
    got = vector.knn(queries, chunks, 5, block_rows=block).collect()
    assert {(x["query_id"], x["chunk_id"], x["rank"]) for x in got} == brute_knn(a, b, 5)


def test_knn_genre_and_small_sets(spark):
    _, queries = points(spark, 3, 4, "query_id", 1)
    _, chunks = points(spark, 4, 4, "chunk_id", 2)
    tagged = chunks.withColumn("genres", F.when(F.col("chunk_id") < 2, F.array(F.lit("x"))).otherwise(F.array(F.lit("y"))))
    got = vector.knn(queries, tagged, 5, genre="x").collect()
    assert {x["chunk_id"] for x in got} == {0, 1} and len(got) == 6
    assert vector.knn(queries, tagged, 5, genre="none").count() == 0


def test_list_probing_recall(spark):
    a, queries = points(spark, 40, 8, "query_id", 11)
    b, chunks = points(spark, 600, 8, "chunk_id", 12, copies=200)  # one list holds a third of all rows
    index, centres = vector.ivf_build(chunks, lists=12)
    exact = brute_knn(a, b, 10)
    pairs = {(q, c) for q, c, _ in exact}
    recall = lambda n: len(pairs & {(x["query_id"], x["chunk_id"]) for x in vector.ivf_search(queries, index, centres, 10, nprobe=n, block_rows=64).collect()}) / len(pairs)
    assert recall(12) == 1.0
    assert recall(5) > 0.6


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 3.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [x[0] for x in df.select(vectors.cosine(F.col("a"), F.col("b"))).collect()] == pytest.approx([1.0, 0.0, 0.0])


def test_shelves(spark, rows):
    users = spark.createDataFrame([("u1",), ("new",)], "user_id string")
    recent = spark.createDataFrame([("u1", "a", 1), ("u1", "b", 2)], "user_id string, content_id string, rank bigint")
    cf = spark.createDataFrame([("u1", "x", 0.8, 1), ("u1", "y", 0.2, 2)], "user_id string, content_id string, cf_score double, rank bigint")
    recs = spark.createDataFrame([("a", "x", 0.5, 1), ("a", "z", 0.4, 2), ("cnt_mov_0001", "q", 0.3, 1)], "item_id string, content_id string, score double, rank bigint")
    content = spark.createDataFrame([("x", "X", 2001, 60, "PG")], "content_id string, title string, release_year int, duration_seconds int, maturity_rating string")
    got = rows(hybrid.personal_shelves(users, recent, cf, recs, content), "user_id", "shelf", "rank", "content_id", "score", "strategy", "title", "release_year")
    assert got == sorted([
        ("u1", "because_you_watched", 1, "x", 0.5, "CO_WATCH_ASSOCIATION", "X", 2001), ("u1", "because_you_watched", 2, "z", 0.4, "CO_WATCH_ASSOCIATION", "", 2024),
        ("u1", "collaborative_picks", 1, "x", 0.8, "COLLABORATIVE_SVD", "X", 2001), ("u1", "collaborative_picks", 2, "y", 0.2, "COLLABORATIVE_SVD", "", 2024),
        ("u1", "hybrid_discoveries", 1, "x", 0.65, "HYBRID_ENSEMBLE", "X", 2001), ("u1", "hybrid_discoveries", 2, "z", 0.2, "CO_WATCH_ASSOCIATION", "", 2024),
        ("u1", "hybrid_discoveries", 3, "y", 0.1, "COLLABORATIVE_SVD", "", 2024), ("new", "because_you_watched", 1, "q", 0.3, "CO_WATCH_ASSOCIATION", "", 2024),
        ("new", "hybrid_discoveries", 1, "q", 0.15, "CO_WATCH_ASSOCIATION", "", 2024)], key=lambda x: tuple(map(str, x)))


def test_themes(spark, rows):
    users = spark.createDataFrame([("u1",), ("new",)], "user_id string")
    feats = spark.createDataFrame([("u1", 12.5, 80.0)], "user_id string, genre_watch_minutes_30d double, content_completion_rate double")
    hits = spark.createDataFrame([(hybrid.KNOWN_THEME, "a", "Drama", 0.876, 1), (hybrid.NEW_THEME, "b", "Comedy", 0.5, 1)], "theme string, content_id string, genre string, similarity_score double, rank int")
    assert rows(hybrid.themed_recommendations(users, feats, hits), "user_id", "content_id", "explain_reason") == [
        ("new", "b", "Recommended based on your 0.0m watch history in Comedy with 50% vector match."),
        ("u1", "a", "Recommended based on your 12.5m watch history in Drama with 88% vector match.")]


MOVIE = "content_id string, title string, synopsis string, genres array<string>, language string, release_year int, cast array<string>, director string, maturity_rating string, keywords array<string>"
SERIES = "content_id string, title string, synopsis string, genres array<string>, language string, release_year int, cast array<string>, creator string, maturity_rating string, total_seasons int, keywords array<string>"


def test_chunks_embeddings_and_answers(spark, rows):
    movies = spark.createDataFrame([("m1", "Sky", "Up high.", ["Sci-Fi", "Drama"], None, 2020, ["A", "B"], "D", None, ["space"])], MOVIE)
    series = spark.createDataFrame([("s1", "Sea", "Deep.", ["Doc"], "fr", None, None, None, "PG", None, None)], SERIES)
    chunks = text.catalog_chunks(movies, series)
    assert rows(chunks, "content_id", "chunk_index", "chunk_text") == [
        ("m1", 0, "Title: Sky (2020). Genres: Sci-Fi, Drama. Language: en. Rating: U/A 13+. Synopsis: Up high."),
        ("m1", 1, "Sky: Directed by D. Starring A, B. Key Themes & Tropes: space."),
        ("s1", 0, "Series: Sea. Seasons: 1. Genres: Doc. Created by: . Starring: . Synopsis: Deep.. Tropes: .")]
    emb = text.embed(chunks)
    sizes = [len(x["embedding"]) for x in emb.collect()]
    assert sizes == [384] * 3
    assert [x[0] for x in emb.select(vectors.norm(F.col("embedding"))).collect()] == pytest.approx([1.0] * 3, abs=1e-5)
    stored = chunks.select("chunk_id", F.sha2("chunk_text", 256).alias("content_hash"))
    assert text.embedding_delta(chunks, stored).count() == 0
    changed = chunks.withColumn("chunk_text", F.when(F.col("content_id") == "s1", "new").otherwise(F.col("chunk_text")))
    assert rows(text.embedding_delta(changed, stored), "content_id") == [("s1",)]
    # the text of a chunk finds that chunk
    hits = vector.knn(emb.select(F.col("chunk_id").alias("query_id"), F.col("embedding").alias("vec")), emb.select("chunk_id", F.col("embedding").alias("vec")), 1)
    assert all(x["query_id"] == x["chunk_id"] and x["similarity_score"] == 1.0 for x in hits.collect())
    q = spark.createDataFrame([(1, "space"), (2, "nothing")], "query_id int, query_text string")
    h = spark.createDataFrame([(1, "m1", "Sky", "chunk", 0.8765, 1), (1, "m2", None, "c2", 0.5, 2)], "query_id int, content_id string, title string, chunk_text string, similarity_score double, rank bigint")
    got = {x["query_id"]: x for x in text.answers(q, h, "Acme").collect()}
    assert got[1]["answer"] == ("Based on your interest in 'space', here are top recommendations from Acme:\n\n1. **Sky** is your closest match (relevance: 87.7%). "
                                "It features: chunk\n\nOther strong contenders in our catalog include **m2**.")
    assert got[1]["context"] == "- **Sky** (m1): chunk [Match Score: 0.8765]\n- **m2** (m2): c2 [Match Score: 0.5]"
    assert got[2]["answer"] == "Sorry, I couldn't find any relevant titles in the Acme catalog matching your query." and got[2]["sources"] == [] and got[2]["retrieval_count"] == 0
