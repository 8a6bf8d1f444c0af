"""Catalog text: chunks, embeddings and templated answers."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

APOLOGY = "Sorry, I couldn't find any relevant titles in the {platform} catalog matching your query."


def _text(name: str, default="") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(str(default)))


def _list(name: str) -> Column:
    return F.coalesce(F.array_join(F.col(name), ", "), F.lit(""))


def _chunk(kind: str, index: int, text: Column) -> Column:
    return F.struct(F.lit(kind).alias("chunk_type"), F.lit(index).alias("chunk_index"), text.alias("chunk_text"))


def catalog_chunks(movies: DataFrame, series: DataFrame) -> DataFrame:
    """Text chunks of the catalog: two per movie, one per series."""
    # The chunk templates.
    synopsis = F.concat(
        F.lit("Title: "), _text("title"), F.lit(" ("), _text("release_year", 2024), F.lit("). Genres: "), _list("genres"),
        F.lit(". Language: "), _text("language", "en"), F.lit(". Rating: "), _text("maturity_rating", "U/A 13+"),
        F.lit(". Synopsis: "), _text("synopsis"))
    themes = F.concat(
        _text("title"), F.lit(": Directed by "), _text("director"), F.lit(". Starring "), _list("cast"),
        F.lit(". Key Themes & Tropes: "), _list("keywords"), F.lit("."))
    overview = F.concat(
        F.lit("Series: "), _text("title"), F.lit(". Seasons: "), _text("total_seasons", 1), F.lit(". Genres: "), _list("genres"),
        F.lit(". Created by: "), _text("creator"), F.lit(". Starring: "), _list("cast"), F.lit(". Synopsis: "), _text("synopsis"),
        F.lit(". Tropes: "), _list("keywords"), F.lit("."))
    both = F.array(_chunk("synopsis", 0, synopsis), _chunk("cast_and_themes", 1, themes))
    common = ["content_id", "title", "genres", F.coalesce("language", F.lit("en")).alias("language"), "release_year"]
    m = movies.select(*common, F.lit("movie").alias("type"), F.explode(both).alias("c"))
    s = series.select(*common, F.lit("series").alias("type"), F.explode(F.array(_chunk("series_overview", 0, overview))).alias("c"))
    meta = F.to_json(F.struct("title", "genres", "release_year", "type"))
    rows = m.unionByName(s)
    return rows.select(
        F.sha2(F.concat_ws("|", "content_id", "c.chunk_type", F.col("c.chunk_index").cast("string")), 256).alias("chunk_id"),
        "content_id", "title", "type", "c.chunk_type", "c.chunk_index", "c.chunk_text", "language", "genres",
        meta.alias("metadata"))


def hashed_words(dim: int = 384):
    """Stand-in model: signed hashed bag of words, unit length. Not semantic."""
    from zlib import crc32

    def model(texts: pd.Series) -> list[np.ndarray]:
        out = []
        for text in texts.fillna(""):
            v = np.zeros(dim, dtype=np.float32)
            for word in text.lower().split():
                h = crc32(word.encode())
                v[h % dim] += 1.0 if (h >> 16) & 1 else -1.0
            size = np.linalg.norm(v)
            out.append(v / size if size else v)
        return out

    return model


def embed(df: DataFrame, text_col: str = "chunk_text", model=None, out: str = "embedding") -> DataFrame:
    """Add a vector per text; ``model`` maps a batch (Series) to a list of vectors."""
    run = model or hashed_words()

    @F.pandas_udf("array<float>")
    def vectors(batches: "pd.Series") -> "pd.Series":
        return pd.Series(list(run(batches)))

    return df.withColumn(out, vectors(F.col(text_col)))


def embedding_delta(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """Chunks that are new or whose text changed since they were embedded."""
    marked = chunks.withColumn("content_hash", F.sha2("chunk_text", 256))
    return marked.join(existing.select("chunk_id", "content_hash"), ["chunk_id", "content_hash"], "left_anti")


def catalog_diff(chunks: DataFrame, existing: DataFrame) -> DataFrame:
    """(chunk_id, content_hash, chunk_text, change) of chunks that are ``new``, ``changed`` or ``removed`` since they were embedded.

    existing: chunk_id, content_hash. A removed chunk has no text; chunks with the same text are left out, also
    where other texts were embedded under their id.
    """
    marked = chunks.select("chunk_id", "chunk_text", F.sha2("chunk_text", 256).alias("content_hash"))
    old = existing.select("chunk_id", F.col("content_hash").alias("_old"))
    both = marked.join(old, "chunk_id", "full")
    change = F.when(F.col("_old").isNull(), "new").when(F.col("content_hash").isNull(), "removed").when(F.col("content_hash") != F.col("_old"), "changed")
    told = both.withColumn("change", change).where("change IS NOT NULL").select("chunk_id", "content_hash", "chunk_text", "change")
    return told.join(existing.select("chunk_id", "content_hash"), ["chunk_id", "content_hash"], "left_anti").select(*told.columns)


def answers(queries: DataFrame, hits: DataFrame, platform: str = "our platform") -> DataFrame:
    """Answer text and sources per query from its ranked hits (k rows each).

    queries: query_id, query_text. hits: query_id, content_id, title, chunk_text,
    similarity_score, rank.
    """
    title = F.coalesce("title", "content_id")
    hit = F.struct("rank", title.alias("title"), "content_id", "chunk_text", "similarity_score")
    folded = hits.groupBy("query_id").agg(F.sort_array(F.collect_list(hit)).alias("h"))
    best = F.col("h")[0]
    tenths = F.floor(best["similarity_score"] * 1000.0 + 0.5)
    share = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"))
    bold = lambda c: F.concat(F.lit("**"), c, F.lit("**"))
    rest = F.array_join(F.transform(F.slice("h", 2, F.greatest(F.size("h"), F.lit(1))), lambda x: bold(x["title"])), ", ")
    # The answer template.
    text = F.concat(
        F.lit("Based on your interest in '"), F.col("query_text"), F.lit(f"', here are top recommendations from {platform}:\n\n1. "),
        bold(best["title"]), F.lit(" is your closest match (relevance: "), share, F.lit("%). It features: "),
        best["chunk_text"], F.lit("\n\nOther strong contenders in our catalog include "), rest, F.lit("."))
    context = F.array_join(F.transform("h", lambda x: F.concat(
        F.lit("- "), bold(x["title"]), F.lit(" ("), x["content_id"], F.lit("): "), x["chunk_text"],
        F.lit(" [Match Score: "), x["similarity_score"].cast("string"), F.lit("]"))), "\n")
    sources = F.transform("h", lambda x: F.struct(
        x["content_id"].alias("content_id"), x["title"].alias("title"), x["similarity_score"].alias("score")))
    joined = queries.join(folded, "query_id", "left")
    found = F.col("h").isNotNull()
    return joined.select(
        "query_id", "query_text",
        F.when(found, text).otherwise(F.lit(APOLOGY.format(platform=platform))).alias("answer"),
        F.coalesce(context, F.lit("")).alias("context"),
        F.when(found, sources).otherwise(F.array().cast("array<struct<content_id:string,title:string,score:double>>")).alias("sources"),
        F.when(found, F.size("h")).otherwise(F.lit(0)).alias("retrieval_count"))
