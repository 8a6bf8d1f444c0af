"""The stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents that go on."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.llm import bpe, neardup, postings, pseudonyms, quality
from marquee.llm.common import perhaps_in, stage, table

# A demonstration key, so that runs can be compared; set MARQUEE_PSEUDONYM_KEY for real data.
PSEUDONYM_KEY = os.environ.get("MARQUEE_PSEUDONYM_KEY", "for tests only").encode()
SHINGLE_WORDS, SIMILAR_PERCENT = 5, 80


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def apart(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """The documents with all columns but ``text`` renamed, so that no operator's column replaces one, and the way back."""
    names = {c: f"_column_{i}" for i, c in enumerate(docs.columns) if c != "text"}
    return docs.withColumnsRenamed(names), [F.col(names.get(c, c)).alias(c) for c in docs.columns]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects; null and empty texts are rejected.

    Repeated rows are judged alike, columns named like the rules' measures stay as they are, and an empty table stays empty.
    """
    rows, back = apart(docs)
    return quality.quality_rules(rows).where("kept").select(*back)


def keep_first_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Rows that repeat an id and its shingles are one document; only those are grouped by id. Null and empty texts are
    linked with nothing and stay, so do other columns; an empty table stays empty.
    """
    found = stage(neardup.near_duplicates(docs, SHINGLE_WORDS, SIMILAR_PERCENT), "near-duplicates")
    gone = stage(found.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("NOT kept").select("doc_id"), "dropped-ids")
    sifted = perhaps_in(docs, gone, "doc_id")
    suspects = sifted.where("_perhaps")
    kept = suspects.join(gone, suspects["doc_id"].eqNullSafe(gone["doc_id"]), "left_anti").unionByName(sifted.where("NOT _perhaps")).drop("_perhaps")
    again = found.where("node IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again_id"))
    if again.isEmpty():
        return kept
    same = kept["doc_id"].eqNullSafe(again["again_id"])
    marked = neardup.shingled(kept.join(again, same, "left_semi"), SHINGLE_WORDS).join(
        found.where("kept AND node IS NOT NULL").select("node").distinct(), "node", "left_semi")
    return kept.join(again, same, "left_anti").unionByName(marked.dropDuplicates(["node"]).select(*docs.columns))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of the benchmark; null and empty texts hold none and stay.

    Repeated rows stay or go together, null ids too; other columns stay as they are. An empty table or benchmark changes nothing.
    """
    found = postings.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad = stage(found.where("contaminated").select(F.col("doc_id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct(), "contaminated")
    on = docs["doc_id"].eqNullSafe(bad["bad_id"]) & (F.xxhash64(docs["text"]) == bad["bad_hash"])
    return docs.join(bad, on, "left_anti")


def hide_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal numbers; ``n_chars`` follows the text.

    A null text stays null, and its ``n_chars`` too. All rows stay, repeated ones alike, and so do columns named like the operator's.
    """
    rows, back = apart(docs)
    out = pseudonyms.pseudonyms(rows, PSEUDONYM_KEY).select(*back)
    return out.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else out


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, their number, and the text that the ids decode to; beside doc_id, lang and source where there are such.

    A null text counts as empty and has no ids. Every row comes out, repeated ones alike.
    """
    rows, back = apart(docs)
    kept = [c for c, name in zip(back, docs.columns) if name in ("doc_id", "lang", "source")]
    coded = bpe.bpe_round_trip(rows, vocabulary("word_bpe_49k.json"))
    return coded.select(*kept, "ids", F.size("ids").cast("bigint").alias("n_tokens"), "decoded")


STAGES = [("quality_rules", keep_quality), ("near_duplicates", keep_first_copy), ("decontamination", keep_uncontaminated),
          ("pseudonyms", hide_private), ("bpe", encode)]
