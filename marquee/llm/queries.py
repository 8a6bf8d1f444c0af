"""The operators as registered queries over whole tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.llm import bpe, conversations, huffman, licenses, maxscore, neardup, pitman_yor, postings, pseudonyms, quality, repeats, topk, warc
from marquee.llm.common import table
from marquee.llm.pipeline import PSEUDONYM_KEY, vocabulary
from marquee.session import scratch_path


def op1_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitman_yor.score_documents(table(spark, sf_dir, "documents"))


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = huffman.round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")


def op4_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    read = warc.read_warc(warc.write_warc(table(spark, sf_dir, "pages"), root), root)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = bpe.bpe_round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"))
    return read.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", *quality.MEASURES)


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = postings.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), "contaminated")


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxscore.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", *conversations.MEASURES)


QUERIES = {f.__name__: f for f in (op1_pitman_yor, op2_token_files, op3_license_scan, op4_pseudonyms, op5_warc, op6_bpe, op7_quality, op8_near_duplicates, op9_decontaminate, op10_repeats, op11_ranked_search, op12_exact_top_k, op13_conversation_repair)}
SQL = {"op5_warc": warc.SQL, "op7_quality": quality.SQL, "op8_near_duplicates": neardup.SQL, "op9_decontaminate": postings.SQL,
       "op11_ranked_search": maxscore.SQL, "op12_exact_top_k": topk.SQL, "op13_conversation_repair": conversations.SQL}
