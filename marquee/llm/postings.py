"""Positional inverted index over documents; exact phrases and near terms by intersecting posting lists, rarest first.

DataFrame functions only. A posting is (doc_id, text_hash, pos, term); the pair names a text even
if ids repeat or are null. The term '' stands once in every text, at the number of its words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.llm.common import stage

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WINDOW = 10
BROADCAST_ROWS = 200_000  # of words or text keys; beyond this Spark joins by shuffle
TEXT = ["doc_id", "text_hash"]


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text; none for null."""
    ascii_only = F.length(text) == F.octet_length(text)
    lowered = F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def sized(df: DataFrame) -> DataFrame:
    """A staged table, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def test_windows(items: DataFrame, n: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(phrase, words, item_id): every run of ``n`` words of an item; a shorter item that has words is one run."""
    w = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("ws")).where(F.size("ws") > 0)
    starts = w.select("item_id", "ws", F.explode(F.sequence(F.lit(1), F.greatest(F.size("ws") - n + 1, F.lit(1)))).alias("at"))
    runs = starts.select("item_id", F.slice("ws", F.col("at"), n).alias("words"))
    return runs.select(F.array_join("words", " ").alias("phrase"), "words", "item_id").distinct()


def build_index(docs: DataFrame, terms: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The stored postings of ``terms`` (one column, ``term``) in all documents, and the '' posting of each."""
    kept = sized(terms.select("term").union(terms.sparkSession.range(1).select(F.lit("").alias("term"))).distinct())
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), words(F.col(text)).alias("ws"))
    exploded = rows.select("doc_id", "text_hash", F.posexplode(F.concat("ws", F.array(F.lit("")))).alias("pos", "term"))
    return stage(exploded.join(kept, "term", "left_semi").select("doc_id", "text_hash", "pos", "term"), "postings")


def ranked(phrases: DataFrame, index: DataFrame) -> DataFrame:
    """(phrase, places): its (n, offset, term) from the rarest term on; phrases with a term without postings go."""
    counts = index.groupBy("term").agg(F.count("*").alias("n"))
    places = phrases.select("phrase", F.size("words").alias("len"), F.posexplode("words").alias("off", "term")).join(counts, "term")
    grouped = places.groupBy("phrase", "len").agg(F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("places"))
    return grouped.where(F.size("places") == F.col("len"))


def _place(i: int, *more: str) -> list[Column]:
    at = F.col("places")[i]
    return [F.col(c) for c in more] + [at["term"].alias("term"), at["off"].alias("off")]


def phrase_matches(index: DataFrame, phrases: DataFrame) -> DataFrame:
    """(doc_id, text_hash, phrase, start, len) of every exact occurrence of the ``phrases`` (phrase, words).

    Candidates are the places of a phrase's rarest term, shifted by its offset. They are
    intersected with the list of the second rarest term, then with those of all other terms,
    read for the texts that are left.
    """
    plan = stage(ranked(phrases.select("phrase", "words").distinct(), index), "phrases")
    first = plan.select(*_place(0, "phrase", "len"))
    found = index.join(sized(first), "term").select(*TEXT, "phrase", "len", (F.col("pos") - F.col("off")).alias("start")).where("start >= 0")
    rest = plan.where("len > 1").select(*_place(1, "phrase"))
    second = found.where("len > 1").join(sized(rest), "phrase").select(*TEXT, "phrase", "len", "start", "term", (F.col("start") + F.col("off")).alias("pos"))
    lists = index.join(sized(stage(rest.select("term").distinct(), "second-terms")), "term", "left_semi")
    two = second.join(lists.distinct(), _same(second, lists.distinct(), "pos", "term"), "left_semi").select(*TEXT, "phrase", "len", "start")
    left = stage(found.where("len = 1").select(*TEXT, "phrase", "len", "start").union(two).distinct(), "candidates")
    done = left.where("len <= 2")
    others = plan.where("len > 2").select("phrase", F.explode(F.slice("places", 3, 1 << 20)).alias("at")).select("phrase", "at.term", "at.off")
    probes = left.join(sized(others), "phrase").select(*TEXT, "phrase", "len", "start", "term", (F.col("start") + F.col("off")).alias("pos"))
    texts = stage(left.where("len > 2").select(*TEXT).distinct(), "candidate-texts")
    near = index.join(sized(texts), _same(index, texts), "left_semi").where(F.col("term") != "").distinct()
    full = (probes.join(near, _same(probes, near, "pos", "term"), "left_semi").groupBy(*TEXT, "phrase", "len", "start")
            .agg(F.count("*").alias("n")).where("n = len - 2").drop("n"))
    return done.unionByName(full)


def _same(a: DataFrame, b: DataFrame, *more: str) -> Column:
    """Equal texts (null ids are equal) and equal columns."""
    on = a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    for c in more:
        on &= a[c] == b[c]
    return on


def proximity_matches(index: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(doc_id, text_hash, phrase, pos): places of a phrase's rarest term with all its other terms, in any order, at most ``slop`` words away."""
    plan = stage(ranked(phrases.select("phrase", F.array_distinct("words").alias("words")).distinct(), index), "phrases")
    first = plan.select(*_place(0, "phrase", "len"))
    found = index.join(sized(first), "term").select(*TEXT, "phrase", "len", F.col("pos").alias("at")).distinct()
    others = plan.where("len > 1").select("phrase", F.explode(F.slice("places", 2, 1 << 20)).alias("p")).select("phrase", "p.term")
    probes = found.join(sized(others), "phrase").select(*TEXT, "phrase", "len", "at", "term")
    # a place is looked up in its own block of positions and the two beside it
    blocks = probes.withColumn("block", F.explode(F.array([F.floor(F.col("at") / (slop + 1)) + k for k in (-1, 0, 1)])))
    lists = index.withColumn("block", F.floor(F.col("pos") / (slop + 1)))
    near = (F.abs(blocks["at"] - lists["pos"]) <= slop) & _same(blocks, lists, "term", "block")
    hits = blocks.join(lists, near, "left_semi").select(*TEXT, "phrase", "len", "at", "term").distinct()
    full = hits.groupBy(*TEXT, "phrase", "len", "at").agg(F.count("*").alias("n")).where("n = len - 1").drop("n")
    return found.where("len = 1").unionByName(full).select(*TEXT, "phrase", F.col("at").alias("pos"))


def contamination(docs: DataFrame, items: DataFrame, n: int = WINDOW) -> DataFrame:
    """Per document row: ``doc_id text_hash n_words n_hit n_items item_ids contaminated``.

    A word is hit if it stands inside any occurrence of an item's ``n``-word window (or of a
    whole shorter item). Null and empty texts have no words and no hits; items without words
    match nothing, and neither does an empty benchmark. Repeated rows each get their row, equal
    texts under different ids too; null ids are kept. Other columns are not read. ``item_ids``
    is sorted as text.
    """
    windows = stage(test_windows(items, n), "windows")
    terms = stage(windows.select(F.explode("words").alias("term")).distinct(), "terms")
    index = build_index(docs, terms)
    matches = stage(phrase_matches(index, windows), "matches")
    by_start = Window.partitionBy(*TEXT).orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    spans = matches.select(*TEXT, "start", (F.col("start") + F.col("len")).alias("end")).distinct()
    new = F.greatest(F.col("end") - F.greatest("start", F.coalesce(F.max("end").over(by_start), F.lit(0))), F.lit(0))
    hits = spans.select(*TEXT, new.alias("new")).groupBy(*TEXT).agg(F.sum("new").alias("n_hit"))
    owners = windows.select("phrase", F.col("item_id").cast("string").alias("item")).distinct()
    named = (matches.select(*TEXT, "phrase").distinct().join(owners, "phrase").groupBy(*TEXT)
             .agg(F.array_sort(F.collect_set("item")).alias("item_ids")))
    found = hits.join(named, _same(hits, named), "left").select(hits["doc_id"], hits["text_hash"], "n_hit", "item_ids")
    all_docs = index.where(F.col("term") == "").select(*TEXT, F.col("pos").cast("bigint").alias("n_words"))
    out = all_docs.join(found, _same(all_docs, found), "left")
    return out.select(all_docs["doc_id"], all_docs["text_hash"], "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
                      F.size(F.coalesce("item_ids", F.array().cast("array<string>"))).cast("bigint").alias("n_items"),
                      F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
                      F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"))


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(list_slice(ws, i, i + 9), ' ') AS phrase
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
places AS (SELECT doc_id, i, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS phrase
  FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(len(ws) - n + 1, 0) + 1)) AS i FROM d, sizes)),
hit AS (SELECT doc_id, i, p.n, item_id FROM places p JOIN win w ON p.phrase = w.phrase AND p.n = w.n),
pos AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS x FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
SELECT doc_id, coalesce(len(ws), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)"""
