"""The pipeline against a plain version of its stages."""

import re

import corpus_pipeline
from marquee.llm import bpe, neardup, pipeline, pseudonyms
from marquee.llm.common import perhaps_in
from tests.llm.test_operators import alnum, blank, edited, lowered, prose, quality_of


def test_pipeline(spark, tmp_path):
    base, item = prose(150, 31), prose(30, 32)
    docs = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(
        [base, base, edited(base, 2, 33), prose(90, 34), "short", None, "", prose(60, 35) + " " + item + " " + prose(30, 36), "x! " * 100,
         prose(80, 37) + " card 4111 1111 1111 1111 on 2024-02-29"])] + [(3, prose(90, 34), "en", "s", 0)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [d for d in docs if quality_of(d[1])[-1]]
    sets = [{tuple(w[i:i + 5]) for i in range(len(w) - 4)} for w in (blank(lowered(d[1])) for d in left)]
    kept = [d for i, d in enumerate(left) if not any(100 * len(sets[i] & s) >= 80 * len(sets[i] | s) for s in sets[:i])]
    windows = {tuple(alnum(item)[i:i + 10]) for i in range(21)}
    kept = [d for d in kept if not any(tuple(alnum(d[1])[i:i + 10]) in windows for i in range(len(alnum(d[1]))))]
    coder = bpe.WordBpe(pipeline.vocabulary("word_bpe_49k.json"))
    want = {}
    for d in kept:
        text = pseudonyms.replace(d[1], pseudonyms.find(d[1], pipeline.PSEUDONYM_KEY))
        ids = coder.encode(text).tolist()
        want[d[0]] = (ids, len(ids), coder.decode(ids))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: (r.ids, r.n_tokens, r.decoded) for r in got} == want and len(got) == len(want) == 3
    assert not any(re.search("4 1 1 1 1", r.decoded.replace("</w>", "")) for r in got)


def test_stages_take_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, none, str(tmp_path)).columns == none.columns


def test_stages_keep_clashing_columns(spark, tmp_path):
    ddl = "doc_id bigint, text string, n_words int, base_failed boolean, kinds string, ids string, kept string, n_chars bigint"
    rows = [(1, prose(90, 41), -7, True, "mine", "i", "k", 5), (1, prose(90, 41), -7, True, "mine", "i", "k", 5), (None, prose(80, 42) + " 4111 1111 1111 1111", 2, None, None, None, None, None), (3, None, 1, True, "x", "y", "z", None)]
    docs = spark.createDataFrame(rows, ddl)
    spark.createDataFrame([], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = pipeline.keep_quality(spark, docs, str(tmp_path))
    assert sorted(map(str, good.collect())) == sorted(str(r) for r in docs.where("text IS NOT NULL").collect())
    hidden = pipeline.hide_private(spark, docs, str(tmp_path))
    assert hidden.columns == docs.columns
    assert sorted(map(str, hidden.drop("text", "n_chars").collect())) == sorted(map(str, docs.drop("text", "n_chars").collect()))
    assert all(r.n_chars == (r.text and len(r.text)) and "4111 1111" not in (r.text or "") for r in hidden.collect())
    coded = pipeline.encode(spark, docs, str(tmp_path))
    assert coded.columns == ["doc_id", "ids", "n_tokens", "decoded"] and coded.count() == 4
    assert coded.where("doc_id = 3").first().n_tokens == 0


def test_values_are_sifted_without_loss(spark):
    rows = spark.createDataFrame([(i, f"t{i}") for i in range(3000)] + [(None, "null")], "id int, text string")
    values = spark.createDataFrame([(i,) for i in range(0, 3000, 7)] + [(None,)], "id bigint")
    got = perhaps_in(rows, values, "id")
    assert got.columns == ["id", "text", "_perhaps"] and got.count() == 3001
    found = {r.id for r in got.where("_perhaps").collect()}
    assert found >= {None, *range(0, 3000, 7)} and len(found) < 450
    assert perhaps_in(rows, values.limit(0), "id").where("_perhaps").isEmpty()


def test_copies_are_dropped_without_moving_other_texts(spark):
    """Joins of whole rows see only those that the sieve lets through."""
    base = prose(90, 51)
    docs = spark.createDataFrame([(i, prose(90, 60 + i)) for i in range(20)] + [(30, base), (31, base), (32, edited(base, 1, 52))], "doc_id int, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = pipeline.keep_first_copy(spark, docs, "")
        plan = kept._jdf.queryExecution().toString()
        assert sorted(r.doc_id for r in kept.collect()) == [*range(20), 30] and kept.schema["doc_id"].dataType.simpleString() == "int"
        wanted = neardup.grouped(spark.createDataFrame([(5, 1, 0), (5, 2, 0)], "node bigint, hub bigint, part int"), spark.createDataFrame([(5, 30)], "node bigint, doc_id bigint"))
        plan += neardup.sets_in(docs, wanted, 5, True)._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("bitmap_construct_agg") >= 2
