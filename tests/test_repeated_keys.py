"""Queries over tables whose keys meet: rows built here, compared with the query's SQL."""

import duckdb
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from checks.compare import rows_of
from marquee.operators import text

SF = "/root/testdata/sf0.001"


def both(spark, name, folder, **tables):
    """(rows of the query, rows of its SQL) over the given tables."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    df = queries()[name](spark, str(folder))
    cur = con.execute(oracle_sql()[name])
    return rows_of(df.columns, [tuple(x) for x in df.collect()]), rows_of([d[0] for d in cur.description], cur.fetchall())


def parts(spark):
    """Part keys of seven digits give the content ids of shorter ones."""
    cut = spark.createDataFrame(
        [(100000, 40, "PROMO"), (1000000, 10, "PROMO"), (1000001, 30, "SMALL"), (1000002, 41, "SMALL"), (7, 41, "PROMO"), (8, 38, "SMALL")], "k bigint, size int, type string")
    return cut.select(F.col("k").alias("p_partkey"), F.concat(F.lit("part "), F.col("k").cast("string")).alias("p_name"), F.col("type").alias("p_type"),
                      F.lit("Brand#1").alias("p_brand"), F.col("size").alias("p_size"), F.lit(10.0).alias("p_retailprice"))


def test_embedding_delta_of_meeting_ids(spark, tmp_path):
    got, want = both(spark, "c03_embedding_delta", tmp_path, part=parts(spark))
    assert got == want


def test_diff_leaves_out_embedded_text_among_namesakes(spark, rows):
    chunks = spark.createDataFrame([("a", "one"), ("b", "two")], "chunk_id string, chunk_text string")
    existing = spark.createDataFrame([("a", "one"), ("a", "older"), ("b", "older"), ("b", "oldest")], "chunk_id string, t string").select("chunk_id", F.sha2("t", 256).alias("content_hash"))
    assert rows(text.catalog_diff(chunks, existing), "chunk_id", "change") == [("b", "changed"), ("b", "changed")]


def test_relational_source_gives_whole_users(spark):
    df = queries()["s10_relational_source"](spark, SF)
    assert {"user_id", "email", "phone", "country_code", "created_at", "ip"} <= set(df.columns)
