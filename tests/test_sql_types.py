"""Table functions, variants and stored statistics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lexquarry.functions import table as table_functions
from lexquarry.functions import text as T
from lexquarry.functions import variant as V
from lexquarry.operators import catalog as C
from lexquarry.operators import ingest as I


def test_chunk_text_is_build_chunks(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("content")).where("id < 60")
    docs = docs.unionByName(spark.createDataFrame([(-1, None), (-2, "")], "id long, content string"))
    table_functions.register(spark)
    got = spark.sql("SELECT id, chunk_index, content, word_count FROM chunk_text(TABLE({d}))", d=docs)
    want = I.build_chunks(docs, T.chunk_sentences())
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 60
    some = spark.sql("SELECT * FROM chunk_text(TABLE(SELECT id AS n, content AS body FROM {d}) PARTITION BY n, text_col => 'body', target => 20, overlap => 5, min_words => 3)", d=docs)
    assert some.columns == ["n", "chunk_index", "content", "word_count"]
    assert sorted(r["content"] for r in some.collect()) == sorted(c for r in docs.collect() for c in T.split_chunks(r["content"] or "", 20, 5, 3))


def test_chunk_text_is_checked_when_analysed(spark):
    table_functions.register(spark)
    docs = spark.createDataFrame([(1, "x")], "id int, body string")
    for call in ("chunk_text(TABLE({d}))", "chunk_text(TABLE(SELECT 1 AS content))", "chunk_text(TABLE(SELECT 'a' AS content, 1 AS chunk_index))"):
        with pytest.raises(Exception, match="text column|columns of the result"):
            spark.sql(f"SELECT * FROM {call}", d=docs).schema  # noqa: B018


def test_variants(spark):
    rows = ['{"a": 1, "b": {"c": [1, "x"]}}', "[1, 2]", '"t"', "null", "true", "1.5", "{broken", None]
    df = spark.createDataFrame(list(enumerate(rows)), "id int, j string").select("id", V.parsed(F.col("j")).alias("v"))
    kinds = [r["k"] for r in df.orderBy("id").select(V.kind(F.col("v")).alias("k")).collect()]
    assert kinds == ["object", "array", "text", "null", "boolean", "number", None, None]
    one = df.where("id = 0").select(V.at(F.col("v"), "$.b.c[1]", "string"), V.at(F.col("v"), "$.a", "int"), V.at(F.col("v"), "$.b.c[1]", "int"), V.at(F.col("v"), "$.z", "int")).first()
    assert tuple(one) == ("x", 1, None, None)
    assert sorted((r["id"], r["field"]) for r in V.fields(df, "v", "id").collect()) == [(0, "a"), (0, "b")]


def test_stored_stats_read_only_new_days(spark, tmp_path):
    day = lambda d: dt.datetime(2024, 3, d, 5)
    rows = [(f"s{i % 700}", f"e{i % 3}" if i % 5 else None, day(1 + i % 9)) for i in range(5000)]
    docs = spark.createDataFrame(rows, "source string, era string, created_at timestamp")
    figures, folder = spark.createDataFrame([(1,), (2,)], "id int"), str(tmp_path / "days")
    C.update_stats(docs.where(F.col("created_at") < F.lit(day(5))), folder)
    poisoned = docs.withColumn("source", F.when(F.col("created_at") < F.lit(dt.datetime(2024, 3, 4)), F.raise_error(F.lit("an old day was read")).cast("string")).otherwise(F.col("source")))
    C.update_stats(poisoned, folder, since=dt.datetime(2024, 3, 4))
    C.update_stats(poisoned, folder, since=dt.datetime(2024, 3, 9))  # counted again
    got, want = C.stored_stats(spark.read.parquet(folder), figures).first(), C.stats(docs, figures).first()
    assert all(got[c] == want[c] for c in ("passages", "last_updated", "figures", "years_covered", "eras"))
    assert abs(got["sources"] - want["sources"]) <= 3 * 1.04 / 2 ** (C.SKETCH / 2) * want["sources"]
    assert spark.read.parquet(folder).count() == 9
    empty = C.stored_stats(C.daily_stats(docs.where("false")), figures).first()
    assert (empty["passages"], empty["sources"], empty["eras"]) == (0, 0, 0)
