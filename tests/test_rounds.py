"""Operators that SQL can't express, against plain loops; fallbacks, pages and packets."""

import hashlib
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.operators import graph, ingest, retrieval
from lexquarry.plans import packets
from lexquarry.providers import HashingEmbedder
from lexquarry.queries.retrieval import embed_hash
from lexquarry.sources import readers


def test_embed_hash_against_a_loop(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r["id"]: r["embedding"] for r in embed_hash(spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for i, text in texts.items():
        v = np.zeros(64)
        for w in text.lower().split():
            h = int.from_bytes(hashlib.blake2b(w.encode(), digest_size=8).digest(), "little")
            v[h % 64] += 1 if h >> 63 else -1
        n = np.linalg.norm(v)
        assert np.allclose(got[i], v / n if n else v, atol=1e-6)


def test_recall_of_the_hashed_index(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    rows = df.collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["id"] for r in rows])
    hits = 0
    for i in range(0, len(rows), len(rows) // 10):
        d = np.linalg.norm(x - x[i] / np.linalg.norm(x[i]), axis=1)
        got = {r["id"]: r["distance"] for r in retrieval.ann_topk(df, x[i].tolist(), 10).collect()}
        hits += len(set(ids[np.argsort(d, kind="stable")[:10]]) & set(got))
        assert all(abs(d[list(ids).index(k)] - v) < 1e-5 for k, v in got.items())
    assert hits / (10 * len(range(0, len(rows), len(rows) // 10))) >= 0.9


def test_queries_in_blocks_find_the_same(spark, sf_dir, monkeypatch):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding").where("id < 60")
    queries = v.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    one = sorted(map(tuple, retrieval.multi_query_topk(v, queries, 3).collect()))
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 25)
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 17)
    plan = retrieval.multi_query_topk(v, queries, 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CoGroup") == 1 and "Cartesian" not in plan and "NestedLoop" not in plan
    odd = v.where("id < 4").unionByName(v.where("id = 5").withColumn("embedding", F.transform("embedding", lambda x: x * 0)))
    assert [(r["id"], r["similarity"] is None) for r in retrieval.multi_query_topk(odd, queries.where("query_id = 2"), 9).orderBy("rank").collect()][-1] == (5, True)
    assert sorted(map(tuple, retrieval.multi_query_topk(v, queries, 3).collect())) == one and len(one) == 180


def test_blocks_meet_in_any_partition(spark, sf_dir, monkeypatch):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding").where("id < 60")
    queries = v.select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    one = sorted(map(tuple, retrieval.multi_query_topk(v, queries, 3).collect()))
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 25)
    monkeypatch.setattr(retrieval, "ROW_BLOCK", 17)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert sorted(map(tuple, retrieval.multi_query_topk(v, queries, 3).collect())) == one and len(one) == 180
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_full_text_search_reads_the_texts_once(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("content"))
    assert "FileScan" not in retrieval.fts_topk(docs, "the of", 5)._jdf.queryExecution().executedPlan().toString()


def test_pages_that_name_the_next(spark):
    def fetch(page):
        return json.dumps({"verses": [page], "pagination": {"next_page": page + 2 if page < 7 else None}})

    assert [r["page"] for r in readers.paged(spark, fetch).orderBy("page").collect()] == [1, 3, 5, 7]
    assert [r["page"] for r in readers.paged(spark, fetch, 4, 2).orderBy("page").collect()] == [1, 2, 3, 4]


def test_names_are_met_exactly(spark):
    nodes = spark.createDataFrame([(1, "ali", None), (2, "Ali", ["Abu"]), (3, "x", ["ABU", None])], "id long, name string, name_variants array<string>")
    pick = lambda n: [r["id"] for r in graph.resolve(nodes, n).collect()]
    assert pick("Ali") == [2] and pick("ali") == [1] and pick("Abu") == [2] and pick("ALI") == []


def test_any_file_is_the_last_resort(spark):
    files = spark.createDataFrame([("a", 0, "a_meta.xml", "9"), ("a", 1, "b.jpg", "1"), ("a", 2, "c.zip", "5"), ("b", 0, "d.jpg", "9"), ("b", 1, "e.PDF", "1"), ("c", 0, "_files.xml", "1")], "item string, pos int, name string, size string")
    assert {r["item"]: r["name"] for r in ingest.pick_best_file(files).collect()} == {"a": "b.jpg", "b": "e.PDF"}


class Embedder(HashingEmbedder):
    """Far topics for the words that a test needs."""


@pytest.fixture(scope="module")
def corpus(spark):
    e = Embedder(64)
    rows = [(i, t, "s", "h", era, who, e.embed([t])[0]) for i, (t, era, who) in enumerate([
        ("khalid at the river battle", "one", ["Khalid"]), ("khalid biography early life", "one", ["Khalid", "Abu"]), ("abu battle details accounts", "one", ["Abu"]),
        ("river battle details of others", "one", ["Zayd"]), ("khalid in another era", "two", ["Khalid"]), ("the market and its prices", "two", []),
    ])]
    chunks = spark.createDataFrame(rows, "id long, content string, source string, source_type string, era string, figures array<string>, embedding array<double>")
    meta = spark.createDataFrame([(i, i, False, "eyewitness", "sahih", False) for i in range(6)], "id long, chunk_id long, noise_flag boolean, account_type string, chain_strength string, conflict_flag boolean")
    return chunks, meta, e


def test_accounts_of_a_figure_at_an_event(corpus):
    """Those of the era that name the figure or a variant come first; under five, others follow once each."""
    chunks, _, e = corpus
    got = packets.episode_accounts(chunks, e, {"name": "Khalid", "name_variants": ["Abu"], "era": ["one"]}, "river battle").collect()
    assert {r["id"] for r in got if r["list_no"] == 0} == {0, 1, 2}
    assert {r["id"] for r in got if r["list_no"] == 1} == {3, 4, 5} and len(got) == 6
    assert all(abs(r["similarity_score"]) <= 1 for r in got)


def test_a_search_that_fails_at_run_time_has_the_next_follow(spark, corpus):
    chunks, meta, e = corpus
    broken = chunks.withColumn("content", F.when(F.col("id") >= 0, F.raise_error(F.lit("no index"))))
    assert packets.search_with_fallback(broken, meta, e, "khalid river") == (None, "none")  # fails only when it runs
    found, mode = packets.search_with_fallback(chunks.drop("content"), meta, e, "khalid river")
    assert mode == "vector" and found.count() == 5
    fine, mode = packets.search_with_fallback(chunks, meta, e, "khalid river")
    assert mode == "hybrid" and fine.count() > 0
    with pytest.raises(ValueError):
        packets.search_with_fallback(chunks, meta, e, " x ")


def test_profile_of_a_figure(spark):
    figures = spark.createDataFrame([(1, "Khalid ibn Walid"), (2, "Umar"), (3, "Khalida")], "id long, name string")
    rels = spark.createDataFrame([(1, 1, 2, "served", "", ""), (2, 2, 3, "met", "", "")], "id long, figure_a_id long, figure_b_id long, relationship string, description string, resolution string")
    docs = spark.createDataFrame([(10, "src", "one"), (11, "src", "two"), (12, "b", "one")], "id long, source string, era string")
    meta = spark.createDataFrame([(10, [1]), (11, [1, 2]), (12, [2])], "chunk_id long, figure_ids array<long>")
    got = packets.figure_profile({"figures": figures, "figure_relationships": rels, "documents": docs, "chunk_metadata": meta}, "khalid")
    assert [r["id"] for r in got["figure"].collect()] == [1]
    assert [(r["relationship"], r["other_name"]) for r in got["relationships"].collect()] == [("served", "Umar")]
    assert got["coverage"].count() == 1
