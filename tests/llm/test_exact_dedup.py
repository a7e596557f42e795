import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from lexquarry.llm import exact_dedup as E


def test_filter_has_no_false_negatives_and_few_false_positives():
    rng = np.random.default_rng(0)
    for n in (1, 2, 3, 50, 4000, 60_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        f = E.BinaryFuse.build(np.r_[keys, keys[:1]])
        assert f.contains(keys).all()
        assert f.contains(rng.integers(1 << 63, (1 << 64) - 1, 100_000, dtype=np.uint64)).mean() < 1e-3
        assert n < 10_000 or len(f.prints) < 1.3 * n


def brute(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    keep = {}
    for (i, _), t in zip(rows, norm):
        if i is not None:
            keep[t] = min(keep.get(t, i), i)
    return sorted((i is None, i, keep.get(t), norm.count(t), hashlib.sha256(t.encode()).hexdigest()) for (i, _), t in zip(rows, norm))


def check(docs):
    out = E.exact_dedup(docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    key = lambda x: (x[0], x[1] or 0, x[3], x[4])
    assert sorted(((r["doc_id"] is None, r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in out), key=key) == sorted(brute(rows), key=key)
    assert sum(r["kept"] for r in out) == len({r["text_sha256"] for r in out})
    assert all(r["doc_id"] == r["keep_id"] for r in out if r["kept"])


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert E.exact_dedup(no_docs).count() == 0


def test_given_snapshot(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "c"), (3, "a  b"), (4, "d"), (5, "d")], "doc_id long, text string")
    out = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in E.exact_dedup(docs, is_snapshot=F.col("doc_id") < 3).collect()}
    assert out == {1: (1, True), 2: (2, True), 3: (1, False), 4: (4, True), 5: (4, False)}


def test_many_shared_groups_give_the_same(spark, documents, odd_docs, monkeypatch):
    """Beyond the broadcast, a map of the wanted ids keeps other texts where they are."""
    from lexquarry.llm import _util

    monkeypatch.setattr(E, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(_util, "BROADCAST_ROWS", 0)
    check(documents)
    check(odd_docs)
    wanted = documents.where("doc_id % 20 = 0").select(F.col("doc_id").cast("string").alias("key"))
    left = E.among(documents, F.col("doc_id").cast("string"), wanted)
    assert left.columns == documents.columns and {r["doc_id"] for r in left.collect()} == {r["doc_id"] for r in documents.where("doc_id % 20 = 0").collect()}


def test_clashing_names(spark):
    rows = [(i, f"t {i // 2}", 1, 2, 3, 4, 5, 6) for i in range(12)]
    check(spark.createDataFrame(rows, "doc_id long, text string, id int, digest int, _have int, norm int, uid int, old int"))


def test_string_ids(documents):
    """Ids in order of their bytes, dates too: any type that can be compared."""
    few = documents.where("doc_id < 150")
    own = few.withColumn("doc_id", F.concat(F.lit("d"), F.lpad(F.col("doc_id").cast("string"), 6, "0")))
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in E.exact_dedup(own).collect()}
    want = {f"d{r['doc_id']:06}": (f"d{r['keep_id']:06}", r["group_size"], r["kept"]) for r in E.exact_dedup(few).collect()}
    assert got == want and not all(k for *_, k in got.values())
    dated = few.withColumn("doc_id", F.date_add(F.lit("2020-01-01").cast("date"), F.col("doc_id").cast("int")))
    assert sum(r["kept"] for r in E.exact_dedup(dated).collect()) == sum(k for *_, k in got.values())
