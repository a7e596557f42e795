"""The kept index against a plain BM25 over all rows."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.operators import fulltext as X

DOCS = "id long, content string"


def brute(rows, queries, n):
    words = {i: re.findall(r"[^\W_]+", (t or "").lower()) for i, t in rows}
    mean = sum(map(len, words.values())) / len(words)
    df = Counter(w for ws in words.values() for w in set(ws))
    out = []
    for q, text in queries:
        terms = set(re.findall(r"[^\W_]+", text.lower()))
        scores = {}
        for i, ws in words.items():
            tf = Counter(ws)
            s = sum(math.log(1 + (len(words) - df[t] + 0.5) / (df[t] + 0.5)) * tf[t] * 2.2 / (tf[t] + 1.2 * (0.25 + 0.75 * len(ws) / mean)) for t in terms if tf[t])
            if s:
                scores[i] = round(s, 6)
        out += [(q, i, s, k + 1) for k, (i, s) in enumerate(sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:n])]
    return sorted(out)


def same(got, want):
    assert [(r[0], r[1], r[3]) for r in got] == [(r[0], r[1], r[3]) for r in want]
    assert all(abs(a[2] - b[2]) < 2e-6 for a, b in zip(got, want))


@pytest.fixture(scope="module")
def corpus(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("content")).where("id < 150")
    return docs, [(r["id"], r["content"]) for r in docs.collect()]


def test_exact_and_skips_blocks(spark, corpus, tmp_path):
    docs, rows = corpus
    rare = [w for w, n in Counter(w for _, t in rows for w in set(re.findall(r"[^\W_]+", (t or "").lower()))).items() if n == 3]
    queries = [(1, "The of, THE"), (2, "zzz"), (3, " ".join(rare[:3])), (4, rows[0][1]), (5, rare[0] + " the")]
    X.write_index(docs.repartition(3), str(tmp_path / "ix"), block=4)
    index = X.Index(spark, str(tmp_path / "ix"))
    assert index.docs == len(rows)
    found, counts = index.search(spark.createDataFrame(queries, "query_id long, query string"), 3)
    same(sorted(map(tuple, found.collect())), brute(rows, queries, 3))
    read = {r["query_id"]: (r["blocks"], r["read"]) for r in counts.collect()}
    assert 2 not in read and all(r <= b for b, r in read.values())
    assert read[5][1] < read[5][0] / 2 and read[4][1] < read[4][0]  # most blocks of a frequent term are left alone


def test_nulls_empty_texts_and_repeated_ids(spark, tmp_path):
    rows = [(1, "a b a"), (2, None), (3, ""), (4, "b"), (4, "b b"), (None, "a"), (5, "!? -"), (6, "A_b ä")]
    X.write_index(spark.createDataFrame(rows, DOCS).coalesce(1), str(tmp_path / "ix"), block=2)
    index = X.Index(spark, str(tmp_path / "ix"))
    assert index.docs == 8
    got = index.search(spark.createDataFrame([(1, "a"), (2, "B b"), (3, ""), (4, "Ä")], "query_id long, query string"), 10)[0].collect()
    by = {}
    for r in got:
        by.setdefault(r["query_id"], []).append(r["id"])
    assert sorted(by) == [1, 2, 4] and set(by[1]) == {1, 6, None} and sorted(by[2]) == [1, 4, 4, 6] and by[4] == [6]


def test_empty_corpus(spark, tmp_path):
    X.write_index(spark.createDataFrame([], DOCS), str(tmp_path / "ix"))
    assert X.Index(spark, str(tmp_path / "ix")).search(spark.createDataFrame([(1, "a")], "query_id long, query string"), 3)[0].collect() == []


def test_only_frontiers_are_read_for_bounds(spark, corpus, tmp_path):
    X.write_index(corpus[0], str(tmp_path / "ix"))
    index = X.Index(spark, str(tmp_path / "ix"))
    asked = spark.createDataFrame([(1, "the", 1.0)], "query_id long, term string, idf double")
    plan = index.bounds(asked)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,the)" in plan or "In(term" in plan
    assert "tfs" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_frontier_reaches_every_largest_weight():
    rng = np.random.default_rng(4)
    term, tf, dl = np.sort(rng.integers(0, 30, 400)), rng.integers(1, 9, 400), rng.integers(1, 60, 400)
    best = X.frontiers(term, tf, dl)
    assert len(best) < 200
    w = lambda i, mean: tf[i] * 2.2 / (tf[i] + 1.2 * (0.25 + 0.75 * dl[i] / mean))
    for mean in (1, 10, 1000):
        for t in range(30):
            own = np.flatnonzero(term == t)
            assert not len(own) or w(own, mean).max() == w(best[term[best] == t], mean).max()
    assert len(X.frontiers(term[:0], tf[:0], dl[:0])) == 0


def test_postings_count_in_place_and_rows_of_one_id_meet(spark, monkeypatch):
    from collections import Counter

    from lexquarry.operators import retrieval as R

    rows = [(1, "b a b"), (2, "a"), (3, None), (4, ""), (5, "...")]
    again = [*rows, (2, "a"), (2, "a b"), (None, "x"), (None, "x"), (1, "c")]

    def want(rows):
        out = Counter()
        for i, text in rows:
            words = re.findall(r"\w+", text or "")
            for w in words:
                out[i, len(words), w] += 1
        return sorted(str((*k, n)) for k, n in out.items())

    def got(df):
        return sorted(str((r["id"], r["dl"], r["term"], r["tf"])) for r in df.collect())

    one = R.postings(spark.createDataFrame(rows, "id int, content string"))
    assert got(one) == want(rows)
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    for most in (R.BROADCAST_ROWS, 0):
        monkeypatch.setattr(R, "BROADCAST_ROWS", most)
        assert got(R.postings(spark.createDataFrame(again, "id int, content string"))) == want(again)
