"""The kept neighbour graph against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.operators import neighbour_graph as G


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(a) for a in v]) for i, v in zip(ids, x)], "id long, embedding array<float>")


def exact(x, q, n):
    u, w = (a / np.linalg.norm(a, axis=1, keepdims=True) for a in (x, q))
    return np.argsort(-(w @ u.T), axis=1, kind="stable")[:, :n]


@pytest.mark.parametrize("clusters", [0, 30])
def test_recall_in_one_graph_and_distances(clusters):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4096, 64)).astype(np.float32)
    if clusters:
        x = 0.3 * x + rng.normal(size=(clusters, 64))[rng.integers(0, clusters, len(x))].astype(np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q = x[::100]
    nodes, sims, count = _layered(x).search(q, 10, G.BEAM)
    want = exact(x, q, 10)
    recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(nodes, want)])
    assert recall >= 0.9 and (np.diff(sims, axis=1) <= 0).all()
    assert count.mean() < len(x) * (0.6 if not clusters else 0.4)


def _layered(x):
    order, by = np.random.default_rng(0).permutation(len(x)), [[] for _ in range(len(x))]
    size = len(x)
    while True:
        nodes = np.sort(order[:size])
        for i, own in zip(nodes.tolist(), G._links(x[nodes])):
            by[i].append(nodes[own].tolist() if own else [])
        if size <= G.THIN:
            return G.Graph(x, by)
        size //= G.THIN


def test_written_graph_over_all_rows(spark, sf_dir, tmp_path):
    v = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), "embedding")
    rows = v.collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["id"] for r in rows])
    G.build_graph(v, part_rows=300).write.parquet(str(tmp_path / "g"))
    graph = spark.read.parquet(str(tmp_path / "g"))
    assert graph.count() == len(rows) and graph.agg(F.max("part")).first()[0] >= 1
    queries = v.where("id % 10 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    found, counts = G.graph_topk(graph, queries, 10)
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["similarity"]))
    pick = np.flatnonzero(ids % 10 == 0)
    want = exact(x, x[pick], 10)
    hits = 0
    for i, w in zip(pick, want):
        own = sorted(got[ids[i]])
        assert [r for r, *_ in own] == list(range(1, 11)) and own[0][1] == ids[i]
        hits += len({a for _, a, _ in own} & set(ids[w]))
        assert all(abs(s - x[i] @ x[ids.tolist().index(a)] / np.linalg.norm(x[i]) / np.linalg.norm(x[ids.tolist().index(a)])) < 1e-5 for _, a, s in own[:2])
    assert hits / (10 * len(pick)) >= 0.9
    assert all(0 < r["computed"] <= 1.5 * len(rows) for r in counts.collect()) and counts.count() == len(pick)


def test_odd_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [1.0, 0.0]), (6, [0.0, -2.0]), (6, [0.0, -2.0])]
    df = spark.createDataFrame(rows, "id long, embedding array<float>")
    graph = G.build_graph(df)
    queries = spark.createDataFrame([(1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0])], "query_id long, query array<float>")
    got = [(r["query_id"], r["id"], r["similarity"]) for r in G.graph_topk(graph, queries, 10)[0].orderBy("query_id", "rank").collect()]
    assert got == [(1, 1, 1.0), (1, 5, 1.0), (1, 6, 0.0), (1, 6, 0.0)]
    assert G.graph_topk(G.build_graph(df.where("id = 2")), queries, 3)[0].collect() == []
