import numpy as np

from lexquarry.llm import ann


def brute(ids, x, q, k):
    out = {}
    for i in q:
        s = ann.inner(x, x[i])
        order = [j for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def recall(got, want):
    return sum(len({a for a, _ in got[q]} & {a for a, _ in want[q]}) for q in want) / sum(map(len, want.values()))


def test_recall_and_scores_with_few_pairs(spark, monkeypatch):
    """On clustered vectors a quarter of the parts, and of the pairs, is enough."""
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((40, 24))
    x = (centres[rng.integers(0, 40, 6000)] + 0.5 * rng.standard_normal((6000, 24))).astype(np.float32).astype(float)
    monkeypatch.setattr(ann, "SAMPLE", 2000)
    scored = spark.sparkContext.accumulator(0)
    plain = ann._best

    def counted(x, xi, query, near, starts, k):
        scored.add(len(near))
        return plain(x, xi, query, near, starts, k)

    monkeypatch.setattr(ann, "_best", counted)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = found(ann.search(df))
    want = brute(np.arange(len(x)), x, range(0, len(x), 20), 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9
    for q, rows in got.items():
        assert len(rows) == 20 and all(s == float(ann.inner(x[[v]], x[q])[0]) for v, s in rows)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
    router, by_probes = ann.fit(x[:2000], 16, 20)
    assert by_probes[3] >= 0.9


def test_small_and_uniform_tables_reach_the_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = df.orderBy("vec_id").collect()
    x, ids = np.array([r["embedding"] for r in rows], float), np.array([r["vec_id"] for r in rows])
    got = found(ann.search(df))
    want = brute(ids, x, np.flatnonzero(ids % 20 == 0), 20)
    assert set(got) == set(want) and recall(got, want) >= 0.9


def test_parts_are_balanced():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((300, 8))
    label = ann.balanced_parts(ann._edges(ann._neighbours(x, 6)), 300, 7, rng)
    sizes = np.bincount(label, minlength=7)
    assert sizes.max() - sizes.min() <= 3


def test_parts_follow_the_graph():
    """Two far clusters make two parts."""
    rng = np.random.default_rng(0)
    x = rng.standard_normal((200, 5)) + np.where(np.arange(200)[:, None] % 2, 9, -9) * np.eye(5)[0]
    label = ann.balanced_parts(ann._edges(ann._neighbours(x, 6)), 200, 2, rng)
    assert len(set(label[::2])) == len(set(label[1::2])) == 1


def test_hot_vector_is_dealt_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK_BYTES", 50 * 32)
    monkeypatch.setattr(ann, "AIM", 1.0)
    x = np.ones((400, 4))
    x[300:] = np.random.default_rng(1).standard_normal((100, 4))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got, want = found(ann.search(df)), brute(np.arange(400), x, range(0, 400, 20), 20)
    assert recall(got, want) >= 0.9
    assert all(got[q] == want[q] for q in range(0, 300, 20))


def test_repeated_ids_with_other_vectors(spark):
    """The best vector of an id counts; a query is not its own candidate by another vector."""
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [0.9, 0.0]), (2, [0.1, 1.0]), (0, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(ann.search(df)) == {0: [(2, 1.0), (1, 0.9)]}
    many = spark.createDataFrame([(0, [1.0, 0.0])] + [(1, [float(i), 1.0]) for i in range(1, 60)] + [(2, [0.5, 0.0]), (3, [0.25, 0.0])], "vec_id long, embedding array<double>")
    assert found(ann.search(many)) == {0: [(1, 59.0), (2, 0.5), (3, 0.25)]}


def test_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (8, [1.0]), (40, [2.0]), (9, []), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "extra") for r in rows], "vec_id long, embedding array<double>, id string")
    assert found(ann.search(df)) == {0: [(1, 1.0), (2, 1.0), (20, 0.0)], 20: [(0, 0.0), (1, 0.0), (2, 0.0)], 40: [(8, 2.0)]}
    assert ann.search(df.where("vec_id > 100")).count() == 0
    assert ann.search(df).columns == ["query_id", "rank", "vec_id", "score"]
    long = spark.createDataFrame([(i, [float(i + 1)] * 20_000) for i in range(3)], "vec_id long, embedding array<double>")
    assert [v for v, _ in found(ann.search(long))[0]] == [2, 1]
