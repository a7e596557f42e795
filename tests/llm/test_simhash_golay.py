import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lexquarry.llm import simhash_golay as S


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def brute(prints):
    """Component numbers by comparing all pairs."""
    f, root = np.array(prints, np.uint64), list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(f)):
        for j in np.flatnonzero(np.bitwise_count(f[i + 1 :] ^ f[i]) <= 4):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(f))]


def test_code_is_perfect():
    t = S._errors()
    assert t[0] == 0 and (t[1:] > 0).all() and len(set(t.tolist())) == 2048
    words = np.arange(1 << 12, dtype=np.int64) << 11
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= (rest >> bit & 1) * (S._GENERATOR << (bit - 11))
    code = words | rest
    rng = np.random.default_rng(0)
    for _ in range(20):
        e = sum(1 << int(b) for b in rng.choice(23, rng.integers(0, 4), replace=False))
        assert (S.decode(code ^ e) == np.arange(1 << 12)).all()


def test_six_indices_at_most():
    fresh = S.near_indices(np.random.default_rng(1).integers(0, 1 << 23, 3000), 23)[1]
    assert set(fresh.sum(1).tolist()) == {1, 6}


@pytest.mark.parametrize("errors", [0, 1, 2, 3, 4])
def test_pairs_within_four_bits_always_meet(errors):
    rng = np.random.default_rng(errors)
    a = rng.integers(0, 1 << 63, 3000, dtype=np.uint64) << np.uint64(1) | rng.integers(0, 2, 3000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for bit in rng.choice(64, errors, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(bit)
    one, two = (set(zip(*(x.tolist() for x in S.keys(v)))) for v in (a, b))
    assert {r for r, _ in one & two} == set(range(3000))


def test_fingerprints(documents):
    for r in documents.limit(60).collect():
        assert S.fingerprint(r["text"]) == plain_print(r["text"])
    assert S.fingerprint("") == S.fingerprint(" \n") == 0 and S.fingerprint("A\tb ") == plain_print("a b") and S.fingerprint("É x") == plain_print("É X")


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = [plain_print(r["text"]) for r in rows]
    number = brute(want)
    lowest = {}
    for n, r in zip(number, rows):
        if r["doc_id"] is not None:
            lowest[n] = min(lowest.get(n, r["doc_id"]), r["doc_id"])
    expect = sorted((str(r["doc_id"]), f"{w:016x}", lowest.get(n)) for r, w, n in zip(rows, want, number))
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in S.simhash_golay(docs).collect()) == expect


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert S.simhash_golay(no_docs).count() == 0


def test_large_cluster_keeps_its_links_few(spark):
    """One cluster of many near fingerprints: exact components from about as many links as nodes a key."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 3, dtype=np.int64)
    prints = {int(b) for b in base}
    while len(prints) < 700:
        x = int(base[rng.integers(0, 3)])
        for bit in rng.choice(62, rng.integers(1, 6), replace=False):
            x ^= 1 << int(bit)
        prints.add(x)
    prints = sorted(prints)
    df = spark.createDataFrame([(x,) for x in prints], "fp long")
    edges = S.links(df)
    assert edges.where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) > 4).isEmpty()
    got = {r["node"]: r["root"] for r in S.components(edges).collect()}
    number = brute(prints)
    assert [got.get(p, p) for p in prints] == [prints[n] for n in number]
    assert edges.count() < len(prints) ** 2 / 4


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, x) for x in range(101, 160)] + [(300, 200), (7, 7)]
    got = {r["node"]: r["root"] for r in S.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, **{i: 100 for i in range(100, 160)}, 300: 200, 200: 200}
