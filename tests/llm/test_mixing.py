import re

import math
from collections import defaultdict

import pytest

from lexquarry.llm import mixing
from lexquarry.llm.mixing import mix


def sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]


def plain_targets(total):
    """Water filling, step by step."""
    order = sorted(total, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, free, left = {}, set(order), sum(total.values())
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 3 * total[s]}
        if not over:
            return {**target, **{s: level * weight[s] for s in free}}
        for s in over:
            target[s] = 3.0 * total[s]
            left -= 3.0 * total[s]
        free -= over
    return target


def plain_rates(total, target, held):
    """{(source, size): rate} by bisection of the dual."""
    out = {}
    for s, sizes_ in held.items():
        words = lambda lam: sum(n * min(3.0, math.exp(min(lam * n, 50))) for n in sizes_)  # noqa: B023, E731
        lo, hi = -60.0, 60.0
        for _ in range(200):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if words(mid) < target[s] else (lo, mid)
        out |= {(s, n): min(3.0, math.exp(min(lo * n, 50))) for n in sizes_}
    return out


def check(docs, off):
    """``off`` is by how many words a source may be off its target; rates and targets against plain loops."""
    rows, out = docs.collect(), mix(docs).collect()
    total, held = {}, defaultdict(list)
    for r, n in zip(rows, sizes(rows)):
        total[r["source"]] = total.get(r["source"], 0) + n
        if n:
            held[r["source"]].append(n)
    want = plain_targets(total)
    rates = plain_rates(total, want, held)
    of = {}
    for r in rows:
        of.setdefault(r["doc_id"], r["source"])
    assert len(out) == len(rows) and sorted(r["size"] for r in out) == sorted(sizes(rows))
    taken = {}
    for r in out:
        s = of[r["doc_id"]]
        assert r["target"] == pytest.approx(want[s], rel=1e-9) and r["source_size"] == total[s]
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3
        assert r["rate"] == pytest.approx(rates.get((s, r["size"]), 0), abs=0.06)  # the dual is solved to half a word
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in taken:
        assert abs(taken[s] - want[s]) <= off(s, [r["size"] for r in out if of[r["doc_id"]] == s])
    return sorted((str(r["doc_id"]), r["taken"]) for r in out)


def plain_copies(rows):
    """(size, id, rate) to {id: copies}: longest first, nearest to what is asked so far."""
    out, asked, took = {}, 0.0, 0
    for size, i, rate in sorted(rows, key=lambda x: (-x[0], x[1])):
        asked += rate * size
        out[i] = max(0, min(3, math.floor((asked - took) / size + 0.5)))
        took += out[i] * size
    return out


def test_documents_and_rerun(documents):
    off = lambda s, own: max(own) / 2 if len(own) < 30 else max(1.0, 0.01 * sum(own))
    assert check(documents, off) == check(documents.repartition(3), off)


def test_copies_against_a_loop(documents):
    out = mix(documents).collect()
    source = {r["doc_id"]: r["source"] for r in documents.collect()}
    by = defaultdict(list)
    for r in out:
        if r["size"]:
            by[source[r["doc_id"]]].append((r["size"], r["doc_id"], r["rate"]))
    want = {i: n for rows in by.values() for i, n in plain_copies(rows).items()}
    assert {r["doc_id"]: r["copies"] for r in out if r["size"]} == want


def test_many_blocks_of_one_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 40)
    docs = spark.createDataFrame([(i, "w " * (1 + i * 7 % 23), "hot" if i % 3 else f"s{i % 4}") for i in range(600)], "doc_id long, text string, source string")
    check(docs, lambda s, own: 10)


def test_targets_that_are_cut(spark):
    docs = spark.createDataFrame([(1, "a b c", "x"), (2, "d", "y"), (3, "e " * 50, "z"), (4, "f " * 40, None)], "doc_id long, text string, source string")
    check(docs, lambda s, own: max(own))


def test_repeated_rows_share_their_copies(spark):
    """A third of all rows is one row."""
    rows = [(1, "a b c d", "x")] * 300 + [(2 + i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    once = check(docs, lambda s, own: 4)
    assert once == check(docs.repartition(7), lambda s, own: 4)
    assert len({n for i, n in once if i == "1"}) <= 2


def test_a_dual_that_does_not_settle_is_an_error(spark):
    docs = spark.createDataFrame([(i, "w " * (1 + i % 9), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    sized = docs.selectExpr("doc_id % 3 AS sid", "size(split(trim(text), ' ')) AS size")
    per = mixing.targets(sized.groupBy("sid").agg({"size": "sum"}).withColumnRenamed("sum(size)", "total"))
    with pytest.raises(RuntimeError):
        mixing.tilts(sized, per, 3, steps=1)


def test_odd_rows(spark, odd_docs, no_docs):
    out = mix(odd_docs).collect()
    assert len(out) == 10 and {r["size"] for r in out if r["doc_id"] in (3, 4, 7)} == {0} and {r["taken"] for r in out if r["doc_id"] in (3, 4, 7)} == {0}
    assert mix(no_docs).count() == 0
    names = spark.createDataFrame([(i, "a b", "s", 1, 2, 3, 4, 5, 6) for i in range(9)], "doc_id long, text string, source string, id int, n int, sid int, copies int, rate int, target int")
    assert sum(r["taken"] for r in mix(names).collect()) == 18
