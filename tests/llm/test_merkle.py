import hashlib
import zlib

import pytest

from lexquarry.llm import merkle as M

H = lambda *xs: hashlib.sha256("".join(xs).encode()).hexdigest()


def leaf(*fields):
    return H(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def tree(leaves, fan=3):
    """(last node, path of each leaf) by plain lists: a path is a list of (left, right)."""
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for path, i in zip(paths, at):
            run, k = i // fan * fan, i % fan
            siblings = nodes[run : run + fan]
            path.append(("".join(siblings[:k]), "".join(siblings[k + 1 :])))
        nodes = [H(*nodes[i : i + fan]) for i in range(0, len(nodes), fan)]
        at = [i // fan for i in at]
    return (nodes[0] if nodes else None), paths


def brute(rows, fan=3):
    groups = {}
    for r in rows:
        own = [r[c] for c in M.FIELDS]
        gone = own[:-1] + [None if own[-1] is None else own[-1].replace("\n", "")]
        even = own[0] is not None and zlib.crc32(str(own[0]).encode()) % 2 == 0
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf(*own), leaf(*gone) if even else leaf(*own)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    below = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] if x[0] is not None else 0, x[1]))
        below[s] = tree([x[1] for x in groups[s]], fan)
    root, over = tree([below[s][0] for s in names], fan)
    out = []
    for s, top in zip(names, over):
        for (i, own, changed), path in zip(groups[s], below[s][1]):
            path = path + top
            end = changed
            for a, b in path:
                end = H(a, end, b)
            out.append((i, own, below[s][0], root, H(*[a + b for a, b in path]), end, end == root))
    return out


def same(docs):
    key = lambda x: (x[0] is not None, x[0] or 0, x[1], x[4])
    got = sorted(map(tuple, M.merkle(docs).collect()), key=key)
    assert got == sorted(brute(docs.collect()), key=key)
    return got


def test_documents(documents):
    got = same(documents)
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    hurt = {i for i, t in texts.items() if t and "\n" in t and zlib.crc32(str(i).encode()) % 2 == 0}
    assert hurt and hurt == {r[0] for r in got if not r[-1]} and len({r[3] for r in got}) == 1


def test_odd_documents(odd_docs):
    got = same(odd_docs)
    assert [r[0] for r in got].count(2) == 2 and [r[0] for r in got].count(None) == 1


@pytest.mark.parametrize("n", [1, 3, 10])
def test_sizes(spark, n):
    rows = [(i, "x", "en", 1, f"t{i}\n") for i in range(n)] + [(99, None, None, None, None)]
    same(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_many_groups_and_a_hot_one_of_equal_rows(spark):
    rows = [(7, "hot", "en", 1, "same\n")] * 70 + [(i, f"s{i}", "en", 1, "é\n") for i in range(40)]
    same(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_empty(no_docs):
    assert M.merkle(no_docs).collect() == []


def test_string_ids(odd_docs):
    docs = odd_docs.drop("doc_id").withColumnRenamed("id", "doc_id")
    got = M.merkle(docs).collect()
    assert len(got) == docs.count() and len({r["root"] for r in got}) == 1


def test_store_is_one_folder_a_level(spark, documents, tmp_path):
    M.merkle(documents, folder=str(tmp_path / "m")).collect()
    levels = sorted(p.name for p in (tmp_path / "m" / "rows").iterdir())
    assert levels == [f"level={k}" for k in range(len(levels))] and len(levels) > 3
    sizes = [spark.read.parquet(str(tmp_path / "m" / "rows" / x)).count() for x in levels]
    assert all(a >= b for a, b in zip(sizes, sizes[1:])) and sizes[0] > 1.5 * sizes[1]
