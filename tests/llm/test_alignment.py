import hashlib
import random
from collections import Counter

import pytest

from lexquarry.llm import alignment as A


@pytest.fixture(scope="module")
def both(bpe, pieces):
    return A.Aligner(bpe, pieces)


def plain(both, text):
    """(A ids, B ids, groups) of a whole text, groups by sets of ends; None if it has no tokens."""
    if not text:
        return None
    a, b, raw = both.a.encode(" " + text, add_special_tokens=False).ids, both.b.encode(text), (" " + text).encode()
    ba, bb = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
    if b"".join(ba) != raw or b"".join(bb) != raw:
        return None

    def ends(tokens):
        at, out = 0, []
        for t in tokens:
            at += len(t)
            out.append(at)
        return out

    ea, eb = ends(ba), ends(bb)
    cuts, groups, i, j = sorted(set(ea) & set(eb)), [], 0, 0
    for cut in cuts:
        k, m = ea.index(cut, i) + 1, eb.index(cut, j) + 1
        groups.append((a[i:k], b[j:m]))
        i, j = k, m
    return a, b, groups


def brute(both, rows):
    found = [plain(both, t) for _, t in rows]
    links = Counter((x[-1], y[-1]) for f in found if f for x, y in f[2])
    most = {}
    for (_, y), n in links.items():
        most[y] = max(most.get(y, 0), n)
    out = []
    for (i, _), f in zip(rows, found):
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        own = [(x[-1], y[-1]) for x, y in f[2]]
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in f[2])
        out.append((i, len(f[0]), len(f[1]), len(own), len(own), sum(links[p] == most[p[1]] for p in own), sum(links[p] for p in own), hashlib.sha256(said.encode()).hexdigest()))
    return out


def check(docs, both, bpe, pieces):
    key = lambda x: (x[0] is None, x[0] or 0, x)
    got = sorted((tuple(r) for r in A.align(docs, bpe, pieces).collect()), key=key)
    assert got == sorted(brute(both, [(r["doc_id"], r["text"]) for r in docs.collect()]), key=key)
    return got


def test_documents(documents, both, bpe, pieces):
    got = check(documents, both, bpe, pieces)
    assert sum(r[4] for r in got) > sum(r[5] for r in got) > 0


def test_odd_documents(odd_docs, no_docs, both, bpe, pieces):
    check(odd_docs, both, bpe, pieces)
    assert A.align(no_docs, bpe, pieces).collect() == []


TEXTS = [
    " ", "  ", "a  b", " a", "a ", "\na b\n\nc  d", "a▁b c", "▁", "a ▁b", "x <|endoftext|> y </s> <s> <0x41>", "don't we'll I'M", "１２ ③  x y 　 z",
    "\x00 \x1c \x85 a", "​﻿ ­", "日本語 の テキスト です。", "🙂 🙂🙂 👩‍👩‍👧 é", "é ́ x", "word " * 2000 + "end", "a" * 5000, "tab\tx \t y", "ﬁ Ǆ ß ẞ İ", "\r\n\r\n x",
]


def test_odd_texts(spark, both, bpe, pieces):
    docs = spark.createDataFrame(list(enumerate(TEXTS * 2)), "doc_id long, text string")
    got = check(docs, both, bpe, pieces)
    assert all(r[1] == 0 for r in got if A._MARK in (TEXTS * 2)[r[0]]) and sum(r[1] == 0 for r in got) == 6


def test_parts_are_cut_where_whole_texts_are(both):
    rng = random.Random(5)
    bits = ["a", "the", "Zug", "é", " ", "  ", "\n", "\t", ",", "'s", "'", "12", "۵", " ", "▁", "日", "🙂", ".", "-", "_", "\x00", "　", "́", "</s>"]
    for _ in range(2000):
        text = "".join(rng.choice(bits) + rng.choice(["", "", " "]) for _ in range(rng.randint(1, 12)))
        (got, *_), want = both.batch([text])[0][0], plain(both, text)
        docs, links, linked = both.batch([text])
        if want is None:
            assert docs[0][:4] == (0, 0, 0, "")
            continue
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in want[2])
        assert docs[0][:4] == (len(want[0]), len(want[1]), len(want[2]), hashlib.sha256(said.encode()).hexdigest()), repr(text)
        assert got == len(want[0]) and links.sum() == len(linked)


def test_small_batches_and_memo_change_nothing(documents, both, bpe, pieces, monkeypatch):
    rows = [(r["doc_id"], r["text"]) for r in documents.limit(60).collect()]
    own = A.Aligner(bpe, pieces)
    monkeypatch.setattr(A, "MEMO", 50)
    monkeypatch.setattr(A, "CALL_CHARS", 100)
    for i, text in rows:
        want = brute(both, [(i, text)])[0]
        assert own.batch([text])[0][0][:4] == (want[1], want[2], want[3], want[7])
    assert [(a, b) for a, b in A._slices([3, 4_000_000, 1, 1])] == [(0, 1), (1, 2), (2, 4)]
