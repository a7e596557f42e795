import re

import pytest

from lexquarry.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text, base=L.BASE):
    ws = plain_words(text)
    hits = [(i, label) for p, label in base.items() for i in range(len(ws)) if ws[i : i + len(p.split())] == p.split()]
    return len(ws), len(hits), min((i for i, _ in hits), default=None), max((i for i, _ in hits), default=None), ",".join(sorted({x for _, x in hits}))


def brute(texts):
    """Labels and best score by trying every template at every place where one of its anchors asks often enough."""
    found = L.templates()
    all_words = [plain_words(t) for t in texts]
    df = {w: sum(w in set(ws) for ws in all_words) for t in found for w in t.words}
    index, out = L.Index(found, len(texts), df), []
    for ws in all_words:
        labels, best = set(), 0.0
        for k, t in enumerate(index.templates):
            anchors = {w for w, ps in index.postings.items() if any(x == k for x, _ in ps)}
            at = lambda i: ws[i] if 0 <= i < len(ws) else None
            for p in range(-len(t.words), len(ws)):
                if sum(w in anchors and at(p + j) == w for j, w in enumerate(t.words)) >= index.agree[k] and all(p + a >= 0 and ws[p + a : p + a + len(x)] == x for a, x in t.phrases):
                    labels.add(t.label)
                    best = max(best, sum(at(p + j) == w for j, w in enumerate(t.words)) / len(t.words))
        out.append((",".join(sorted(labels)), best))
    return out


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    want = [(r["doc_id"], *brute_base(r["text"]), labels, score) for r, (labels, score) in zip(rows, brute([r["text"] for r in rows]))]
    got = [tuple(r)[:8] for r in L.scan_licenses(docs).collect()]
    key = lambda x: (x[0] is None, str(x[0]), x[1], str(x))
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_documents(documents):
    got = check(documents)
    assert {x for r in got for x in r[5].split(",") if x} >= {"apache", "cc-by", "mit"}
    assert any("apache-2.0" in r[6] for r in got) and any("cc-by-nc-4.0" in r[6] for r in got)


def test_odd_documents(odd_docs, no_docs):
    check(odd_docs)
    assert L.scan_licenses(no_docs).collect() == []


def test_places(spark):
    texts = [
        "MIT License MIT  LICENSE mit-license; mitlicense",
        "Cc-By cc by\x00cc_by éCC BY",
        "software is hereby granted. PERMISSION is hereby granted, free of charge, to any person; deal in the software without restriction",
        "the Free Software Foundation: this program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published",
        "may not use this file except in compliance with the License. You may",
        "gnu general gnu general public license license apache apache license",
        "cc", "by cc", "License mit", "GNU Lesser General Public License", "x " * 3000 + "apache license " * 400, None, "",
        "SPDX-License-Identifier: Apache-2.0", "SPDX-License-Identifier: MIT",
    ]
    got = check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    by = {r[0]: r for r in got}
    assert by[0][2] == 3 and by[1][2] == 3 and by[3][6] == "gpl" and by[4][6] == "apache-2.0" and by[9][6] == "lgpl" and by[10][2] == 400
    assert by[3][7] == 1.0 and by[8][7] == 0.0 and by[14][6] == "mit"


def test_places_are_given(spark):
    docs = spark.createDataFrame([(1, "a Apache License, Version 2.0")], "doc_id long, text string")
    r = L.scan_licenses(docs).first()
    assert {(p["label"], p["base"], p["word"]) for p in r["places"]} == {("apache", True, 1), ("apache-2.0", False, -2)}
    assert r["score"] == 1.0 and r["labels"] == "apache,apache-2.0"


def test_phrases_must_be_in_their_passage():
    with pytest.raises(ValueError):
        L.Template("x", "a b c", ("b d",), False)


def test_no_python_in_the_plan(documents):
    plan = L.scan_licenses(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
