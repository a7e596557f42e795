"""The trigram index against LIKE on all texts."""

import random
import re

import pytest
from pyspark.sql import functions as F

from lexquarry.operators import substring as S


def like(pattern, text):
    out, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\":
            i += 1
            out += re.escape(pattern[i])
        else:
            out += ".*" if c == "%" else "." if c == "_" else re.escape(c)
        i += 1
    return re.fullmatch(out, text, re.S) is not None


@pytest.mark.parametrize(("block", "common"), [(3, S.COMMON), (512, 0.3), (512, 1.0)])
def test_against_like(spark, sf_dir, tmp_path, monkeypatch, block, common):
    monkeypatch.setattr(S, "COMMON", common)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").alias("id"), F.col("text").alias("content")).where("id < 120")
    odd = spark.createDataFrame([(1000, None), (1001, ""), (1002, "ab"), (1003, "100% A_B\\c"), (1004, "ÄÖÜ🙂x日本語"), (1005, "abcabc" * 10)], "id long, content string")
    docs = docs.unionByName(odd)
    rows = [(r["id"], r["content"]) for r in docs.collect()]
    rng = random.Random(1)
    text = next(t for _, t in rows if t and len(t) > 400)
    patterns = ["%the%", "%ab%", "%", "ab", "", "%100\\% a\\_b%", "%öü🙂X%", "%日本語", "abc%abc", "%bca%cab%", "%zzzz%", "%_____zz%", "%a_bc%"]
    patterns += ["%" + text[i : i + 9].replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%" for i in (rng.randrange(300) for _ in range(5))]
    S.write_trigrams(docs, str(tmp_path / "ix"), block=block)
    found, counts = S.matching(spark, str(tmp_path / "ix"), docs, spark.createDataFrame(list(enumerate(patterns)), "pattern_id int, pattern string"))
    got = sorted(map(tuple, found.collect()))
    assert got == sorted((k, i) for k, p in enumerate(patterns) for i, t in rows if t is not None and like(p.lower(), t.lower()))
    candidates = {r["pattern_id"]: r["candidates"] for r in counts.collect()}
    assert 10 not in candidates and 2 not in candidates  # none, and no trigram to look up
    assert all(candidates[k] < len(rows) / 2 for k in range(13, 18)) and candidates[8] >= 1


def test_long_texts_are_read_in_spans(monkeypatch):
    text = "".join(random.Random(2).choices("abcdé🙂", k=500))
    whole = S.text_trigrams(text).tolist()
    monkeypatch.setattr(S, "SPAN", 7)
    assert S.text_trigrams(text).tolist() == whole and len(whole) == len({text[i : i + 3] for i in range(498)})
    assert [len(S.text_trigrams(t)) for t in ("", "a", "ab", "abc")] == [0, 0, 0, 1]
