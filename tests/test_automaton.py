"""The automaton against plain substring search, and its time against the number of names."""

import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexquarry.functions import automaton as A
from lexquarry.functions.tagging import KNOWN_NAMES, extract_entities


def plain(names, texts):
    names = list(dict.fromkeys(names))
    return [[] if t is None else [i for i, n in enumerate(names) if n.lower() in t] for t in texts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé🙂", max_size=4), max_size=12), st.lists(st.none() | st.text("abcé🙂 ", max_size=30), max_size=6))
def test_against_substrings(names, texts):
    assert A.Automaton(names).find(texts) == plain(names, texts)


def test_names_across_pieces(monkeypatch):
    monkeypatch.setattr(A, "WIDTH", 7)
    monkeypatch.setattr(A, "TOGETHER", 3)
    rng = random.Random(3)
    names = ["".join(rng.choices("ab", k=rng.randint(1, 9))) for _ in range(40)]
    texts = ["".join(rng.choices("abc", k=rng.randint(0, 80))) for _ in range(60)]
    assert A.Automaton(names).find(texts) == plain(names, texts)


def test_as_the_built_in_search(spark):
    texts = ["Saladin met BAYBARS and Umar II", "nobody", None, "", "x" * 5000 + "Hamza", "Muhammad al-Fatih, Mehmed II; al-ghazali"] * 2
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, content string")
    want = docs.select("id", extract_entities(F.col("content")).alias("figures"))
    got = A.tag_names(docs, KNOWN_NAMES)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert [r["figures"] for r in A.tag_names(docs, []).collect()] == [None] * 12


def test_time_is_flat_in_the_names(spark, sf_dir):
    texts = [r["text"].lower() for r in spark.read.parquet(f"{sf_dir}/documents.parquet").where("text is not null").limit(100).collect()]
    rng = random.Random(1)
    words = sorted({w for t in texts for w in re.findall(r"\w{5,}", t)})
    spent = {}
    for n in (100, 4000):
        own = A.Automaton([rng.choice(words) + rng.choice("qxz") + str(i) for i in range(n)])
        own.find(texts[:5])
        began = time.process_time()
        own.find(texts)
        spent[n] = time.process_time() - began
    assert spent[4000] < 4 * spent[100]  # 40 times the names
