import random

from tokenizers import Tokenizer

from lexquarry.llm.token_counts import _LATIN, counter, prefix_counts, token_counts

BITS = ["'re", "'s", "'ll", "'ve", " ", "  ", "\n", "\t", "é", "ab", "the", "ing", " of", "!!", "<|endoftext|>", "<|end", "1", "22", "中", "文字", "😀", "\xa0", "'", "r", "\r\n", "ß", "x"]


def library(path, text):
    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


def test_fast_pattern_splits_as_the_library(bpe):
    c = counter(bpe)
    for code in range(0x250):
        text = f"a{chr(code)}a\n1{chr(code)}1\n {chr(code)}  {chr(code)}"
        assert _LATIN.findall(text) == c._classes(text)


def test_every_prefix_and_every_budget(bpe):
    rng, c, lib = random.Random(1), counter(bpe), Tokenizer.from_file(bpe)
    for _ in range(400):
        text = "".join(rng.choice(BITS) for _ in range(rng.randint(0, 12)))
        want = [len(lib.encode(text[:p], add_special_tokens=False).ids) for p in range(len(text) + 1)]
        assert c.prefixes(text) == want and c.count(text) == want[-1]
        for limit in (0, 1, 3, 5):
            assert c.truncate(text, limit) == max(p for p, n in enumerate(want) if n <= limit)


def test_documents_against_the_library(spark, documents, bpe):
    lib = Tokenizer.from_file(bpe)
    texts = {r["doc_id"]: r["text"] for r in documents.select("doc_id", "text").collect()}
    rows = token_counts(documents.coalesce(1), bpe).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        n = len(lib.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(texts[r["doc_id"]].encode()), n > 1024)
        assert r["limit_chars"] == len(texts[r["doc_id"]]) or n > 1024


def test_odd_rows(spark, odd_docs, no_docs, bpe):
    rows = token_counts(odd_docs, bpe).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 10 and by[4]["n_tokens"] == by[3]["n_tokens"] == by[4]["n_bytes"] == 0
    assert by[6]["n_tokens"] == library(bpe, "long " * 30_000 + "end") and by[6]["over_limit"]
    assert token_counts(no_docs, bpe).count() == 0
    assert {r["doc_id"]: r["counts"] for r in prefix_counts(odd_docs.where("doc_id in (3, 4, 8)"), bpe).collect()}[3] == [0]
