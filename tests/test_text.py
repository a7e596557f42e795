import random
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexquarry.functions import tagging as G
from lexquarry.functions import text as T


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"t {kind}").select(f(F.col("t")).alias("x")).first()["x"]


def test_word_count_and_readability(spark):
    assert one(spark, "  a b\n c ", T.word_count) == 3
    assert one(spark, "", T.word_count) == 0
    assert one(spark, "", T.is_readable) is False
    assert one(spark, None, T.is_readable) is False
    assert one(spark, "ab12345678", T.is_readable) is False
    assert one(spark, "abcde12345", T.is_readable) is True
    assert one(spark, "", T.alpha_ratio) == 0.0


def test_normalize_whitespace(spark):
    assert one(spark, " a\n\n\n\nb \t  c  d ", T.normalize_whitespace) == "a\n\nb  c  d"


def test_clean_djvu_drops_pages_noise_and_glyphs(spark):
    text = "\n".join(["First line of real text here", "  12  ", "", "", "short", "xiv", "$$$$ %%%% 1234 5678 &&&&", "    an indented line of real text", "", "", "", "The last line of the real text"])
    got = one(spark, "\f" + text, T.clean_djvu)
    assert got == "First line of real text here\n\n  an indented line of real text\n\nThe last line of the real text"


def test_clean_pdf_strips_lines(spark):
    assert one(spark, "   A line that is long enough   \n42\n\n\n123456789012345678\n  Another long enough line ", T.clean_pdf) == "A line that is long enough\n\nAnother long enough line"


def test_repeated_headers_need_the_threshold(spark):
    header, body = "THE RUNNING HEADER OF PAGES", "\n".join(f"line number {i} of the text body" for i in range(3))
    text = "\n".join([header, body] * 30)
    assert one(spark, text, lambda c: T.repeated_lines(F.split(c, "\n"), 30)) and header not in one(spark, text, T.clean_djvu)
    text = "\n".join([header] * 29 + [body])
    assert one(spark, text, lambda c: T.repeated_lines(F.split(c, "\n"), 30)) == []


def test_strip_gutenberg(spark):
    assert one(spark, "licence\n*** START OF THIS\nbody\ntext\n*** END OF THIS\ntail", T.strip_gutenberg) == "body\ntext"
    assert one(spark, "licence\n***START OF THIS\nbody", T.strip_gutenberg) == "body"
    assert one(spark, "no line end *** START OF THIS", T.strip_gutenberg) == "no line end *** START OF THIS"
    assert one(spark, " plain ", T.strip_gutenberg) == "plain"


def test_clean_section(spark):
    text = "preface\niv\n12\n(3) a note\nCHAPTER one\n--- 5 ---\nbody"
    assert one(spark, text, lambda c: T.clean_section(c, "^CHAPTER")) == "CHAPTER one\nbody"


def restated(text, target, overlap, least):
    """The chunking rule, once more and plainly."""
    parts = [s.strip() for s in re.split(r"(?<=[.!?])\s+", text) if s.strip()]
    if len(parts) <= 3 and len(text.split()) > target:
        w = text.split()
        return [" ".join(w[i : i + target]) for i in range(0, len(w), target - overlap) if len(w[i : i + target]) >= least]
    n, out, now = (lambda x: len(x.split())), [], []
    for s in parts:
        now.append(s)
        if sum(map(n, now)) >= target:
            if n(" ".join(now)) >= least:
                out.append(" ".join(now))
            keep = next((k for k in range(len(now), -1, -1) if sum(map(n, now[len(now) - k :])) <= overlap), 0)
            now = now[len(now) - keep :] if keep else []
    return out + ([" ".join(now)] if now and n(" ".join(now)) >= least else [])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40), st.integers(5, 60), st.integers(0, 20), st.integers(0, 15))
def test_chunker_against_restatement(sizes, target, overlap, least):
    rng = random.Random(len(sizes))
    text = " ".join(" ".join("w" * rng.randint(1, 5) for _ in range(n)) + rng.choice(".!?") for n in sizes)
    overlap = min(overlap, target - 1)
    assert T.split_chunks(text, target, overlap, least) == restated(text, target, overlap, least)


def test_chunker_windows_for_few_sentences():
    words = [str(i) for i in range(1200)]
    got = T.split_chunks(" ".join(words))
    assert [c.split()[0] for c in got] == ["0", "450", "900"] and len(got[-1].split()) == 300


def test_chunk_overlap_and_floor(spark):
    text = " ".join("word " * 19 + "end." for _ in range(100))
    chunks = one(spark, text, T.chunk_sentences())
    assert all(len(c.split()) >= 100 for c in chunks)
    assert all(b.startswith(" ".join(a.split()[-40:])) for a, b in zip(chunks, chunks[1:]))


def test_entities(spark):
    assert one(spark, "The QUALITY of Saladin", G.extract_entities) == ["Ali", "Saladin"]
    assert one(spark, "The QUALITY of Saladin", lambda c: G.extract_entities(c, word_boundary=True)) == ["Saladin"]
    assert one(spark, "nothing", G.extract_entities) is None


def test_era_order(spark):
    assert one(spark, "Saladin met Mansa Musa", G.detect_era) == "africa"
    assert one(spark, "nothing", G.detect_era) is None


def test_grades(spark):
    assert one(spark, ["odd", "Da'if", "Sahih"], G.chain_strength_first, "array<string>") == "daif"
    assert one(spark, ["odd", "Da'if", "Sahih"], G.chain_strength_any, "array<string>") == "sahih"
    assert one(spark, [], G.chain_strength_first, "array<string>") == "unknown"


def test_personal_data(spark):
    for text in ("What did my grandfathers do?", "in my village there", "I am a teacher", "Zayd ibn Ali of our family", "call 0 123 456 789 1", "mail a.b@c.org now"):
        assert one(spark, text, G.pii_flag) is True, text
    assert one(spark, "Who ruled Cordoba in 929?", G.pii_flag) is False
    assert one(spark, None, G.pii_flag) is False


def test_query_hash_ignores_case_and_blanks(spark):
    assert one(spark, "  Who  ruled\n?", G.query_hash) == one(spark, "who ruled ?", G.query_hash)


def test_dates(spark):
    for text, year in (("839", 839), ("632-633", 632), ("-539", 539), ("53", None), (None, None), ("12345", 1234)):
        assert one(spark, text, G.date_ce_year) == year


def test_small_formats(spark):
    for n, s in ((999, "999"), (1000, "1K+"), (133789, "133K+"), (24_000_000, "24M+"), (1_250_000, "1.2M+")):
        assert one(spark, n, G.format_passages, "bigint") == s
    assert one(spark, "Al-Kamil fi al-Tarikh (vol. 1), the complete history", G.source_slug) == "al_kamil_fi_al_tarikh__vol__1___the_comp"
    assert [G.clamp_n(n) for n in (None, 0, -3, 7, 99)] == [5, 5, 1, 7, 20]
    assert one(spark, '<b data-stat="x">1</b>', lambda c: G.inject_stats(c, {"x": F.lit("$1\\")})) == '<b data-stat="x">$1\\</b>'


def test_strip_agrees_with_the_expression_on_every_character(spark):
    """All characters of the basic plane at both ends and inside, without an expression that tries each blank in between."""
    df = spark.range(1, 0x10000).where("id not between 55296 and 57343").selectExpr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE') AS c").select(F.concat("c", F.lit(" a"), "c", F.lit("\nb "), "c").alias("t"))
    assert df.where(T.strip(F.col("t")) != F.regexp_replace("t", r"(?U)^\s+|\s+$", "")).count() == 0
    assert df.where(F.length(T.strip(F.col("t"))) < 8).count() == 25
    assert "regexp" not in str(T.strip(F.col("t"))).lower()
    assert spark.range(3).select(F.when(F.col("id") == 0, " \n").when(F.col("id") == 1, "").alias("t")).select(T.strip(F.col("t"))).collect() == [("",), ("",), (None,)]


def test_chunker_holds_few_texts_at_a_time(spark):
    """A batch is passed on in slices; of nulls, empty texts and a last short slice there is one result each."""
    texts = [(i, None if i % 50 == 0 else "" if i % 50 == 1 else f"Word {i} and more. " * (i % 7 * 40)) for i in range(3 * T.SLICE + 5)]
    df = spark.createDataFrame(texts, "id int, t string").coalesce(1)
    got = {r["id"]: r["c"] for r in df.select("id", T.chunk_sentences()(F.col("t")).alias("c")).collect()}
    assert got == {i: T.split_chunks(t or "") for i, t in texts}
    sizes = [len(a) for a in T.chunk_sentences().func(iter([pa.array([t for _, t in texts])]))]
    assert max(sizes) == T.SLICE and sum(sizes) == len(texts)
