import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexquarry.llm import kn_quality as K

LABELS = "doc_id long, quality int, toxic int"


def test_packing():
    rng = np.random.default_rng(0)
    for x in (np.zeros(0, np.int64), np.array([5]), np.sort(rng.integers(0, 1 << 45, 1000)), rng.integers(0, 100, 1000), np.array([1 << 62, 0, -(1 << 62)])):
        assert (K.unpack(K.pack(x)) == x).all()


def test_distinct_values():
    for x in (np.zeros(0, np.int64), np.array([7]), np.random.default_rng(1).integers(-50, 50, 1000)):
        at, back = K.distinct(x)
        assert (x[at] == np.unique(x)).all() and (x[at][back] == x).all()


def test_frequent_middle_words_are_spread_and_found_again():
    share = np.full(1000, 1e-4)
    share[7] = 0.5
    s = K.Shards(20, share)
    keys = np.array([7 << 30 | left << 15 | 3 for left in range(200)])
    at, to = s.all_of(np.array([7, 8]))
    assert set(s.of(keys)) <= set(to[at == 0]) and len(set(s.of(keys))) > 10 and (at == 1).sum() == 1


def plain_model(sequences, size):
    """Interpolated modified Kneser-Ney by dictionaries."""
    tri, bi, uni = Counter(), Counter(), Counter()
    for w in sequences:
        p = [0, 0, *w]
        tri.update(zip(p, p[1:], p[2:]))
    bi.update((b, c) for _, b, c in tri)
    uni.update(c for _, c in bi)
    d = [K.discounts([sum(v == i for v in t.values()) for i in (1, 2, 3, 4)]) for t in (uni, bi, tri)]
    minus = lambda n, ds: ds[min(n, 3) - 1]
    under2, under3 = defaultdict(list), defaultdict(list)
    for (b, c), n in bi.items():
        under2[b].append(n)
    for (a, b, c), n in tri.items():
        under3[a, b].append(n)
    total1 = sum(uni.values())
    rest1 = 1 - sum(n - minus(n, d[0]) for n in uni.values()) / total1

    def p1(c):
        return (uni[c] - minus(uni[c], d[0]) if uni[c] else 0) / total1 + rest1 / size

    def p2(b, c):
        if b not in under2:
            return p1(c)
        t = sum(under2[b])
        return ((bi[b, c] - minus(bi[b, c], d[1])) if bi[b, c] else 0) / t + sum(minus(n, d[1]) for n in under2[b]) / t * p1(c)

    def p3(a, b, c):
        if (a, b) not in under3:
            return p2(b, c)
        t = sum(under3[a, b])
        return ((tri[a, b, c] - minus(tri[a, b, c], d[2])) if tri[a, b, c] else 0) / t + sum(minus(n, d[2]) for n in under3[a, b]) / t * p2(b, c)

    return p3


def plain_held(docs, labels):
    """(ids that are trusted, ids that are held out)."""
    good = {r["doc_id"] for r in labels.collect()} - {r["doc_id"] for r in labels.where("quality = 0 or toxic = 1").collect()}
    rows = [r for r in docs.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)).alias("h")).collect() if r["doc_id"] in good]
    of = Counter(r["lang"] for r in rows)
    share = {k: max(K.HELD, min(K.HELD_DOCS / n, K.HELD_MOST)) for k, n in of.items()}
    return good, {r["doc_id"] for r in rows if r["h"] < int(share[r["lang"]] * (1 << 20))}


def plain_perplexities(docs, labels):
    good, held = plain_held(docs, labels)
    rows = docs.select("doc_id", "text").collect()
    trained = [r["text"] or "" for r in rows if r["doc_id"] in good and r["doc_id"] not in held]
    counts = Counter(w for t in trained for w in K._TOKEN.findall(t))
    words = [w for w, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: K.VOCABULARY]]
    ids = {w: i for i, w in enumerate(words, K._FIRST)}
    code = lambda t: [ids.get(w) or K.word_class(w) for w in K._TOKEN.findall(t or "")]
    p = plain_model([code(t) for t in trained], K._FIRST + len(words))
    out = {}
    for r in rows:
        w = [0, 0, *code(r["text"])]
        n = len(w) - 2
        out[r["doc_id"]] = (n, math.exp(-sum(math.log(p(*w[i : i + 3])) for i in range(n)) / n) if n else None)
    return out


@pytest.mark.parametrize("vocabulary, batch, bytes_, segments", [(16_000, 1_000_000, 1 << 29, 512), (300, 3_000, 1 << 12, 512), (300, 3_000, 1 << 29, 0)])
def test_perplexities_against_dictionaries(spark, documents, sf_dir, monkeypatch, vocabulary, batch, bytes_, segments):
    """With many listed words and few, copies of shards, and a filter that is full."""
    monkeypatch.setattr(K, "VOCABULARY", vocabulary)
    monkeypatch.setattr(K, "BATCH_TOKENS", batch)
    monkeypatch.setattr(K, "SALT_BYTES", bytes_)
    if not segments:
        monkeypatch.setattr(K, "filter_of", lambda numbers, count: K.Filter(np.full((1, K.SEGMENT_BITS // 8), 255, np.uint8)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    got = {r["doc_id"]: (r["n_tokens"], r["perplexity"]) for r in K.quality(documents, labels).collect()}
    want = plain_perplexities(documents, labels)
    assert set(got) == set(want)
    for i, (n, p) in want.items():
        assert got[i][0] == n and (got[i][1] == pytest.approx(p, rel=1e-5) if n else got[i][1] is None)


def plain_thresholds(rows, held, q):
    """{id: threshold} of rows (id, lang, n, perplexity), by sorted lists."""
    top = lambda x: sorted(x)[math.ceil(q * len(x)) - 1]
    middle = lambda x: sorted(x)[math.ceil(len(x) / 2) - 1]
    length = lambda n: sum(n >= a for a in K.LENGTHS)
    wide = lambda n: math.sqrt(min(n, K.LENGTHS[1]) / K.LENGTHS[1])
    sure = [r for r in rows if r[0] in held and r[2]]
    cells, langs = defaultdict(list), defaultdict(list)
    for _, lang, n, p in sure:
        cells[lang, length(n)].append(p)
        langs[lang].append((math.log(p), wide(n)))
    median = {k: middle([x for x, _ in v]) for k, v in langs.items()}
    far = {k: [(x - median[k]) * w for x, w in v] for k, v in langs.items()}
    every = [x for v in far.values() for x in v]
    logs = [(math.log(p), wide(n)) for _, _, n, p in sure]
    out = {}
    for i, lang, n, _ in rows:
        if len(cells.get((lang, length(n)), ())) >= K.LEAST_HELD:
            out[i] = top(cells[lang, length(n)])
        elif not n or len(sure) < K.LEAST_HELD:
            out[i] = None
        elif lang in median:
            out[i] = math.exp(median[lang] + top(far[lang] if len(far[lang]) >= K.LEAST_HELD else every) / wide(n))
        else:
            m = middle([x for x, _ in logs])
            out[i] = math.exp(m + top([(x - m) * w for x, w in logs]) / wide(n))
    return out


@pytest.mark.parametrize("least, quantile", [(40, 0.999), (3, 0.9), (1000, 0.9)])
def test_thresholds_against_sorted_lists(spark, documents, sf_dir, monkeypatch, least, quantile):
    monkeypatch.setattr(K, "LEAST_HELD", least)
    docs = documents.withColumn("lang", F.when(F.col("doc_id") % 17 == 0, None).when(F.col("doc_id") % 19 == 0, "rare").otherwise(F.col("lang")))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("doc_id % 19 <> 0")
    got = {r["doc_id"]: r for r in K.quality(docs, labels, quantile).collect()}
    want = plain_thresholds([(i, r["lang"], r["n_tokens"], r["perplexity"]) for i, r in got.items()], plain_held(docs, labels)[1], quantile)
    for i, r in got.items():
        assert r["threshold"] == (want[i] if want[i] is None else pytest.approx(want[i], rel=1e-8))
        assert r["kept"] == (want[i] is None or r["perplexity"] is None or r["perplexity"] <= want[i] * (1 + 1e-9))
    assert sum(not r["kept"] for r in got.values()) > (0 if least == 3 else -1)


def test_the_filter_knows_its_words():
    rng = np.random.default_rng(3)
    x = np.unique(rng.integers(K._RARE + 1, K._RARE + (1 << 31), 60_000))
    one, other = x[::2], x[1::2]
    at = (K.Filter.hashed(one) & np.uint64(0xFFFF)).astype(int) % 2
    f = K.Filter(np.stack([K.Filter.segment(one[at == i]) for i in (0, 1)]))
    assert f.has(one).all() and f.has(other).mean() < 0.05


@pytest.mark.parametrize("kind", ["smallint", "decimal(12,2)", "string", "double"])
def test_ids_of_any_type(spark, kind):
    docs = spark.createDataFrame([(i, f"some words of text {i % 3}", "en") for i in range(60)], "doc_id int, text string, lang string").withColumn("doc_id", F.col("doc_id").cast(kind))
    labels = spark.range(60).select(F.col("id").cast(kind).alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    out = K.quality(docs, labels)
    assert dict(out.dtypes)["doc_id"] == kind and out.count() == 60


def test_most_frequent_words(spark):
    rows = [(f"w{i}", n) for i, n in enumerate([9, 9, 8, 5, 4, 4, 3, 2, 1, 1])]
    df = spark.createDataFrame(rows, "w string, n long")
    for k in (1, 2, 4, 6, 20):
        want = [w for w, _ in sorted(rows, key=lambda x: (-x[1], x[0]))[:k]]
        assert [r["w"] for r in K._most_frequent(df, k).collect()] == want


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    keys, counts = np.unique(rng.integers(0, 6, 400) << 15 | rng.integers(0, 20, 400), return_counts=True)
    d = K.discounts([(counts == i).sum() for i in (1, 2, 3, 4)])
    base = K.unigrams(np.bincount(keys & 0x7FFF, minlength=25), np.array([0.5, 0.9, 1.2]))
    level = K.Level(keys, counts, d)
    for context in (0, 3, 9):
        p = level.mix(np.array([context << 15 | w for w in range(25)]), base)
        assert p.sum() == pytest.approx(1) and (p > 0).all()


def test_held_out_accuracy(spark):
    """Junk of another make is rejected, unseen clean text of the same make stays."""
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 6))) for _ in range(300)]
    clean = lambda: " ".join(rng.choice(words, 60, p=np.arange(300, 0, -1) / 45150)) + "."
    junk = lambda: " ".join(w + "***" for w in rng.choice(words, 60)).upper()
    rows = [(i, clean() if i % 5 else junk(), "en" if i % 2 else None, "x") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, perplexity string")
    labels = spark.createDataFrame([(i, int(i % 5 > 0), 0) for i in range(0, 1500, 2)] + [(2, 1, 0)], LABELS)
    out = K.quality(docs, labels).collect()
    assert sum(r["kept"] for r in out if r["doc_id"] % 5 == 0) == 0
    assert sum(not r["kept"] for r in out if r["doc_id"] % 5) <= 12


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (6, 1, 0), (5, 1, 1), (8, None, None)], LABELS)
    out = K.quality(odd_docs, labels).collect()
    assert len(out) == 10 and all(r["kept"] for r in out) and {r["n_tokens"] for r in out if r["doc_id"] in (3, 4, 7)} == {0}
    assert K.quality(no_docs, labels).count() == 0
    none = K.quality(odd_docs, labels.where("quality = 0"))
    assert none.count() == 10 and none.where("not kept").isEmpty()


def test_random_letters_are_rejected(spark):
    """Unknown words in a row are no likelier for it, though half of the trusted words aren't listed either."""
    rng = np.random.default_rng(5)
    letters = list("abcdefghijklmnopqrstuvwxyz")
    words = ["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(60_000)]
    clean = lambda: " ".join(words[int(len(words) ** x) - 1] for x in rng.random(200))
    noise = lambda: " ".join("".join(rng.choice(letters, 7)) for _ in range(200))
    rows = [(i, noise() if i % 20 == 1 else clean(), "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 2000, 2)], LABELS)
    out = K.quality(docs, labels).collect()
    assert not any(r["kept"] for r in out if r["doc_id"] % 20 == 1)
    assert sum(not r["kept"] for r in out if r["doc_id"] % 20 != 1) <= 40


def test_a_language_with_little_held_out_text_has_its_own_threshold(spark):
    """Text far from its language goes, though it is as likely as the many texts of another; short text too."""
    rng = np.random.default_rng(6)
    rich, poor = [[f"{c}{i}" for i in range(n)] for c, n in (("a", 3000), ("b", 40))]
    text = lambda words, n: " ".join(rng.choice(words, n))
    rows = [(i, text(rich, 60), "en") for i in range(1500)] + [(2000 + i, text(poor, 60), "xx") for i in range(200)]
    rows += [(3000 + i, text(rich, 60 if i % 2 else 15), "xx") for i in range(20)] + [(4000 + i, text(poor, 60), "xx") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i, *_ in rows if i < 3000], LABELS)
    kept = {r["doc_id"] for r in K.quality(docs, labels).where("kept").collect()}
    assert not kept & set(range(3000, 3020)) and set(range(4000, 4020)) <= kept
    assert len(kept & set(range(1500))) >= 1490


def test_what_a_turn_shuffled_is_gone_when_the_next_begins(spark, monkeypatch):
    """One turn's trigrams at a time are on disk; at the end no table is left in the shared folder, and turns change no result."""
    import os
    import time

    from lexquarry.llm._util import shared_folder

    rng = np.random.default_rng(7)
    docs = spark.createDataFrame([(i, " ".join(f"w{x}" for x in rng.integers(0, 3000, 200)), "en") for i in range(400)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 400, 2)], LABELS)
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    shuffled = lambda: {x for x in files.getAllFiles().mkString(",").split(",") if "/shuffle_" in x and x.endswith(".data")}
    before, left, turns, score = shuffled(), [], [], K.score

    def watched(*args):
        for _ in range(100):  # files are deleted in the background
            if not (now := shuffled() - before):
                break
            time.sleep(0.1)
        left.append(now)
        turns.append(args[0])
        return score(*args)

    monkeypatch.setattr(K, "score", watched)
    setting = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    got = {r["doc_id"]: r["perplexity"] for r in K.quality(docs, labels).collect()}
    assert len(turns) == K.TURNS > 1 and sum(t.count() for t in turns) == 400
    assert left == [set()] * K.TURNS
    assert not [x for x in os.listdir(shared_folder(spark).removeprefix("file:")) if x.startswith("kept-")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == setting
    monkeypatch.setattr(K, "TURNS", 1)
    once = {r["doc_id"]: r["perplexity"] for r in K.quality(docs, labels).collect()}
    assert got == pytest.approx(once, rel=1e-6)
