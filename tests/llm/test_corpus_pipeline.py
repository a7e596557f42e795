import numpy as np
import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from lexquarry.llm.exact_dedup import exact_dedup  # noqa: E402
from lexquarry.llm.kn_quality import quality  # noqa: E402
from lexquarry.llm.mixing import mix  # noqa: E402
from lexquarry.llm.simhash_golay import simhash_golay  # noqa: E402


@pytest.fixture(scope="module")
def steps(spark, documents, sf_dir, tmp_path_factory):
    folder, docs, out = tmp_path_factory.mktemp("steps"), documents, [documents]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        out.append(docs)
    return out


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_columns_stay(steps):
    for docs in steps[1:-1]:
        assert docs.columns == steps[0].columns


def test_each_stage_does_what_its_operator_says(spark, steps, sf_dir):
    raw, good, single, distinct, mixed, coded = steps
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    assert ids(good) == ids(quality(raw, labels).where("kept"))
    assert ids(single) == ids(exact_dedup(good).where("kept"))
    assert ids(distinct) == ids(simhash_golay(single).where("doc_id = component_id"))
    copies = {r["doc_id"]: r["copies"] for r in mix(distinct).collect()}
    assert ids(mixed) == sorted(i for i, n in copies.items() for _ in range(n))
    assert ids(coded) == ids(mixed) and coded.where("not round_trip").isEmpty()


def test_run_is_the_stages_in_order(spark, steps, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    key = lambda r: (r["doc_id"], r["ids"])
    assert sorted(map(key, out.collect())) == sorted(map(key, steps[-1].collect()))


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs, sf_dir):
    for docs in (odd_docs, no_docs):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns
            out.count()
    assert corpus_pipeline.exact_stage(spark, odd_docs, sf_dir).where("doc_id = 2 or doc_id is null").isEmpty()


def test_repeated_rows_leave_one(spark, sf_dir):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (2, "f g h i j k")], "doc_id long, text string")
    assert ids(corpus_pipeline.exact_stage(spark, docs, sf_dir)) == [1, 2]


def test_copies_go_and_clean_text_stays(spark, sf_dir):
    rng = np.random.default_rng(0)
    texts = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega", "sigma"], 80)) for _ in range(40)]
    rows = [(i, t, "en", f"s{i % 4}") for i, t in enumerate(texts)] + [(100 + i, t.replace(" ", " \n"), "en", "s1") for i, t in enumerate(texts[:10])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    assert ids(corpus_pipeline.exact_stage(spark, docs, sf_dir)) == list(range(40))


def test_decisions_hold_for_rows_not_ids(spark, sf_dir, tmp_path):
    """Null and repeated ids: only the rejected row or copy goes, not what shares its id."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(400)]
    a, b, c, d = [" ".join(rng.choice(words, 200)) for _ in range(4)]
    schema = "doc_id long, text string, lang string, source string"
    texts = lambda df: sorted(r["text"] for r in df.collect())
    row = lambda i, t: (i, t, "en", "s")
    copies = spark.createDataFrame([row(1, a), row(None, a), row(None, b), row(2, c), row(2, d), row(3, d), row(None, b)], schema)
    assert texts(corpus_pipeline.exact_stage(spark, copies, sf_dir)) == sorted([a, b, c, d])
    near = lambda t: t + " w7"
    rows = [row(1, a), row(None, near(a)), row(None, b), row(None, near(b)), row(2, c), row(2, d), row(1, near(d)), row(4, a)]
    left = texts(corpus_pipeline.near_stage(spark, spark.createDataFrame(rows, schema), sf_dir))
    assert len(left) == 4 and [sum(t in (x, near(x)) for t in left) for x in (a, b, c, d)] == [1, 1, 1, 1]
    clean = lambda: " ".join(rng.choice(words, 60))
    noise = " ".join(f"zz{i}" for i in range(60))
    rows = [row(i, clean()) for i in range(1000)] + [row(None, a), row(None, noise), row(2000, b), row(2000, noise)]
    spark.createDataFrame([(i, 1, 0) for i in range(1000)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left = texts(corpus_pipeline.quality_stage(spark, spark.createDataFrame(rows, schema), str(tmp_path)))
    assert a in left and b in left and noise not in left


def test_other_columns_of_any_name(spark, odd_docs, sf_dir):
    """Names that the stages or their operators use themselves, with repeated rows."""
    names = ["_sha", "_copy", "_copies", "_gone", "_id", "_key", "_of", "_rows", "_again", "key", "copies", "kept", "first", "same", "uid", "size", "rows"]
    docs = odd_docs.drop("id", "digest").select("*", *[F.concat(F.lit(f"{n} "), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        for r in out.where("doc_id is not null").collect():
            assert all(r[n] == f"{n} {r['doc_id']}" for n in names)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()


def test_mixing_decides_by_row(spark, sf_dir):
    """Null and repeated ids: as many rows as the operator takes copies, each with its own text."""
    rows = [(None if i % 5 == 0 else i % 7, "w " * (1 + i % 11) + str(i // 2), "en", f"s{i % 3}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = corpus_pipeline.mixing_stage(spark, docs, sf_dir).collect()
    words = {}
    for r in out:
        words[r["source"]] = words.get(r["source"], 0) + len(r["text"].split())
    for r in mix(docs.withColumn("n", F.monotonically_increasing_id()), id_col="n").join(docs.withColumn("n", F.monotonically_increasing_id()), "n").select("source", "target").distinct().collect():
        assert abs(words[r["source"]] - r["target"]) <= 12
    assert {tuple(r) for r in out} <= set(map(tuple, docs.collect()))


@pytest.mark.parametrize("kind", ["string", "decimal(12,2)"])
def test_ids_of_other_types(spark, documents, sf_dir, tmp_path, kind):
    """String and decimal ids pass every stage and keep their type; each text stays once."""
    docs = documents.where("doc_id % 3 = 0")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    labels.withColumn("doc_id", F.col("doc_id").cast(kind)).write.parquet(f"{tmp_path}/labels.parquet")
    cast = docs.withColumn("doc_id", F.col("doc_id").cast(kind))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        cast = stage(spark, cast, str(tmp_path))
        assert cast.columns == docs.columns and dict(cast.dtypes)["doc_id"] == kind, name
        cast.write.parquet(f"{tmp_path}/{name}")
        cast = spark.read.parquet(f"{tmp_path}/{name}")
    assert 0 < cast.count() and cast.join(docs, "text", "left_anti").isEmpty()
    once = spark.read.parquet(f"{tmp_path}/exact_dedup")
    assert once.count() == once.select("text").distinct().count()


def plain_fingerprint(text):
    """64 majority bits of the hashes of four-word shingles, in plain Python."""
    import re

    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_planted_copies_against_a_plain_pipeline(spark, sf_dir):
    """Exact and near stages in a row, against loops over all pairs that share no code with the operators."""
    import re

    rng = np.random.default_rng(8)
    words = [f"v{i}" for i in range(900)]
    clean = [" ".join(rng.choice(words, 260)) for _ in range(60)]
    texts = clean + [t.replace(" ", "\t ", 3) for t in clean[:15]] + [t + " v1" for t in clean[10:30]] + ["V7 " + t for t in clean[20:40]] + [None, "", " \n", "one two"]
    order = rng.permutation(len(texts))
    rows = [(int(i), texts[i], "en", f"s{i % 4}") for i in order]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    first = {}
    for i, t in sorted((r[0], r[1]) for r in rows):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    single = corpus_pipeline.exact_stage(spark, docs, sf_dir)
    assert ids(single) == sorted(first.values())
    prints = {i: plain_fingerprint(texts[i] or "") for i in first.values()}
    root = {i: i for i in prints}
    for _ in prints:
        for i in prints:
            root[i] = min(root[j] for j in prints if bin(prints[i] ^ prints[j]).count("1") <= 4)
    want = sorted({root[i] for i in prints})
    assert ids(corpus_pipeline.near_stage(spark, single, sf_dir)) == want
    assert set(range(60)) <= set(want) and len(want) < len(prints)
