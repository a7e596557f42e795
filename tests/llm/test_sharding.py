import math
import zlib

from pyspark.sql import functions as F

from lexquarry.llm import sharding


def check(docs, shards=16):
    rows, out = docs.collect(), sharding.kd_shards(docs, shards).collect()
    want = sorted((str(r["doc_id"]), len((r["text"] or "").encode()) + 1, zlib.crc32((r["text"] or "").encode())) for r in rows)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in out) == want
    slots, bytes_ = {}, {}
    for r in out:
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        slots.setdefault(r["shard"], []).append(r["slot"])
        bytes_[r["shard"]] = bytes_.get(r["shard"], 0) + r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return out, bytes_


def test_documents(documents):
    out, bytes_ = check(documents)
    leaf = sum(bytes_.values()) / 16
    light = max(r["size"] for r in out if r["size"] <= leaf / sharding.PIECE)
    assert max(bytes_.values()) - min(bytes_.values()) <= 2 * light + max(0, max(r["size"] for r in out) - leaf)
    of = {}
    for r in out:
        of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def plain_tree(docs, shards):
    """Shards by a k-d tree of sorted lists, for tables without heavy groups."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "source", "lang", (F.octet_length(text) + 1).alias("w"), F.xxhash64(text).alias("g"), F.pmod(F.xxhash64(F.xxhash64(text), F.lit(7)), F.lit(1 << 32)).alias("tie")).collect()
    rank = [{v: float(i) for i, v in enumerate(sorted({r[c] for r in rows}, key=lambda x: (x is not None, (x or "").encode())))} for c in ("source", "lang")]
    own = {r["doc_id"]: (rank[0][r["source"]], rank[1][r["lang"]], math.log2(r["w"])) for r in rows}
    least = {}
    for r in rows:
        least[r["g"]] = tuple(map(min, least.get(r["g"], own[r["doc_id"]]), own[r["doc_id"]]))
    ends = [(min(v[d] for v in own.values()), max(v[d] for v in own.values())) for d in range(3)]
    scale = lambda x, lo, hi: math.floor((x - lo) / max(hi - lo, 1e-9) * ((1 << 30) - 1)) << 32
    points = [([scale(least[r["g"]][d], *ends[d]) + r["tie"] for d in range(3)], r["w"], r["doc_id"]) for r in rows]
    out = {}

    def cut(points, first, k):
        if k == 1:
            out.update({i: first for *_, i in points})
            return
        dim = max(range(3), key=lambda d: max(p[0][d] >> 32 for p in points) - min(p[0][d] >> 32 for p in points))
        want, below, at = sum(w for _, w, _ in points) * (k // 2) / k, 0, {}
        for v, w, _ in points:
            at[v[dim]] = at.get(v[dim], 0) + w
        for v in sorted(at):
            if below + at[v] >= want:
                break
            below += at[v]
        place = v if want - below <= below + at[v] - want else v + 1
        cut([p for p in points if p[0][dim] < place], first, k // 2)
        cut([p for p in points if p[0][dim] >= place], first + k // 2, k - k // 2)

    cut(points, 0, shards)
    return out


def test_cuts_against_sorted_lists(spark, documents, monkeypatch):
    monkeypatch.setattr(sharding, "NEAR", 0.0)
    monkeypatch.setattr(sharding, "PIECE", 0.01)  # no group is heavy
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 9 > 0, F.concat(F.lit("https://example.org/"), "source")))
    for shards in (4, 7):
        got = {r["doc_id"]: r["shard"] for r in sharding.kd_shards(docs, shards).collect()}
        assert got == plain_tree(docs, shards)


def test_sources_with_a_common_prefix_are_apart(spark):
    docs = spark.createDataFrame([(i, f"text {i:04d}", f"https://host-{i % 8}.example", "en") for i in range(800)], "doc_id long, text string, source string, lang string")
    of = {}
    for r in sharding.kd_shards(docs, 8).collect():
        of.setdefault(r["shard"], set()).add(r["doc_id"] % 8)
    assert all(len(s) == 1 for s in of.values()) and len(of) == 8


def test_heavy_groups_stay_whole_and_shards_even(spark):
    """Groups of up to a whole shard; only one that fits nowhere is split."""
    rows = [f"group {i}" + "x" * 90 for i in range(20) for _ in range(60 + 20 * i)] + [f"text {i:05d}" + "y" * 40 for i in range(4000)]
    docs = spark.createDataFrame([(i, t, f"s{i % 5}", "en") for i, t in enumerate(rows)], "doc_id long, text string, source string, lang string")
    out, bytes_ = check(docs)
    leaf = sum(bytes_.values()) / 16
    assert max(bytes_.values()) < 1.02 * leaf and min(bytes_.values()) > 0.98 * leaf
    of = {}
    for r in out:
        of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def test_even_rows_give_even_shards_and_groups_stay_whole(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2:05d} " + "x" * (i // 2 % 40), f"s{i % 5}", "en") for i in range(4000)], "doc_id long, text string, source string, lang string")
    out, bytes_ = check(docs)
    leaf = sum(bytes_.values()) / 16
    assert len(bytes_) == 16 and max(bytes_.values()) < 1.03 * leaf and min(bytes_.values()) > 0.97 * leaf
    of = {}
    for r in out:
        of.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in of.values())


def test_hot_group_is_split(spark):
    docs = spark.createDataFrame([(i, "the same" if i % 3 == 0 else f"no {i}", "s", "en") for i in range(3000)], "doc_id long, text string, source string, lang string")
    _, bytes_ = check(docs)
    leaf = sum(bytes_.values()) / 16
    assert len(bytes_) == 16 and max(bytes_.values()) < 1.05 * leaf


def test_other_numbers_of_shards(documents):
    for n in (1, 3, 7):
        _, bytes_ = check(documents, n)
        assert len(bytes_) == n


def test_odd_rows(spark, odd_docs, no_docs):
    check(odd_docs)
    names = spark.createDataFrame([(i, f"t{i}", "s", "en", 1, 2, 3, 4, 5, 6, 7, 8, 9) for i in range(40)], "doc_id long, text string, source string, lang string, id int, g int, w int, n int, size int, _block int, shard int, uid int, d0 int")
    check(names, 4)
    assert sharding.kd_shards(no_docs).count() == 0
