"""Operators on small literal tables: edge rows, the graph packet, sources, providers, streams."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lexquarry import providers as P
from lexquarry import schema
from lexquarry.operators import graph, ingest, quality, retrieval, usage
from lexquarry.plans import packets
from lexquarry.sources import readers, registry
from lexquarry.streaming import usage as stream


def frame(spark, name, *rows):
    """Rows given as dicts; missing columns are null."""
    ddl = schema.TABLES[name]
    cols = [c.strip().split(" ")[0] for c in ddl.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], ddl)


@pytest.fixture(scope="module")
def graph_tables(spark):
    f = lambda name, *rows: frame(spark, name, *rows)
    return {
        "figures": f("figures", {"id": 1, "name": "Khalid", "name_variants": ["Khalid ibn Walid", None], "sensitivity_tier": "B", "era": ["rashidun"]}, {"id": 2, "name": "Umar"}, {"id": 3, "name": "Heraclius"}),
        "events": f("events", {"id": 10, "name": "Yarmouk", "name_variants": ["Battle of Yarmouk"], "date_ce": "636"}, {"id": 11, "name": "Ajnadayn"}),
        "figure_relationships": f("figure_relationships", {"id": 1, "figure_a_id": 1, "figure_b_id": 2, "relationship": "ALLY"}, {"id": 2, "figure_a_id": 3, "figure_b_id": 1, "relationship": "ANTAGONIST"}, {"id": 3, "figure_a_id": 1, "figure_b_id": 2, "relationship": "ALLY"}, {"id": 4, "figure_a_id": 2, "figure_b_id": 2, "relationship": "WRONG"}),
        "figure_lineage": f("figure_lineage", {"id": 1, "figure_id": 1, "related_name": "Walid", "lineage_type": "BIOLOGICAL", "direction": "ancestor"}, {"id": 2, "figure_id": 1, "related_id": 2, "lineage_type": "MILITARY_PATRON", "direction": "ancestor"}),
        "themes": f("themes", {"id": 1, "slug": "loyalty_and_betrayal"}, {"id": 2, "slug": "justice_vs_power"}),
        "figure_themes": f("figure_themes", {"figure_id": 1, "theme_id": 1}, {"figure_id": 1, "theme_id": 2}),
        "figure_motivations": f("figure_motivations", {"figure_id": 1, "motivation": "m", "is_primary": False}, {"figure_id": 1, "motivation": "p", "is_primary": True}),
        "figure_deaths": f("figure_deaths", {"figure_id": 1, "last_words": "words"}),
        "figure_quotes": f("figure_quotes", {"figure_id": 1, "quote": "q", "chain_strength": "sahih"}),
        "scholarly_debates": f("scholarly_debates", {"id": 1, "topic": "t", "figure_id": 1, "event_id": 10}, {"id": 2, "topic": "u", "figure_id": 2}),
        "source_relationships": f("source_relationships", {"id": 1, "event_id": 10, "relationship": "CONTRADICTS"}, {"id": 2, "event_id": 10, "relationship": "SUPPLEMENTS"}),
        "event_geography": f("event_geography", {"event_id": 10, "place": "river"}),
        "event_causes": f("event_causes", {"cause_event_id": 11, "effect_event_id": 10, "time_gap_years": 2}),
        "political_factions": f("political_factions", {"id": 1, "name": "A"}),
        "figure_factions": f("figure_factions", {"figure_id": 1, "faction_id": 1}),
        "political_betrayals": f("political_betrayals", {"betrayer_id": 3, "betrayed_id": 1}),
        "alliance_reversals": f("alliance_reversals", {"figure_id": 1, "to_faction_id": 1}),
    }


def test_context_packet(spark, graph_tables):
    accounts = spark.createDataFrame([("a", 0.8), ("a", 0.75), ("b", -0.2), ("c", 0.7), ("d", 0.7)], "source string, similarity_score double")
    warn = spark.createDataFrame([("b", "late")], "source string, warning string")
    p = packets.context_packet(graph_tables, "Khalid ibn Walid", "Battle of Yarmouk", accounts, warn)
    n = {r["section"]: r["rows"] for r in packets.packet_counts(p).collect()}
    assert n["accounts"] >= 5 and n["lineage"] == 2 and n["themes"] == 2 and n["conflicts"] == 1 and n["causes"] == 1
    assert n["relationships"] == 3 and n["debates"] == 1 and n["betrayals_suffered"] == 1 and n["betrayals_committed"] == 0
    assert p["figure"].first()["sensitivity_tier"] == "B" and p["event"].first()["date_ce"] == "636"
    assert p["motivations"].first()["is_primary"] and p["death"].first()["last_words"] == "words"
    assert {r["source"]: r["max_score"] for r in p["source_map"].collect()} == {"a": 0.8, "b": 0.0, "c": 0.7, "d": 0.7}
    assert [r["warning"] for r in p["warnings"].collect()] == ["late"]
    with pytest.raises(LookupError):
        packets.context_packet(graph_tables, "nobody", "Yarmouk", accounts)
    unknown = packets.context_packet(graph_tables, "Khalid", "no such event", accounts)
    assert unknown["event"].isEmpty() and unknown["conflicts"].isEmpty() and unknown["debates"].count() == 1


def test_rules(spark, graph_tables):
    bad = {(r["table"], r["rule"]): r["violations"] for r in quality.validate(graph_tables).collect() if r["violations"]}
    assert bad == {("figure_relationships", "enum relationship"): 1, ("figure_relationships", "unique figure_a_id, figure_b_id, relationship"): 1, ("figure_relationships", "no self loop"): 1}


def test_dedupe_relationships(graph_tables):
    out = ingest.dedupe_keep_min_id(graph_tables["figure_relationships"], ["figure_a_id", "figure_b_id", "relationship"], drop_self_loops=("figure_a_id", "figure_b_id"))
    assert sorted(r["id"] for r in out.collect()) == [1, 2]


def test_metadata_fan_out_and_noise(spark):
    docs = frame(spark, "documents", {"id": 1, "content": "x"}, {"id": 2, "content": "y"}, {"id": 3, "content": "z"})
    meta = frame(spark, "chunk_metadata", {"id": 5, "chunk_id": 1, "chain_strength": "hasan"}, {"id": 4, "chunk_id": 1, "chain_strength": "sahih"}, {"id": 6, "chunk_id": 2, "noise_flag": True})
    assert retrieval.with_metadata(docs, meta).count() == 4
    assert {r["id"]: r["chain_strength"] for r in retrieval.with_metadata(docs, meta, one_row=True).collect()} == {1: "sahih", 2: None, 3: None}
    assert sorted(r["id"] for r in retrieval.exclude_noise(docs, meta).collect()) == [1, 3]


def test_vector_edges(spark):
    docs = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, 0.0]), (5, [0.0, 1.0])], "id long, embedding array<float>")
    assert [r["id"] for r in retrieval.vector_topk(docs, [1.0, 0.0], 4).collect()] == [1, 4, 5, 3]


def test_rrf_depends_on_ranks_only(spark):
    a = spark.createDataFrame([(1, 3.0), (2, 2.0), (3, 1.0)], "id long, score double")
    b = spark.createDataFrame([(3, 0.9), (2, 0.8)], "id long, score double")
    scaled = a.withColumn("score", F.col("score") * 100)
    got = [tuple(r) for r in retrieval.hybrid_rrf([a, b], 5).collect()]
    assert got == [tuple(r) for r in retrieval.hybrid_rrf([scaled, b], 5).collect()]
    assert got[0] == (3, round(1 / 63 + 1 / 61, 6))


def test_search_modes(spark):
    e = P.HashingEmbedder(16)
    docs = [(i, t, "s", "historical", "era", e.embed([t])[0], None) for i, t in enumerate(["red apple tree", "blue sea wave", "green apple"])]
    chunks = spark.createDataFrame(docs, "id long, content string, source string, source_type string, era string, embedding array<float>, metadata string")
    meta = frame(spark, "chunk_metadata", {"id": 1, "chunk_id": 2, "noise_flag": True})
    assert packets.search(chunks, meta, e, "red apple tree", 1).first()["id"] == 0
    out, mode = packets.search_with_fallback(chunks, meta, e, "red apple", 5)
    assert mode == "hybrid" and {r["id"] for r in out.collect()} == {0, 1}
    assert packets.search_with_fallback(chunks, meta, e, "!?...", 5)[1] == "vector"
    with pytest.raises(ValueError):
        packets.search_with_fallback(chunks, meta, e, "ab", 5)


def test_fallback_only_below_the_floor(spark):
    rows = spark.createDataFrame([(i, f"text {i}", i) for i in range(8)], "id long, content string, pos long")
    assert retrieval.fallback_broaden(rows.where("id < 5"), rows).count() == 5
    assert retrieval.fallback_broaden(rows.where("id < 2"), rows).count() == 8


def test_quota_and_sessions(spark):
    at = lambda d, h: dt.datetime(2024, d, 28, h)
    log = spark.createDataFrame([(1, "k", at(1, 1)), (2, "k", at(1, 2)), (3, "k", at(1, 9)), (4, "k", at(2, 1))], "id long, api_key string, created_at timestamp_ntz")
    assert {r["id"]: r["accepted"] for r in usage.quota_decisions(log, 2).collect()} == {1: True, 2: True, 3: False, 4: True}
    assert sorted(r["events"] for r in usage.sessions(log, key="api_key").collect()) == [1, 1, 2]


def test_keys(spark):
    keys = frame(spark, "api_keys", {"id": 1, "name": "a@x.org", "tier": "odd", "active": True, "month_count": 9, "month_reset": dt.date(2024, 1, 3)}, {"id": 2, "name": "aa@x.org", "tier": "pro", "active": True, "month_count": 4, "month_reset": dt.date(2024, 2, 2)})
    assert {r["id"]: r["active"] for r in usage.deactivate(keys, "A@x.org").collect()} == {1: False, 2: True}
    assert {r["id"]: r["month_count"] for r in usage.reset_month(keys, F.lit("2024-02-10").cast("date")).collect()} == {1: 0, 2: 4}
    tiers = spark.createDataFrame([("free", 0), ("pro", 10)], "tier string, api_limit int")
    assert {r["id"]: r["api_limit"] for r in usage.tier_config(keys, tiers).collect()} == {1: 0, 2: 10}


def test_readers(spark, tmp_path):
    (tmp_path / "my_book.txt").write_bytes(b"---\nsource: A\nera: x\n---\nbody \xff here")
    text = readers.scan_text(spark, str(tmp_path))
    row = readers.front_matter(text).first()
    assert (row["source"], row["short_name"], row["source_type"], row["era"], row["body"]) == ("A", "my_book", "secondary", ["x"], "body � here")
    assert readers.main_text("<body><nav>n</nav><div class='x entry-y'> a <p>b</p></div>rest</body>") == "a\nb"
    assert readers.main_text("<article>one<script>s</script></article><article>two</article>") == "one"
    assert readers.main_text("a<br>b &amp; c") == "a\nb & c"
    assert readers.main_text("") == ""
    (tmp_path / "j.json").write_text(json.dumps({"data": [{"hadithNumber": "1", "hadith": [{"lang": "ar", "body": "x"}, {"lang": "en", "body": "<p>an English body of some length</p>"}]}, {"hadithNumber": "2", "hadith": [{"lang": "en", "body": "short"}]}]}))
    rows = readers.sunnah_bodies(spark.read.json(str(tmp_path / "j.json"), multiLine=True))
    assert [tuple(r) for r in rows.collect()] == [("1", "an English body of some length")]
    pages = readers.paged(spark, lambda p: f"page {p}" if p < 6 else None, 20, 3)
    assert sorted(r["page"] for r in pages.collect()) == [1, 2, 3, 4, 5]


def test_pdf_chain(spark, tmp_path):
    class Fake:
        def __init__(self, text):
            self.text = text

        def extract(self, data):
            if self.text is None:
                raise ValueError
            return self.text

    long = "w " * 600
    chain = P.ExtractorChain([(Fake(None), P.over_100_words), (Fake("few words"), P.over_100_words), (Fake(long), P.over_1000_chars)])
    (tmp_path / "a.pdf").write_bytes(b"%PDF")
    assert readers.scan_pdf(spark, str(tmp_path), chain).first()["text"] == long
    assert P.ExtractorChain([(Fake("x"), P.over_100_words)]).extract(b"") == ""


def test_registry(spark):
    rows = registry.volumes(spark, 3, {"category": "multi", "short_name": "v{n}"})
    assert [r["short_name"] for r in registry.by_short_name(rows, "v2").collect()] == ["v2"]
    assert registry.unknown_categories(rows, ["multi", "odd"]) == ["odd"]


def test_embedding_retries_and_halves():
    waits = []

    class Flaky:
        dim, left = 1, 2

        def embed(self, texts, input_type="document"):
            if len(texts) > 2:
                raise P.TooManyTokens
            if self.left:
                self.left -= 1
                raise P.RateLimited
            return [[1.0]] * len(texts)

    assert P.embed_with_retry(Flaky(), ["a"] * 5, wait=waits.append) == [[1.0]] * 5
    assert waits == [25.0, 50.0]


def test_streams(spark, tmp_path):
    rows = [(1, "k", "2024-01-01T00:00:10"), (1, "k", "2024-01-01T00:00:10"), (2, "k", "2024-01-01T00:00:40"), (3, "j", "2024-01-01T05:00:00"), (4, "k", "2024-01-03T00:00:00")]
    src = tmp_path / "in"
    spark.createDataFrame(rows, "event_id long, api_key string, t string").select("event_id", "api_key", F.col("t").cast("timestamp").alias("created_at")).write.parquet(str(src))
    read = lambda: spark.readStream.schema("event_id long, api_key string, created_at timestamp").parquet(str(src))

    def run(df, name):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        q.awaitTermination()
        return [tuple(r) for r in spark.table(name).collect()]

    assert len(run(stream.exactly_once(read()), "once")) == 4
    used = run(stream.windowed_usage(read()), "used")
    assert sorted((k, n) for k, _, n in used) == [("j", 1), ("k", 3)]
    assert sorted((k, n) for k, _, _, n in run(stream.sessions(read(), key="api_key"), "sess")) == [("j", 1), ("k", 3)]
    assert [n for _, _, n in run(stream.rate_limit_violations(read(), 2), "rate")] == [3]


def test_quotas_of_late_and_disordered_events(spark, tmp_path):
    """An event counts in its own month however late it comes, until the watermark has passed that month."""
    at = lambda m, day: f"2024-{m:02d}-{day:02d}T12:00:00"
    files = [
        [("k", at(2, 1)), ("k", at(2, 2)), ("j", at(1, 5))],
        [("k", at(1, 31)), ("k", at(1, 30)), ("k", at(2, 3))],  # after February has begun
        [("k", at(1, 29)), ("k", at(1, 28))],
        [("k", at(6, 1))],  # the watermark leaves January behind
        [("k", at(1, 27)), ("k", at(6, 2))],  # too late: dropped
    ]
    src = tmp_path / "in"
    for i, rows in enumerate(files):
        spark.createDataFrame(rows, "api_key string, t string").select("api_key", F.col("t").cast("timestamp").alias("created_at")).coalesce(1).write.parquet(str(tmp_path / f"f{i}"))
        part = next((tmp_path / f"f{i}").glob("*.parquet"))
        src.mkdir(exist_ok=True)
        part.rename(src / f"{i}.parquet")
        os.utime(src / f"{i}.parquet", (1_700_000_000 + 10 * i,) * 2)
    spark.conf.set(*stream.STATE_STORE)
    try:
        read = spark.readStream.schema("api_key string, created_at timestamp").option("maxFilesPerTrigger", 1).parquet(str(src))
        q = stream.quota_decisions(read, 3, key="api_key", late="40 days").writeStream.format("memory").queryName("late_quota").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        rows = [r["numRowsTotal"] for p in q.recentProgress for r in p["stateOperators"]]
    finally:
        spark.conf.unset(stream.STATE_STORE[0])
    got = spark.table("late_quota").groupBy("api_key", "month").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r")).collect()
    y = 2024 * 12
    assert sorted(map(tuple, got)) == [("j", y + 1, 1, 0), ("k", y + 1, 3, 1), ("k", y + 2, 3, 0), ("k", y + 6, 2, 0)]
    assert rows[-1] < max(rows)  # closed months leave the store


def test_references_that_no_semicolon_ends_are_text():
    html = "<article><h1 class='x&y'>one &amp;&quot;&#38;&notin; cut &amp</h1>a&b &notit; &#65 &</article>"
    assert readers.main_text(html) == 'one &"&∉ cut &amp\na&b &notit; &#65 &'


def test_quota_counters_of_many_keys_are_few_rows(spark, tmp_path):
    """Counters are kept by bucket; null keys and keys beyond 2^53 stay themselves."""
    df = spark.range(600).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE (1L << 60) + id % 100 END AS user_id", "timestamp'2024-01-05 10:00:00' AS created_at")
    df.repartition(2).write.parquet(str(tmp_path / "in"))
    spark.conf.set(*stream.STATE_STORE)
    try:
        read = spark.readStream.schema("user_id long, created_at timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        q = stream.quota_decisions(read, 3).writeStream.format("memory").queryName("many_keys").outputMode("append").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
        q.awaitTermination()
        rows = [r["numRowsTotal"] for p in q.recentProgress for r in p["stateOperators"]]
    finally:
        spark.conf.unset(stream.STATE_STORE[0])
    got = spark.table("many_keys").groupBy("user_id", "month").agg(F.sum("accepted").alias("a"), F.sum("rejected").alias("r"))
    want = df.groupBy("user_id").count().selectExpr("user_id", "2024 * 12 + 1", "least(count, 3)", "greatest(count - 3, 0)")
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    assert max(rows) < 500  # values and timers of 70 buckets or fewer; by key there would be more
