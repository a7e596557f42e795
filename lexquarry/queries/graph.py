"""Graph look-ups on the driver's tables in graph roles."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexquarry.operators import graph as G
from lexquarry.operators import substring
from lexquarry.operators.ingest import shared_folder
from lexquarry.queries._base import query, role, table
from lexquarry.queries.retrieval import Q


@query("resolve_figure", "SELECT id, name FROM (SELECT id, CASE WHEN id = 2 THEN 'SUPPLIER#000000003' ELSE name END AS name FROM figs) WHERE name = 'Supplier#000000003' OR id IN (7, 9) ORDER BY id LIMIT 1", "figs")
def resolve_figure(spark, d):
    nodes = role(spark, d, "figs").withColumn("name", F.when(F.col("id") == 2, F.upper(F.lit("Supplier#000000003"))).otherwise(F.col("name"))).withColumn("name_variants", F.when(F.col("id").isin(7, 9), F.array(F.lit("Supplier#000000003"), F.lit(None).cast("string"))))
    return G.resolve(nodes, "Supplier#000000003").select("id", "name")


@query("figure_search", "SELECT id, name FROM figs WHERE name ILIKE '%ER#0000000%' ORDER BY id LIMIT 10", "figs")
def figure_search(spark, d):
    return G.search_names(role(spark, d, "figs"), "ER#0000000").select("id", "name")


@query("ilike_any", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%RED%' OR p_name ILIKE '%ol_'")
def ilike_any(spark, d):
    return table(spark, d, "part").where(G.ilike_any(F.col("p_name"), ["%RED%", "%ol_"])).select("p_partkey", "p_name")


_BOTH = "e AS (SELECT *, figure_a_id AS node, figure_b_id AS other FROM rels UNION ALL SELECT *, figure_b_id, figure_a_id FROM rels WHERE figure_a_id <> figure_b_id)"


@query("figure_relationships", f"WITH {_BOTH} SELECT node, relationship, description, resolution, a.name AS figure_a, b.name AS figure_b FROM e JOIN figs a ON a.id = figure_a_id JOIN figs b ON b.id = figure_b_id", "rels", "figs")
def figure_relationships(spark, d):
    return G.relationships(role(spark, d, "rels"), role(spark, d, "figs"))


@query("relationship_other", f"WITH {_BOTH} SELECT node, relationship, other, f.name AS other_name FROM e JOIN figs f ON f.id = other", "rels", "figs")
def relationship_other(spark, d):
    return G.related(role(spark, d, "rels"), role(spark, d, "figs"))


@query("figure_lineage", "SELECT figure_id, lineage_type, direction, divergence, coalesce(f.name, related_name) AS related FROM lin LEFT JOIN figs f ON f.id = related_id", "lin", "figs")
def figure_lineage(spark, d):
    return G.lineage(role(spark, d, "lin"), role(spark, d, "figs"))


@query("figure_themes", "SELECT figure_id, slug, name, relevance FROM fthemes JOIN facs ON facs.id = theme_id", "fthemes", "facs")
def figure_themes(spark, d):
    return G.themes(role(spark, d, "fthemes"), role(spark, d, "facs"))


@query("figure_factions", "SELECT figure_id, name, ideology, joined_date FROM fthemes JOIN facs ON facs.id = faction_id", "fthemes", "facs")
def figure_factions(spark, d):
    return G.factions(role(spark, d, "fthemes"), role(spark, d, "facs"))


@query("betrayals_committed", "SELECT betrayer_id AS figure_id, name AS other FROM betr JOIN figs ON figs.id = betrayed_id", "betr", "figs")
def betrayals_committed(spark, d):
    return G.betrayals(role(spark, d, "betr"), role(spark, d, "figs"))


@query("betrayals_suffered", "SELECT betrayed_id AS figure_id, name AS other FROM betr JOIN figs ON figs.id = betrayer_id", "betr", "figs")
def betrayals_suffered(spark, d):
    return G.betrayals(role(spark, d, "betr"), role(spark, d, "figs"), committed=False)


@query("alliance_reversals", "SELECT figure_id, f.name AS from_faction, t.name AS to_faction FROM rev LEFT JOIN facs f ON f.id = from_faction_id LEFT JOIN facs t ON t.id = to_faction_id", "rev", "facs")
def alliance_reversals(spark, d):
    return G.alliance_reversals(role(spark, d, "rev"), role(spark, d, "facs"))


@query("causal_context", "WITH e AS (SELECT *, cause_event_id AS node FROM cse UNION ALL SELECT *, effect_event_id FROM cse WHERE cause_event_id <> effect_event_id) SELECT node, c.name AS cause, f.name AS effect, time_gap_years FROM e JOIN evs c ON c.id = cause_event_id JOIN evs f ON f.id = effect_event_id", "cse", "evs")
def causal_context(spark, d):
    return G.causes(role(spark, d, "cse"), role(spark, d, "evs"))


@query("scholarly_debates_for", "SELECT id, topic FROM deb WHERE figure_id = 5 OR event_id = 7", "deb")
def scholarly_debates_for(spark, d):
    return G.debates(role(spark, d, "deb"), figure_id=5, event_id=7).select("id", "topic")


@query("source_conflicts", "SELECT id, source_a, source_b, relationship FROM srel WHERE event_id = 7 AND relationship IN ('CONTRADICTS', 'CHALLENGES')", "srel")
def source_conflicts(spark, d):
    return G.conflicts(role(spark, d, "srel"), 7).select("id", "source_a", "source_b", "relationship")


@query("figure_coverage", "SELECT f AS figure_id, count(DISTINCT source) AS sources, count(*) AS chunks FROM (SELECT DISTINCT l_orderkey AS chunk_id, l_suppkey % 20 AS f FROM lineitem) JOIN docs ON docs.id = chunk_id GROUP BY 1", "docs")
def figure_coverage(spark, d):
    meta = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("chunk_id")).agg(F.collect_list(F.col("l_suppkey") % 20).alias("figure_ids"))
    return G.coverage(role(spark, d, "docs"), meta)


@query(
    "context_packet_counts",
    """WITH me AS (SELECT id FROM figs WHERE name = 'Supplier#000000005'), here AS (SELECT id FROM evs WHERE name = (SELECT name FROM evs ORDER BY id LIMIT 1 OFFSET 5))
    SELECT 'lineage' AS section, count(*) AS rows FROM lin WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'relationships', count(*) FROM rels WHERE (figure_a_id IN (FROM me) OR figure_b_id IN (FROM me)) AND figure_a_id IN (SELECT id FROM figs) AND figure_b_id IN (SELECT id FROM figs)
    UNION ALL SELECT 'themes', count(*) FROM fthemes JOIN facs ON facs.id = theme_id WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'factions', count(*) FROM fthemes JOIN facs ON facs.id = faction_id WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'betrayals_committed', count(*) FROM betr JOIN figs ON figs.id = betrayed_id WHERE betrayer_id IN (FROM me)
    UNION ALL SELECT 'betrayals_suffered', count(*) FROM betr JOIN figs ON figs.id = betrayer_id WHERE betrayed_id IN (FROM me)
    UNION ALL SELECT 'alliance_reversals', count(*) FROM rev WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'debates', count(*) FROM deb WHERE figure_id IN (FROM me) OR event_id IN (FROM here)
    UNION ALL SELECT 'conflicts', count(*) FROM srel WHERE event_id IN (FROM here) AND relationship IN ('CONTRADICTS', 'CHALLENGES')
    UNION ALL SELECT 'causes', count(*) FROM cse JOIN evs c ON c.id = cause_event_id JOIN evs e ON e.id = effect_event_id WHERE cause_event_id IN (FROM here) OR effect_event_id IN (FROM here)""",
    "figs", "evs", "lin", "rels", "fthemes", "facs", "betr", "rev", "deb", "srel", "cse",
)
def context_packet_counts(spark, d):
    from lexquarry.plans.packets import context_packet, packet_counts

    r = lambda name: role(spark, d, name)
    no_names = F.array().cast("array<string>")
    events = r("evs").withColumn("name_variants", no_names)
    empty = lambda ddl: spark.createDataFrame([], ddl)
    tables = {
        "figures": r("figs").withColumn("name_variants", no_names), "events": events, "figure_lineage": r("lin"), "figure_relationships": r("rels"),
        "figure_themes": r("fthemes"), "themes": r("facs"), "figure_factions": r("fthemes"), "political_factions": r("facs"), "political_betrayals": r("betr"),
        "alliance_reversals": r("rev"), "scholarly_debates": r("deb"), "source_relationships": r("srel"), "event_causes": r("cse"),
        "figure_motivations": empty("figure_id bigint, motivation string, is_primary boolean"), "figure_deaths": empty("figure_id bigint, last_words string"),
        "figure_quotes": empty("figure_id bigint, quote string, chain_strength string"), "event_geography": empty("event_id bigint, place string"),
    }
    event = events.orderBy("id").offset(5).limit(1).first()["name"]
    packet = context_packet(tables, "Supplier#000000005", event, r("docs").withColumn("similarity_score", F.lit(0.5)))
    names = ("lineage", "relationships", "themes", "factions", "betrayals_committed", "betrayals_suffered", "alliance_reversals", "debates", "conflicts", "causes")
    return packet_counts({k: packet[k] for k in names})


class _Given:
    """The query vectors of three topics."""

    dim = 64

    def embed(self, texts, input_type="document"):
        return [[Q[(j + 7 * i) % 64] for j in range(64)] for i in range(len(texts))]


_TOPICS = [[Q[(j + 7 * i) % 64] for j in range(64)] for i in range(3)]
_SIMS = ", ".join(f"round(list_inner_product(embedding::DOUBLE[], {v}::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product({v}::DOUBLE[], {v}::DOUBLE[]))), 6) AS s{i}" for i, v in enumerate(_TOPICS))


@query(
    "episode_context",
    f"""WITH me AS (SELECT id FROM figs WHERE name = 'Supplier#000000005'), here AS (SELECT id FROM evs WHERE name = (SELECT name FROM evs ORDER BY id LIMIT 1 OFFSET 5)),
    s AS (SELECT id, source, {_SIMS} FROM vecs WHERE id % 3 = 0), t AS (SELECT *, row_number() OVER (ORDER BY s0 DESC, id) AS r0, row_number() OVER (ORDER BY s1 DESC, id) AS r1, row_number() OVER (ORDER BY s2 DESC, id) AS r2 FROM s),
    acc AS (SELECT * FROM t WHERE r0 <= 20 OR r1 <= 20 OR r2 <= 20), con AS (SELECT * FROM srel WHERE event_id IN (FROM here) AND relationship IN ('CONTRADICTS', 'CHALLENGES'))
    SELECT 'accounts' AS section, count(*) AS rows FROM acc
    UNION ALL SELECT 'accounts_ids', sum(id)::BIGINT FROM acc
    UNION ALL SELECT 'coverage_score', count(*) FROM acc
    UNION ALL SELECT 'source_map', count(DISTINCT source) FROM acc
    UNION ALL SELECT 'warned', count(*) FROM acc WHERE source IN ('s1', 's3')
    UNION ALL SELECT 'figure', count(*) FROM me
    UNION ALL SELECT 'event', count(*) FROM here
    UNION ALL SELECT 'tier_S', count(*) FROM figs WHERE name = 'Supplier#000000005' AND tier % 3 = 0
    UNION ALL SELECT 'lineage', count(*) FROM lin WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'relationships', count(*) FROM rels WHERE (figure_a_id IN (FROM me) OR figure_b_id IN (FROM me)) AND figure_a_id IN (SELECT id FROM figs) AND figure_b_id IN (SELECT id FROM figs)
    UNION ALL SELECT 'themes', count(*) FROM fthemes JOIN facs ON facs.id = theme_id WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'motivations', count(*) FROM part WHERE p_partkey % 90 IN (FROM me)
    UNION ALL SELECT 'death', least(count(*), 1) FROM customer WHERE c_custkey IN (FROM me)
    UNION ALL SELECT 'quotes', count(*) FROM lineitem WHERE l_suppkey IN (FROM me)
    UNION ALL SELECT 'geography', count(*) FROM nation WHERE n_nationkey IN (FROM here)
    UNION ALL SELECT 'factions', count(*) FROM fthemes JOIN facs ON facs.id = faction_id WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'betrayals_committed', count(*) FROM betr JOIN figs ON figs.id = betrayed_id WHERE betrayer_id IN (FROM me)
    UNION ALL SELECT 'betrayals_suffered', count(*) FROM betr JOIN figs ON figs.id = betrayer_id WHERE betrayed_id IN (FROM me)
    UNION ALL SELECT 'alliance_reversals', count(*) FROM rev WHERE figure_id IN (FROM me)
    UNION ALL SELECT 'debates', count(*) FROM deb WHERE figure_id IN (FROM me) OR event_id IN (FROM here)
    UNION ALL SELECT 'conflicts', count(*) FROM con
    UNION ALL SELECT 'conflict_count', count(*) FROM con
    UNION ALL SELECT 'causes', count(*) FROM cse JOIN evs c ON c.id = cause_event_id JOIN evs e ON e.id = effect_event_id WHERE cause_event_id IN (FROM here) OR effect_event_id IN (FROM here)""",
    "figs", "evs", "lin", "rels", "fthemes", "facs", "betr", "rev", "deb", "srel", "cse", "vecs",
)
def episode_context(spark, d):
    """Every section of the whole packet, retrieval included."""
    from lexquarry.plans.packets import episode_context as whole
    from lexquarry.plans.packets import packet_counts

    r = lambda name: role(spark, d, name)
    t = lambda name, *select: table(spark, d, name).selectExpr(*select)
    no_names = F.array().cast("array<string>")
    events = r("evs").withColumn("name_variants", no_names)
    figures = r("figs").withColumns({"name_variants": no_names, "sensitivity_tier": F.when(F.col("tier") % 3 == 0, "S").otherwise("B"), "era": no_names, "series": F.array(F.lit("one"))})
    tables = {
        "figures": figures, "events": events, "figure_lineage": r("lin"), "figure_relationships": r("rels"),
        "figure_themes": r("fthemes"), "themes": r("facs"), "figure_factions": r("fthemes"), "political_factions": r("facs"), "political_betrayals": r("betr"),
        "alliance_reversals": r("rev"), "scholarly_debates": r("deb"), "source_relationships": r("srel"), "event_causes": r("cse"),
        "figure_motivations": t("part", "p_partkey % 90 AS figure_id", "p_type AS motivation", "p_size % 2 = 0 AS is_primary"), "figure_deaths": t("customer", "c_custkey AS figure_id", "c_name AS last_words"),
        "figure_quotes": t("lineitem", "l_suppkey AS figure_id", "l_returnflag AS quote", "l_linestatus AS chain_strength"), "event_geography": t("nation", "n_nationkey AS event_id", "n_name AS place"),
    }
    event = events.orderBy("id").offset(5).limit(1).first()["name"]
    chunks = r("vecs").withColumn("figures", F.when(F.col("id") % 3 == 0, F.array(F.lit("Supplier#000000005"))).otherwise(no_names))
    warnings = spark.createDataFrame([("s1", "disputed"), ("s3", "late")], "source string, warning string")
    packet = whole(tables, chunks, _Given(), "Supplier#000000005", event, warnings=warnings)
    counted = packet_counts({k: v for k, v in packet.items() if k != "head"})
    row = lambda name, value: F.struct(F.lit(name).alias("section"), value.cast("long").alias("rows"))
    head = packet["head"].select(F.inline(F.array(row("coverage_score", F.col("coverage_score")), row("conflict_count", F.col("conflict_count")), row("tier_S", (F.col("sensitivity_tier") == "S").cast("int")))))
    more = packet["accounts"].agg(F.sum("id").alias("i"), F.count("reliability_warning").alias("w")).select(F.inline(F.array(row("accounts_ids", F.col("i")), row("warned", F.col("w")))))
    return counted.unionByName(head).unionByName(more)


@query("ilike_index", r"WITH p AS (SELECT item_id AS pattern_id, concat('%', regexp_extract(text, '[a-z]{5,}', 0), '%') AS pattern FROM benchmark WHERE item_id % 10 = 0) SELECT pattern_id, doc_id AS id FROM p, documents WHERE lower(text) LIKE pattern")
def ilike_index(spark, d):
    """Writes the trigram index of all documents and looks up the first long word of every tenth benchmark passage."""
    folder, docs = f"{shared_folder(spark)}/trigrams-{uuid.uuid4().hex}", role(spark, d, "docs")
    substring.write_trigrams(docs, folder)
    words = table(spark, d, "benchmark").where("item_id % 10 = 0").select(F.col("item_id").alias("pattern_id"), F.concat(F.lit("%"), F.regexp_extract("text", "[a-z]{5,}", 0), F.lit("%")).alias("pattern"))
    return substring.matching(spark, folder, docs, words)[0]


@query("figure_profile", """WITH me AS (SELECT id FROM figs WHERE name ILIKE '%#00000001%' ORDER BY id LIMIT 1)
    SELECT 'figure' AS section, id AS a, 0::BIGINT AS b FROM me
    UNION ALL SELECT 'relationships', CASE WHEN figure_a_id = (FROM me) THEN figure_b_id ELSE figure_a_id END, 0 FROM rels WHERE (figure_a_id IN (FROM me) OR figure_b_id IN (FROM me)) AND figure_a_id IN (SELECT id FROM figs) AND figure_b_id IN (SELECT id FROM figs)
    UNION ALL SELECT 'coverage', count(DISTINCT source), count(*) FROM (SELECT DISTINCT l_orderkey AS chunk_id, l_suppkey % 20 AS f FROM lineitem) JOIN docs ON docs.id = chunk_id WHERE f IN (FROM me) GROUP BY f""", "figs", "rels", "docs")
def figure_profile(spark, d):
    from lexquarry.plans import packets

    meta = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("chunk_id")).agg(F.collect_list(F.col("l_suppkey") % 20).alias("figure_ids"))
    got = packets.figure_profile({"figures": role(spark, d, "figs"), "figure_relationships": role(spark, d, "rels"), "documents": role(spark, d, "docs"), "chunk_metadata": meta}, "#00000001")
    row = lambda df, name, a, b: df.select(F.lit(name).alias("section"), a.cast("long").alias("a"), b.cast("long").alias("b"))
    return row(got["figure"], "figure", F.col("id"), F.lit(0)).unionByName(row(got["relationships"], "relationships", F.col("other"), F.lit(0))).unionByName(row(got["coverage"], "coverage", F.col("sources"), F.col("chunks")))
