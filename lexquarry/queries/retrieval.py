"""Search, fusion and result shaping on the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lexquarry.operators import fulltext, neighbour_graph
from lexquarry.operators import retrieval as R
from lexquarry.operators.ingest import shared_folder
from lexquarry.plans import packets
from lexquarry.providers import HashingEmbedder, embed
from lexquarry.queries._base import query, role, table

#: A fixed query vector of the width of the embeddings table, and its SQL form.
Q = [((i * 37) % 64 - 31.5) / 64 for i in range(64)]
Q_SQL = "[" + ", ".join(repr(x) for x in Q) + "]::DOUBLE[]"
_SIM = f"round(list_inner_product(embedding::DOUBLE[], {Q_SQL}) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product({Q_SQL}, {Q_SQL}))), 6)"
WORDS = "the of ing und"


@query("vector_topk", f"SELECT id, source, {_SIM} AS similarity FROM vecs WHERE embedding IS NOT NULL ORDER BY similarity DESC, id LIMIT 10", "vecs")
def vector_topk(spark, d):
    return R.vector_topk(role(spark, d, "vecs"), Q, 10).select("id", "source", "similarity")


@query("filtered_search", f"SELECT id, era, {_SIM} AS similarity FROM vecs WHERE era = 'era3' ORDER BY similarity DESC, id LIMIT 5", "vecs")
def filtered_search(spark, d):
    return R.vector_topk(R.optional_filters(role(spark, d, "vecs"), era="era3"), Q, 5).select("id", "era", "similarity")


@query("exclude_noise", "SELECT id, source FROM docs WHERE NOT EXISTS (SELECT 1 FROM meta WHERE meta.chunk_id = docs.id AND noise_flag)", "docs", "meta")
def exclude_noise(spark, d):
    return R.exclude_noise(role(spark, d, "docs"), role(spark, d, "meta")).select("id", "source")


@query(
    "search_with_metadata",
    f"""WITH kept AS (SELECT id, era, source, {_SIM} AS similarity FROM vecs WHERE era IN ('era1', 'era2', 'era3') AND id NOT IN (SELECT chunk_id FROM meta WHERE noise_flag) ORDER BY similarity DESC, id LIMIT 10)
    SELECT k.id, k.era, k.source, k.similarity, m.account_type, m.chain_strength, m.conflict_flag FROM kept k LEFT JOIN meta m ON m.chunk_id = k.id""",
    "vecs", "meta",
)
def search_with_metadata(spark, d):
    meta = role(spark, d, "meta")
    chunks = R.exclude_noise(role(spark, d, "vecs").where(F.col("era").isin("era1", "era2", "era3")), meta)
    return R.with_metadata(R.vector_topk(chunks, Q, 10), meta).select("id", "era", "source", "similarity", "account_type", "chain_strength", "conflict_flag")


@query(
    "multi_query_topk",
    """WITH q AS (SELECT id AS query_id, embedding AS qe FROM vecs WHERE id % 100 = 0),
    s AS (SELECT query_id, id, round(list_inner_product(embedding::DOUBLE[], qe::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(qe::DOUBLE[], qe::DOUBLE[]))), 6) AS similarity FROM vecs, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s)
    SELECT query_id, id, similarity, rank FROM r WHERE rank <= 5""",
    "vecs",
)
def multi_query_topk(spark, d):
    v = role(spark, d, "vecs")
    topics = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    return R.multi_query_topk(v.select("id", "embedding"), topics, 5).select("query_id", "id", "similarity", "rank")


@query(
    "search_by_figures",
    f"""WITH f AS (SELECT doc_id AS id, list_filter(['the', 'und', 'que'], lambda n: contains(lower(text), n)) AS figures FROM documents)
    SELECT v.id, {_SIM} AS similarity FROM vecs v JOIN f USING (id) WHERE list_has_any(figures, ['und', 'que']) ORDER BY similarity DESC, v.id LIMIT 10""",
    "vecs",
)
def search_by_figures(spark, d):
    from lexquarry.functions.tagging import extract_entities

    tagged = role(spark, d, "docs").select("id", extract_entities(F.col("content"), ["the", "und", "que"]).alias("figures"))
    hit = tagged.where(F.arrays_overlap("figures", F.array(F.lit("und"), F.lit("que")))).select("id")
    return R.vector_topk(role(spark, d, "vecs").join(hit, "id", "left_semi"), Q, 10).select("id", "similarity")


_BM25 = r"""w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
    dl AS (SELECT id, len(ws) AS dl FROM w), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    tf AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(ws) AS t FROM w) WHERE t IN ('the', 'of', 'ing', 'und') GROUP BY id, t),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    bm AS (SELECT id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM tf JOIN df USING (t) JOIN dl USING (id), st GROUP BY id)"""


@query("fts_topk", f"WITH {_BM25} SELECT id, score FROM bm ORDER BY score DESC, id LIMIT 20")
def fts_topk(spark, d):
    return R.fts_topk(role(spark, d, "docs"), WORDS, 20)


#: Passages are the queries: those of every tenth number.
_PASSAGES = r"""q AS (SELECT item_id AS query_id, list_distinct(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS ts FROM benchmark WHERE item_id % 10 = 0),
    w AS (SELECT doc_id AS id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents),
    dl AS (SELECT id, coalesce(len(ws), 0) AS dl FROM w), st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
    qt AS (SELECT query_id, unnest(ts) AS t FROM q),
    tf AS (SELECT id, t, count(*) AS tf FROM (SELECT id, unnest(ws) AS t FROM w) WHERE t IN (SELECT t FROM qt) GROUP BY id, t),
    df AS (SELECT t, count(*) AS df FROM tf GROUP BY t),
    bm AS (SELECT query_id, id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / avgdl))), 6) AS score FROM qt JOIN tf USING (t) JOIN df USING (t) JOIN dl USING (id), st GROUP BY query_id, id)"""


@query("fts_index_topk", f"WITH {_PASSAGES} SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM bm) WHERE rank <= 10")
def fts_index_topk(spark, d):
    """Writes the index of all documents and searches it for passages."""
    folder = f"{shared_folder(spark)}/fulltext-{uuid.uuid4().hex}"
    fulltext.write_index(role(spark, d, "docs"), folder)
    passages = table(spark, d, "benchmark").where("item_id % 10 = 0").select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))
    return fulltext.Index(spark, folder).search(passages, 10)[0]


@query("postings", r"SELECT id, t AS term, count(*) AS tf, dl FROM (SELECT doc_id AS id, len(ws) AS dl, unnest(ws) AS t FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents)) GROUP BY id, t, dl")
def postings(spark, d):
    return R.postings(role(spark, d, "docs")).select("id", "term", "tf", F.col("dl").cast("long").alias("dl"))


@query(
    "hybrid_rrf",
    f"""WITH {_BM25}, f AS (SELECT id, row_number() OVER (ORDER BY score DESC, id) AS r FROM (SELECT id, score FROM bm ORDER BY score DESC, id LIMIT 50)),
    v AS (SELECT id, row_number() OVER (ORDER BY s DESC, id) AS r FROM (SELECT id, {_SIM} AS s FROM vecs ORDER BY s DESC, id LIMIT 50))
    SELECT id, round(sum(1.0::DOUBLE / (60 + r)), 6) AS rrf_score FROM (SELECT * FROM f UNION ALL SELECT * FROM v) GROUP BY id ORDER BY rrf_score DESC, id LIMIT 20""",
    "vecs",
)
def hybrid_rrf(spark, d):
    near = R.vector_topk(role(spark, d, "vecs"), Q, 50).select("id", F.col("similarity").alias("score"))
    return R.hybrid_rrf([R.fts_topk(role(spark, d, "docs"), WORDS, 50), near], 20)


_RANK = """CASE account_type WHEN 'eyewitness' THEN 1 WHEN 'transmitted' THEN 2 WHEN 'later_compilation' THEN 3 WHEN 'commentary' THEN 4 ELSE 5 END
    + CASE coalesce(chain_strength, 'unknown') WHEN 'sahih' THEN 1 WHEN 'hasan' THEN 2 WHEN 'daif' THEN 3 WHEN 'scholarly' THEN 2 WHEN 'unknown' THEN 4 ELSE 5 END + CASE WHEN noise_flag THEN 10 ELSE 0 END"""


@query("rank_by_reliability", f"SELECT docs.id, {_RANK} AS reliability_rank FROM docs JOIN meta ON chunk_id = docs.id", "docs", "meta")
def rank_by_reliability(spark, d):
    meta = role(spark, d, "meta").drop("id")
    joined = role(spark, d, "docs").join(meta, F.col("id") == F.col("chunk_id")).withColumn("pos", F.col("id"))
    return R.rank_by_reliability(joined).select("id", "reliability_rank")


_LISTS = "l AS (SELECT CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS list_no, id AS pos, id, content, CASE WHEN id % 4 = 0 THEN NULL ELSE cast(n_chars % 97 AS double) END AS score, CASE WHEN id % 8 = 0 THEN NULL ELSE cast(n_chars % 89 AS double) END AS similarity_score FROM docs)"


def _lists(spark, d):
    return role(spark, d, "docs").selectExpr(
        "CASE id % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS list_no", "id AS pos", "id", "content",
        "CASE WHEN id % 4 = 0 THEN NULL ELSE cast(n_chars % 97 AS double) END AS score", "CASE WHEN id % 8 = 0 THEN NULL ELSE cast(n_chars % 89 AS double) END AS similarity_score",
    )


@query("merge_dedupe_prefix", f"WITH {_LISTS} SELECT id, list_no FROM (SELECT *, row_number() OVER (PARTITION BY content[:100] ORDER BY list_no, pos) AS rn FROM l) WHERE rn = 1", "docs")
def merge_dedupe_prefix(spark, d):
    return R.merge_dedupe_prefix(_lists(spark, d)).select("id", "list_no")


@query("merged_top_chunks", f"WITH {_LISTS} SELECT id, coalesce(score, similarity_score, 0) AS s FROM (SELECT *, row_number() OVER (PARTITION BY content[:100] ORDER BY list_no, pos) AS rn FROM l) WHERE rn = 1 ORDER BY s DESC, list_no, pos LIMIT 20", "docs")
def merged_top_chunks(spark, d):
    return R.merged_top(_lists(spark, d)).select("id", F.coalesce("score", "similarity_score", F.lit(0.0)).alias("s"))


@query(
    "fallback_broaden",
    """WITH f AS (SELECT id, content FROM docs WHERE era = 'era2' ORDER BY id LIMIT 4), b AS (SELECT id, content FROM docs ORDER BY id LIMIT 12),
    x AS (SELECT *, row_number() OVER (PARTITION BY content[:200] ORDER BY id) AS rn FROM b WHERE content[:200] NOT IN (SELECT content[:200] FROM f))
    SELECT id, 0 AS list_no FROM f UNION ALL SELECT id, 1 AS list_no FROM x WHERE rn = 1 AND (SELECT count(*) FROM f) < 5""",
    "docs",
)
def fallback_broaden(spark, d):
    docs = role(spark, d, "docs").select("id", "content", "era").withColumn("pos", F.col("id"))
    first = docs.where("era = 'era2'").orderBy("id").limit(4)
    return R.fallback_broaden(first, docs.orderBy("id").limit(12)).select("id", "list_no")


@query("source_map", "SELECT source, count(*) AS count, greatest(0.0::DOUBLE, max(n_chars::DOUBLE - 2000)) AS max_score FROM docs GROUP BY source", "docs")
def source_map(spark, d):
    return R.source_map(role(spark, d, "docs").withColumn("similarity_score", F.col("n_chars").cast("double") - 2000))


@query("context_lines", "SELECT id, concat('[SOURCE: ', source, ' | Era: ', coalesce(era, ''), ' | Chain: ', source_type, ' | Score: ', format('{:.3f}', (n_chars % 1000) / 8.0::DOUBLE), ']', chr(10), content[:600]) AS line FROM docs", "docs")
def context_lines(spark, d):
    docs = role(spark, d, "docs").withColumn("chain_strength", F.col("source_type")).withColumn("score", (F.col("n_chars") % 1000) / F.lit(8.0))
    return R.context_lines(docs).select("id", "line")


@query(
    "context_block",
    "WITH t AS (SELECT id, concat('[SOURCE: ', source, ' | Era: ', coalesce(era, ''), ' | Chain: ', source_type, ' | Score: ', format('{:.3f}', (n_chars % 1000) / 8.0::DOUBLE), ']', chr(10), content[:600]) AS line FROM docs ORDER BY id LIMIT 20) SELECT string_agg(line, chr(10) || chr(10) ORDER BY id) AS context FROM t",
    "docs",
)
def context_block(spark, d):
    docs = role(spark, d, "docs").withColumn("chain_strength", F.col("source_type")).withColumn("score", (F.col("n_chars") % 1000) / F.lit(8.0))
    return R.context_block(docs.orderBy("id").limit(20), position="id")


@query("recent_turns", "SELECT conv_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS b FROM turns WHERE role IN ('user', 'assistant') AND trim(text) <> '') WHERE b <= 11", "turns")
def recent_turns(spark, d):
    return R.recent_turns(role(spark, d, "turns")).select("conv_id", "turn", "role")


@query("clean_chunk", "SELECT docs.id, round((n_chars % 1000) / 777.0::DOUBLE, 4) AS score, coalesce(chain_strength, 'unknown') AS chain_strength, coalesce(account_type, 'unknown') AS account_type, coalesce(conflict_flag, false) AS conflict_flag, CASE WHEN docs.id % 2 = 0 THEN 'classical_islamic' ELSE '' END AS authentication FROM docs LEFT JOIN meta ON chunk_id = docs.id", "docs", "meta")
def clean_chunk(spark, d):
    docs = role(spark, d, "docs").withColumn("similarity", (F.col("n_chars") % 1000) / F.lit(777.0)).withColumn("metadata", F.when(F.col("id") % 2 == 0, '{"authentication": "classical_islamic"}').otherwise("{}"))
    joined = R.with_metadata(docs, role(spark, d, "meta"))
    return R.clean_chunk(joined.withColumn("content", F.col("id"))).select(F.col("content").alias("id"), "score", "chain_strength", "account_type", "conflict_flag", "authentication")


@query("authenticated_only", "SELECT id FROM docs WHERE id % 3 = 0 AND source_type = 'en'", "docs")
def authenticated_only(spark, d):
    docs = role(spark, d, "docs").withColumn("metadata", F.when(F.col("id") % 3 == 0, '{"authentication": "classical_islamic"}').otherwise('{"authentication": "other"}'))
    return R.optional_filters(docs, source_type="en", authenticated_only=True).select("id")


@query(
    "research_packet",
    f"""WITH c AS (SELECT id, CASE WHEN id % 3 = 0 THEN 'hadith' ELSE 'historical' END AS source_type, {_SIM} AS similarity FROM vecs)
    SELECT * FROM (SELECT id, similarity, 'primary' AS part FROM c ORDER BY similarity DESC, id LIMIT 10) UNION ALL SELECT * FROM (SELECT id, similarity, 'character' AS part FROM c ORDER BY similarity DESC, id LIMIT 5)
    UNION ALL SELECT * FROM (SELECT id, similarity, 'world' AS part FROM c ORDER BY similarity DESC, id LIMIT 5) UNION ALL SELECT * FROM (SELECT id, similarity, 'religious' AS part FROM c WHERE source_type = 'hadith' ORDER BY similarity DESC, id LIMIT 3)""",
    "vecs",
)
def research_packet(spark, d):
    chunks = role(spark, d, "vecs").withColumn("source_type", F.when(F.col("id") % 3 == 0, "hadith").otherwise("historical"))
    return packets.research_packet(chunks, {p: Q for p, _, _ in packets.RESEARCH}).select("id", "similarity", "part")


@query("merge_topics", """WITH q AS (SELECT id AS query_id, embedding AS qe FROM vecs WHERE id % 100 = 0),
    s AS (SELECT query_id, id, round(list_inner_product(embedding::DOUBLE[], qe::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(qe::DOUBLE[], qe::DOUBLE[]))), 6) AS similarity FROM vecs, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s)
    SELECT id, max(similarity) AS similarity FROM r WHERE rank <= 5 GROUP BY id""", "vecs")
def merge_topics(spark, d):
    return R.merge_topics(multi_query_topk(spark, d))


@query("account_types_filter", "SELECT id, source FROM docs WHERE id IN (SELECT chunk_id FROM meta WHERE account_type IN ('eyewitness', 'transmitted'))", "docs", "meta")
def account_types_filter(spark, d):
    return R.by_account_types(role(spark, d, "docs"), role(spark, d, "meta"), ["eyewitness", "transmitted"]).select("id", "source")


@query(
    "retrieval_gates",
    """WITH q AS (SELECT id AS query_id, embedding AS qe FROM vecs WHERE id % 100 = 0),
    s AS (SELECT query_id, id, round(list_inner_product(embedding::DOUBLE[], qe::DOUBLE[]) / (sqrt(list_inner_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_inner_product(qe::DOUBLE[], qe::DOUBLE[]))), 6) AS similarity FROM vecs, q),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, id) AS rank FROM s),
    g AS (SELECT query_id, count(*) AS results, max(similarity) AS best, min(similarity) FILTER (rank <= 3) AS least_of_first FROM r WHERE rank <= 5 GROUP BY query_id)
    SELECT *, results > 0 AS not_empty, results >= 5 AS enough, best > 0.7::DOUBLE AS best_is_near, results >= 3 AND least_of_first >= 0.65::DOUBLE AS first_are_near FROM g""",
    "vecs",
)
def retrieval_gates(spark, d):
    return R.gates(multi_query_topk(spark, d))


@query("embed_hash")
def embed_hash(spark, d):
    return embed(role(spark, d, "docs"), HashingEmbedder(64))


@query("vector_topk_ann")
def vector_topk_ann(spark, d):
    return R.ann_topk(role(spark, d, "vecs"), Q, 10)


@query("vector_topk_graph")
def vector_topk_graph(spark, d):
    """Writes the neighbour graph of all rows and asks it for those whose id is divisible by 100."""
    folder = f"{shared_folder(spark)}/graph-{uuid.uuid4().hex}"
    v = role(spark, d, "vecs")
    neighbour_graph.build_graph(v).write.parquet(folder)
    queries = v.where("id % 100 = 0").select(F.col("id").alias("query_id"), F.col("embedding").alias("query"))
    return neighbour_graph.graph_topk(spark.read.parquet(folder), queries, 10)[0]


@query("claim_presence_audit", """WITH c AS (SELECT p_partkey % 100 AS figure_id, p_size AS event_id FROM part), seen AS (SELECT DISTINCT l_suppkey % 100 AS figure_id, l_quantity::INT AS event_id FROM lineitem)
    SELECT c.figure_id, c.event_id, CASE WHEN s.figure_id IS NOT NULL THEN 'CONFIRMED' WHEN c.figure_id IN (SELECT figure_id FROM seen) THEN 'PARTIAL' ELSE 'NOT FOUND' END AS verdict FROM c LEFT JOIN seen s USING (figure_id, event_id)""")
def claim_presence_audit(spark, d):
    claims = table(spark, d, "part").selectExpr("p_partkey % 100 AS figure_id", "p_size AS event_id")
    meta = table(spark, d, "lineitem").selectExpr("array(l_suppkey % 100) AS figure_ids", "cast(l_quantity AS int) AS event_id")
    return R.claim_presence(claims, meta).select("figure_id", "event_id", "verdict")


@query("context_from_search", f"""WITH t AS (SELECT id, source, era, content, {_SIM} AS similarity FROM vecs ORDER BY similarity DESC, id LIMIT 20)
    SELECT string_agg(concat('[SOURCE: ', source, ' | Era: ', era, ' | Chain: unknown | Score: ', format('{{:.3f}}', similarity), ']', chr(10), content[:600]), chr(10) || chr(10) ORDER BY similarity DESC, id) AS context FROM t""", "vecs")
def context_from_search(spark, d):
    """The block of the best twenty of a search."""
    found = R.vector_topk(role(spark, d, "vecs"), Q, 20).withColumns({"score": F.col("similarity"), "chain_strength": F.lit("unknown"), "pos": F.struct(-F.col("similarity"), "id")})
    return R.context_block(found)


@query("fallback_from_search", f"""WITH v AS (SELECT id, era, concat('text ', id // 2) AS content, {_SIM} AS similarity FROM vecs), f AS (SELECT * FROM v WHERE era = 'era3' ORDER BY similarity DESC, id LIMIT 4), b AS (SELECT * FROM v ORDER BY similarity DESC, id LIMIT 30),
    x AS (SELECT *, row_number() OVER (PARTITION BY content[:200] ORDER BY similarity DESC, id) AS rn FROM b WHERE content[:200] NOT IN (SELECT content[:200] FROM f))
    SELECT id, similarity, 0 AS list_no FROM f UNION ALL SELECT id, similarity, 1 AS list_no FROM x WHERE rn = 1 AND (SELECT count(*) FROM f) < 5""", "vecs")
def fallback_from_search(spark, d):
    """A filtered search with too few results, then what a broader one adds."""
    v = role(spark, d, "vecs").withColumn("content", F.concat(F.lit("text "), F.expr("id div 2")))
    placed = lambda df: df.withColumn("pos", F.struct(-F.col("similarity"), "id"))
    first = R.vector_topk(R.optional_filters(v, era="era3"), Q, 4)
    return R.fallback_broaden(placed(first), placed(R.vector_topk(v, Q, 30))).select("id", "similarity", "list_no")
