"""Catalogs, audits and integrity rules on the driver's tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from lexquarry.functions.tagging import extract_entities
from lexquarry.functions.text import word_count
from lexquarry.operators import catalog as C
from lexquarry.operators import quality as V
from lexquarry.operators.ingest import shared_folder
from lexquarry.queries._base import query, role, table


@query("corpus_by_type", "SELECT source_type, count(*) AS chunks, count(DISTINCT source) AS sources FROM docs GROUP BY source_type", "docs")
def corpus_by_type(spark, d):
    return C.by_type(role(spark, d, "docs"))


@query("corpus_by_era", "SELECT coalesce(era, 'NULL') AS era, count(*) AS chunks, count(DISTINCT source) AS sources FROM docs GROUP BY 1", "docs")
def corpus_by_era(spark, d):
    return C.by_era(role(spark, d, "docs"))


@query("corpus_totals", r"SELECT count(*) AS chunks, coalesce(sum(len(list_filter(regexp_split_to_array(content, '\s+'), lambda w: w <> ''))), 0)::BIGINT AS words FROM docs", "docs")
def corpus_totals(spark, d):
    return C.totals(role(spark, d, "docs").select(word_count(F.col("content")).alias("word_count")))


@query(
    "source_catalog",
    "SELECT source, source_type, era, CASE WHEN id % 2 = 0 THEN 'classical_islamic' END AS authentication, cast(id % 3 AS VARCHAR) AS scholar_tier, count(*) AS chunk_count FROM docs GROUP BY ALL",
    "docs",
)
def source_catalog(spark, d):
    auth = F.when(F.col("id") % 2 == 0, '"authentication": "classical_islamic", ').otherwise("")
    docs = role(spark, d, "docs").withColumn("metadata", F.concat(F.lit("{"), auth, F.lit('"scholar_tier": "'), (F.col("id") % 3).cast("string"), F.lit('"}')))
    return C.sources(docs)


@query("corpus_stats", "SELECT count(DISTINCT source) AS sources, count(*) AS passages, count(DISTINCT era) AS eras, max(n_chars) AS last_updated, (SELECT count(*) FROM figs) AS figures, 1400 AS years_covered FROM docs", "docs", "figs")
def corpus_stats(spark, d):
    return C.stats(role(spark, d, "docs").withColumn("created_at", F.col("n_chars")), role(spark, d, "figs"))


@query("source_figures", "SELECT source, list_sort(list(DISTINCT f)) AS figures FROM (SELECT source, unnest(list_filter(['the', 'und', 'que', 'de'], lambda n: contains(lower(content), n))) AS f FROM docs) GROUP BY source", "docs")
def source_figures(spark, d):
    tagged = role(spark, d, "docs").select("source", extract_entities(F.col("content"), ["the", "und", "que", "de"]).alias("figures"))
    return C.source_figures(tagged)


@query("figure_drift_audit", "SELECT count(*) AS documents, count(*) FILTER (n) AS with_names, count(*) FILTER (i) AS with_ids, count(*) FILTER (n AND NOT i) AS names_only, count(*) FILTER (NOT n AND i) AS ids_only FROM (SELECT contains(lower(content), 'und') AS n, docs.id IN (SELECT chunk_id FROM meta WHERE noise_flag) AS i FROM docs)", "docs", "meta")
def figure_drift_audit(spark, d):
    docs = role(spark, d, "docs").select("id", extract_entities(F.col("content"), ["und"]).alias("figures"))
    meta = role(spark, d, "meta").select("chunk_id", F.when(F.col("noise_flag"), F.array(F.lit(1))).otherwise(F.array().cast("array<int>")).alias("figure_ids"))
    return C.figure_drift(docs, meta)


@query("source_key_variants", "SELECT regexp_replace(lower(source), '[-_ ]', '', 'g') AS key, list_sort(list(DISTINCT source)) AS variants FROM (SELECT CASE id % 3 WHEN 0 THEN upper(source) WHEN 1 THEN concat('src-', source[4:]) ELSE source END AS source FROM docs) GROUP BY 1 HAVING count(DISTINCT source) > 1", "docs")
def source_key_variants(spark, d):
    docs = role(spark, d, "docs").selectExpr("CASE id % 3 WHEN 0 THEN upper(source) WHEN 1 THEN concat('src-', substring(source, 4)) ELSE source END AS source")
    return C.key_variants(docs)


@query("dq_enum_violations", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('O', 'F')")
def dq_enum_violations(spark, d):
    return V.enum_violations(table(spark, d, "orders"), "o_orderstatus", ("O", "F")).select("o_orderkey", "o_orderstatus")


@query("dq_unique_violations", "SELECT o_custkey, o_orderpriority, count(*) AS rows FROM orders WHERE o_custkey IS NOT NULL AND o_orderpriority IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1")
def dq_unique_violations(spark, d):
    return V.unique_violations(table(spark, d, "orders"), ("o_custkey", "o_orderpriority"))


@query("dq_fk_violations", "SELECT id, chunk_id FROM (SELECT doc_id AS id, doc_id AS chunk_id FROM labels) x WHERE chunk_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM documents WHERE doc_id = chunk_id AND lang = 'en')")
def dq_fk_violations(spark, d):
    parents = table(spark, d, "documents").where("lang = 'en'")
    return V.fk_violations(role(spark, d, "meta"), "chunk_id", parents, "doc_id").select("id", "chunk_id")


_DATED = "source, era, TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(cast(id % 40 AS int), cast(id % 23 AS int)) AS created_at"


@query("corpus_stats_stored", """WITH x AS (SELECT source, era, TIMESTAMP '2024-01-01 00:00:00' + to_days((id % 40)::INT) + to_hours((id % 23)::INT) AS created_at FROM docs)
    SELECT count(*) AS passages, max(created_at) AS last_updated, count(DISTINCT source) AS sources, count(DISTINCT era) AS eras, (SELECT count(*) FROM figs) AS figures, 1400 AS years_covered FROM x""", "docs", "figs")
def corpus_stats_stored(spark, d):
    """Kept by day in two goes, then merged; so few sources and eras are counted exactly by the sketches."""
    folder = f"{shared_folder(spark)}/stats-{uuid.uuid4().hex}"
    docs = role(spark, d, "docs").selectExpr("source", "era", _DATED.split(", ", 2)[2])
    C.update_stats(docs.where("created_at < TIMESTAMP '2024-01-20 00:00:00'"), folder)
    C.update_stats(docs, folder, since=dt.datetime(2024, 1, 18))  # two days are counted again
    return C.stored_stats(spark.read.parquet(folder), role(spark, d, "figs")).withColumn("last_updated", F.col("last_updated").cast("timestamp_ntz"))
