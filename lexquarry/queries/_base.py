"""How queries are registered, and the roles that the driver's tables play.

A role is a table under the engine's column names. The select list is plain SQL that Spark and
DuckDB read alike, so a query and its SQL see the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

#: role: (table, select list)
ROLES = {
    "docs": ("documents", "doc_id AS id, text AS content, source, lang AS source_type, CASE WHEN doc_id % 11 = 0 THEN NULL ELSE concat('era', cast(doc_id % 5 AS string)) END AS era, n_chars"),
    "vecs": ("embeddings", "vec_id AS id, embedding, concat('era', cast(label AS string)) AS era, concat('s', cast(vec_id % 7 AS string)) AS source, concat('text ', cast(vec_id AS string)) AS content"),
    "meta": ("labels", "doc_id AS id, doc_id AS chunk_id, quality = 0 AS noise_flag, toxic = 1 AS conflict_flag, CASE doc_id % 6 WHEN 0 THEN 'eyewitness' WHEN 1 THEN 'transmitted' WHEN 2 THEN 'later_compilation' WHEN 3 THEN 'commentary' WHEN 4 THEN 'unknown' END AS account_type, CASE doc_id % 7 WHEN 0 THEN 'sahih' WHEN 1 THEN 'hasan' WHEN 2 THEN 'daif' WHEN 3 THEN 'scholarly' WHEN 4 THEN 'unknown' END AS chain_strength"),
    "figs": ("supplier", "s_suppkey AS id, s_name AS name, s_nationkey AS tier"),
    "rels": ("orders", "o_orderkey AS id, o_custkey % 100 + 1 AS figure_a_id, o_orderkey % 97 + 1 AS figure_b_id, o_orderstatus AS relationship, o_orderpriority AS description, o_orderstatus AS resolution"),
    "lin": ("part", "p_partkey AS id, p_partkey % 100 + 1 AS figure_id, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size END AS related_id, p_brand AS related_name, p_type AS lineage_type, CASE WHEN p_size % 2 = 0 THEN 'ancestor' ELSE 'descendant' END AS direction, p_name AS divergence"),
    "evs": ("nation", "n_nationkey AS id, n_name AS name, n_regionkey AS region_id"),
    "facs": ("region", "r_regionkey AS id, r_name AS name, r_name AS ideology, r_name AS slug"),
    "fthemes": ("customer", "c_custkey % 100 + 1 AS figure_id, c_nationkey % 7 AS theme_id, c_mktsegment AS relevance, c_nationkey % 7 AS faction_id, c_name AS joined_date"),
    "betr": ("customer", "c_custkey % 100 + 1 AS betrayer_id, c_nationkey + 1 AS betrayed_id"),
    "rev": ("customer", "c_custkey % 100 + 1 AS figure_id, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_nationkey % 5 END AS from_faction_id, c_custkey % 6 AS to_faction_id"),
    "cse": ("part", "p_size % 25 AS cause_event_id, p_partkey % 25 AS effect_event_id, p_size AS time_gap_years"),
    "deb": ("part", "p_partkey AS id, p_type AS topic, CASE WHEN p_size % 4 = 0 THEN NULL ELSE p_size END AS event_id, p_partkey % 100 AS figure_id"),
    "srel": ("part", "p_partkey AS id, p_brand AS source_a, p_type AS source_b, p_size AS event_id, CASE p_partkey % 6 WHEN 0 THEN 'CORROBORATES' WHEN 1 THEN 'CONTRADICTS' WHEN 2 THEN 'SUPPLEMENTS' WHEN 3 THEN 'CHALLENGES' WHEN 4 THEN 'EARLIER_ACCOUNT' ELSE 'OTHER' END AS relationship"),
    "log": ("events", "event_id AS id, user_id AS api_key, event_type AS endpoint, ts AS created_at, props"),
    "turns": ("conversations", "conv_id, turn, role, text"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, select = ROLES[name]
    source_df = table(spark, sf_dir, source)
    return source_df.selectExpr(*_split(select))


def _split(select: str) -> list[str]:
    """The items of a select list; commas inside brackets don't count."""
    out, depth, at = [], 0, 0
    for i, c in enumerate(select):
        depth += (c == "(") - (c == ")")
        if c == "," and depth == 0:
            out.append(select[at:i])
            at = i + 1
    return [*out, select[at:]]


def ctes(*names: str) -> str:
    return "WITH " + ", ".join(f"{n} AS (SELECT {ROLES[n][1]} FROM {ROLES[n][0]})" for n in names)


def query(name: str, sql: str | None = None, *roles: str):
    """Registers a function of (spark, sf_dir); its SQL may use the named roles as tables."""

    def put(f):
        QUERIES[name] = f
        if sql is not None:
            if not roles:
                SQL[name] = sql
            elif sql.lstrip().upper().startswith("WITH "):
                SQL[name] = ctes(*roles) + ", " + sql.lstrip()[5:]
            else:
                SQL[name] = ctes(*roles) + " " + sql
        return f

    return put
