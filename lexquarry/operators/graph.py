"""Look-ups in the knowledge graph.

Node tables are joined by name of role; where an edge may be met at either end, the edges are
turned both ways first, so that questions about all nodes at once stay equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONFLICTS = ("CONTRADICTS", "CHALLENGES")


def resolve(nodes: DataFrame, name: str) -> DataFrame:
    """The node of exactly that name or variant; of several, the one of smallest id."""
    hit = (F.col("name") == name) | F.coalesce(F.array_contains("name_variants", name), F.lit(False))
    return nodes.where(hit).orderBy("id").limit(1)


def search_names(nodes: DataFrame, part: str, n: int = 10) -> DataFrame:
    """Nodes whose name contains a part, whatever the case; % and _ in it are wildcards."""
    return nodes.where(F.col("name").ilike(f"%{part}%")).orderBy("id").limit(n)


def ilike_any(c: Column, patterns: list[str]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | c.ilike(p)
    return out


def both_ways(edges: DataFrame, a: str = "figure_a_id", b: str = "figure_b_id") -> DataFrame:
    """Edges as (node, other); a loop gives one row."""
    there = edges.withColumns({"node": F.col(a), "other": F.col(b)})
    back = edges.where(F.col(a) != F.col(b)).withColumns({"node": F.col(b), "other": F.col(a)})
    return there.unionByName(back)


def named(df: DataFrame, nodes: DataFrame, key: str, out: str, how: str = "inner") -> DataFrame:
    """Adds a node's name; sizes decide at run time whether the nodes are broadcast."""
    return df.join(nodes.select(F.col("id").alias(f"_{out}_id"), F.col("name").alias(out)), F.col(key) == F.col(f"_{out}_id"), how).drop(f"_{out}_id")


def relationships(edges: DataFrame, figures: DataFrame) -> DataFrame:
    """(node, relationship, description, resolution, figure_a, figure_b) of every figure."""
    both = named(named(edges, figures, "figure_a_id", "figure_a"), figures, "figure_b_id", "figure_b")
    return both_ways(both).select("node", "relationship", "description", "resolution", "figure_a", "figure_b")


def related(edges: DataFrame, figures: DataFrame) -> DataFrame:
    """(node, relationship, other_name): the other end of each edge."""
    return named(both_ways(edges), figures, "other", "other_name").select("node", "relationship", "other", "other_name")


def lineage(rows: DataFrame, figures: DataFrame) -> DataFrame:
    joined = named(rows, figures, "related_id", "_name", "left")
    return joined.select("figure_id", "lineage_type", "direction", "divergence", F.coalesce("_name", "related_name").alias("related"))


def themes(figure_themes: DataFrame, all_themes: DataFrame) -> DataFrame:
    return figure_themes.join(all_themes.withColumnRenamed("id", "_theme"), F.col("theme_id") == F.col("_theme")).select("figure_id", "slug", "name", "relevance")


def factions(figure_factions: DataFrame, all_factions: DataFrame) -> DataFrame:
    return figure_factions.join(all_factions.withColumnRenamed("id", "_faction"), F.col("faction_id") == F.col("_faction")).select("figure_id", "name", "ideology", "joined_date")


def betrayals(rows: DataFrame, figures: DataFrame, committed: bool = True) -> DataFrame:
    """(figure_id, other): whom a figure betrayed, or by whom it was betrayed."""
    own, other = ("betrayer_id", "betrayed_id") if committed else ("betrayed_id", "betrayer_id")
    return named(rows, figures, other, "other").select(F.col(own).alias("figure_id"), "other")


def alliance_reversals(rows: DataFrame, all_factions: DataFrame) -> DataFrame:
    out = named(named(rows, all_factions, "from_faction_id", "from_faction", "left"), all_factions, "to_faction_id", "to_faction", "left")
    return out.select("figure_id", "from_faction", "to_faction")


def causes(rows: DataFrame, events: DataFrame) -> DataFrame:
    """(node, cause, effect, time_gap_years): causes and effects of every event."""
    both = named(named(rows, events, "cause_event_id", "cause"), events, "effect_event_id", "effect")
    return both_ways(both, "cause_event_id", "effect_event_id").select("node", "cause", "effect", "time_gap_years")


def debates(rows: DataFrame, figure_id: int | None = None, event_id: int | None = None) -> DataFrame:
    """Debates about a figure or an event; nothing if neither is given."""
    hit = F.lit(False)
    if figure_id is not None:
        hit = hit | F.coalesce(F.col("figure_id") == figure_id, F.lit(False))
    if event_id is not None:
        hit = hit | F.coalesce(F.col("event_id") == event_id, F.lit(False))
    return rows.where(hit)


def conflicts(rows: DataFrame, event_id: int) -> DataFrame:
    return rows.where((F.col("event_id") == event_id) & F.col("relationship").isin(*CONFLICTS))


def coverage(chunks: DataFrame, meta: DataFrame) -> DataFrame:
    """(figure_id, sources, chunks) of every figure in the metadata."""
    each = meta.select("chunk_id", F.explode(F.array_distinct("figure_ids")).alias("figure_id"))
    return each.join(chunks.select("id", "source"), F.col("chunk_id") == F.col("id")).groupBy("figure_id").agg(F.count_distinct("source").alias("sources"), F.count(F.lit(1)).alias("chunks"))
