"""Search with fallbacks, the research packet and the context packet."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException, ArithmeticException, NumberFormatException, SparkRuntimeException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.operators import graph, retrieval
from lexquarry.operators.ingest import written

#: The parts of a research packet: (name, number of results, only this source type).
RESEARCH = (("primary", 10, None), ("character", 5, None), ("world", 5, None), ("religious", 3, "hadith"))
MIN_QUERY = 3


#: Failures of a search that leave another one possible: no terms, a column or index that isn't there, rows that can't be read or computed.
SEARCH_FAILS = (ValueError, AnalysisException, SparkRuntimeException, ArithmeticException, NumberFormatException)


class ShortQuery(ValueError):
    pass


def search(chunks: DataFrame, meta: DataFrame, embedder, query: str, n: int = 5, era: str | None = None, source_type: str | None = None, authenticated_only: bool = False, mode: str = "vector", depth: int = 50) -> DataFrame:
    """Filtered search with metadata: ``vector``, or ``hybrid`` with full text fused in."""
    from lexquarry.functions.tagging import clamp_n

    if len(query.strip()) < MIN_QUERY:
        raise ShortQuery(f"a query has at least {MIN_QUERY} characters")
    n = clamp_n(n)
    own = retrieval.exclude_noise(retrieval.optional_filters(chunks, era, source_type, authenticated_only), meta)
    vector = embedder.embed([query], input_type="query")[0]
    if mode == "vector":
        return retrieval.with_metadata(retrieval.vector_topk(own, vector, n), meta).orderBy(F.desc("similarity"), "id")
    near = retrieval.vector_topk(own, vector, depth).select("id", F.col("similarity").alias("score"))
    fused = retrieval.hybrid_rrf([near, retrieval.fts_topk(own, query, depth)], n)
    return retrieval.with_metadata(own.join(F.broadcast(fused), "id"), meta).orderBy(F.desc("rrf_score"), "id")


def search_with_fallback(*args, **kwargs) -> tuple[DataFrame | None, str]:
    """(result, mode): hybrid, else vector, else none.

    Results are few, so each search is run here: one that fails by ``SEARCH_FAILS`` has the next one follow,
    and the cause is logged. Anything else (a lost disk, a cancelled job) is an error, and so is a query
    that is too short.
    """
    for mode in ("hybrid", "vector"):
        try:
            found = search(*args, **kwargs, mode=mode)
            return found.sparkSession.createDataFrame(found.collect(), found.schema), mode
        except ShortQuery:
            raise
        except SEARCH_FAILS as e:
            logging.getLogger(__name__).warning("%s search failed: %s", mode, str(e).splitlines()[0] if str(e) else type(e).__name__)
    return None, "none"


def research_packet(chunks: DataFrame, vectors: dict[str, Sequence[float]]) -> DataFrame:
    """Rows (part, rank..., similarity) of the four searches of a packet, by the part's query vector."""
    out = []
    for part, n, kind in RESEARCH:
        found = retrieval.vector_topk(retrieval.optional_filters(chunks, source_type=kind), vectors[part], n)
        out.append(found.withColumn("part", F.lit(part)))
    return reduce(DataFrame.unionByName, out)


def figure_profile(tables: dict[str, DataFrame], name: str) -> dict[str, DataFrame]:
    """The figure, its relations and its coverage, by the first name that contains ``name``."""
    figure = graph.search_names(tables["figures"], name, 1)
    one = F.broadcast(figure.select(F.col("id").alias("_me")))
    pick = lambda df, key: df.join(one, df[key] == F.col("_me")).drop("_me")
    return {
        "figure": figure,
        "relationships": pick(graph.related(tables["figure_relationships"], tables["figures"]), "node"),
        "coverage": pick(graph.coverage(tables["documents"], tables["chunk_metadata"]), "figure_id"),
    }


def episode_accounts(chunks: DataFrame, embedder, who: dict, event: str, n: int = 20, era: str | None = None) -> DataFrame:
    """The accounts of a figure (name, name_variants, era) at an event.

    Three topics are searched among the chunks of the figure's era that name it or a variant; a chunk
    counts once, with its best score. Under five, what the topics find in all chunks follows.
    """
    name, variants, eras = who["name"], list(who.get("name_variants") or []), list(who.get("era") or [])
    topics = [f"{name} {event}", f"{name} biography early life", f"{event} battle details accounts"]
    vectors = embedder.embed(topics, input_type="query")
    queries = chunks.sparkSession.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "query_id int, query array<double>")
    own = retrieval.optional_filters(chunks, era=era or (eras[0] if eras else None)).where(F.arrays_overlap("figures", F.array(*map(F.lit, [name, *variants]))))

    def merged(part: DataFrame) -> DataFrame:
        best = retrieval.merge_topics(retrieval.multi_query_topk(part.select("id", "embedding"), queries, n))
        found = part.join(F.broadcast(best), "id")
        return found.withColumn("pos", F.row_number().over(Window.orderBy(F.desc("similarity"), "id"))).drop("embedding", "figures")

    return retrieval.fallback_broaden(merged(own), merged(chunks)).withColumnRenamed("similarity", "similarity_score")


def context_packet(tables: dict[str, DataFrame], figure: str, event: str, accounts: DataFrame, warnings: DataFrame | None = None) -> dict[str, DataFrame]:
    """All that is known about a figure at an event.

    ``accounts`` are the retrieved chunks (source, similarity_score, ...); ``warnings`` maps sources
    to notes on their reliability. An unknown figure is an error, an unknown event leaves its parts empty.
    """
    who, what = graph.resolve(tables["figures"], figure), graph.resolve(tables["events"], event)
    me, there = who.first(), what.first()
    if me is None:
        raise LookupError(f"no such figure: {figure}")
    # the two ids are constants of all other parts, so they reach the scans
    mine = lambda df, key="figure_id": df.where(F.col(key) == me["id"])
    its = lambda df, key="event_id": df.where(F.col(key) == there["id"] if there else F.lit(False))
    figures = tables["figures"]
    debates = tables["scholarly_debates"]
    found = {
        "figure": who,
        "event": what,
        "accounts": accounts,
        "source_map": retrieval.source_map(accounts),
        "lineage": mine(graph.lineage(tables["figure_lineage"], figures)).orderBy("lineage_type", "direction"),
        "relationships": mine(graph.relationships(tables["figure_relationships"], figures), "node").orderBy("relationship"),
        "themes": mine(graph.themes(tables["figure_themes"], tables["themes"])),
        "motivations": mine(tables["figure_motivations"]).orderBy(F.desc_nulls_first("is_primary")),
        "death": mine(tables["figure_deaths"]).limit(1),
        "quotes": mine(tables["figure_quotes"]).orderBy(F.asc_nulls_last("chain_strength")),
        "debates": mine(debates).unionByName(its(debates)).dropDuplicates(["id"]),
        "conflicts": its(tables["source_relationships"].where(F.col("relationship").isin(*graph.CONFLICTS))),
        "geography": its(tables["event_geography"]),
        "causes": its(graph.causes(tables["event_causes"], tables["events"]), "node").orderBy(F.asc_nulls_last("time_gap_years")),
        "factions": mine(graph.factions(tables["figure_factions"], tables["political_factions"])).orderBy(F.asc_nulls_last("joined_date")),
        "betrayals_committed": mine(graph.betrayals(tables["political_betrayals"], figures)),
        "betrayals_suffered": mine(graph.betrayals(tables["political_betrayals"], figures, committed=False)),
        "alliance_reversals": mine(graph.alliance_reversals(tables["alliance_reversals"], tables["political_factions"])),
    }
    if warnings is not None:
        found["warnings"] = found["source_map"].join(warnings, "source").select("source", "warning")
    return found


def episode_context(tables: dict[str, DataFrame], chunks: DataFrame, embedder, figure: str, event: str, era: str | None = None, series: str | None = None, n: int = 20, warnings: DataFrame | None = None) -> dict[str, DataFrame]:
    """The whole packet in one call: accounts are retrieved by topics, and all that the graph knows is added.

    ``head`` is one row: the figure's id and sensitivity_tier, the era and series asked for or else the
    figure's first, coverage_score (accounts) and conflict_count. Accounts have a ``reliability_warning`` where
    ``warnings`` (source, warning) has one for their source.
    """
    who = graph.resolve(tables["figures"], figure).first()
    if who is None:
        raise LookupError(f"no such figure: {figure}")
    who = who.asDict()
    accounts = written(episode_accounts(chunks, embedder, {**who, "name": figure}, event, n, era))  # a few rows that five parts read
    if warnings is not None:
        accounts = accounts.join(warnings.select(F.col("source").alias("_s"), F.col("warning").alias("reliability_warning")), F.col("source") == F.col("_s"), "left").drop("_s")
    packet = context_packet(tables, figure, event, accounts)
    one = lambda df, name: F.broadcast(df.agg(F.count(F.lit(1)).alias(name)))
    first = lambda c: F.get(F.col(c), F.lit(0)) if c in packet["figure"].columns else F.lit(None).cast("string")
    head = packet["figure"].select(
        F.col("id").alias("figure_id"), (F.col("sensitivity_tier") if "sensitivity_tier" in packet["figure"].columns else F.lit(None).cast("string")).alias("sensitivity_tier"),
        F.coalesce(F.lit(era), first("era")).alias("era"), F.coalesce(F.lit(series), first("series")).alias("series"),
    )
    return {"head": head.crossJoin(one(accounts, "coverage_score")).crossJoin(one(packet["conflicts"], "conflict_count")), **packet}


def packet_counts(packet: dict[str, DataFrame]) -> DataFrame:
    """(section, rows) of a packet, in one job."""
    return reduce(DataFrame.unionByName, [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(k).alias("section"), "rows") for k, df in packet.items()])
