"""Corpus summaries, source catalogs and drift audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

YEARS_COVERED = 1400


def by_type(docs: DataFrame) -> DataFrame:
    return docs.groupBy("source_type").agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("source").alias("sources"))


def by_era(docs: DataFrame) -> DataFrame:
    """A missing era is a group, shown as NULL."""
    return docs.groupBy(F.coalesce("era", F.lit("NULL")).alias("era")).agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("source").alias("sources"))


def totals(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).alias("chunks"), F.coalesce(F.sum("word_count"), F.lit(0)).alias("words"))


def sources(docs: DataFrame) -> DataFrame:
    """Passages by source, type, era and authentication."""
    auth, tier = F.get_json_object("metadata", "$.authentication"), F.get_json_object("metadata", "$.scholar_tier")
    return docs.groupBy("source", "source_type", "era", auth.alias("authentication"), tier.alias("scholar_tier")).agg(F.count(F.lit(1)).alias("chunk_count"))


def stats(docs: DataFrame, figures: DataFrame, approximate: bool = False) -> DataFrame:
    """One row; one pass over each table, and only one-row frames are put side by side."""
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    own = docs.agg(distinct("source").alias("sources"), F.count(F.lit(1)).alias("passages"), distinct("era").alias("eras"), F.max("created_at").alias("last_updated"))
    return own.crossJoin(figures.agg(F.count(F.lit(1)).alias("figures"))).withColumn("years_covered", F.lit(YEARS_COVERED))


#: Size of a distinct-count sketch: 2 ** SKETCH registers, a relative error of about 1.04 / 2 ** (SKETCH / 2).
SKETCH = 12
_COUNTED = ("source", "era")


def daily_stats(docs: DataFrame, day: str = "created_at") -> DataFrame:
    """A row for each day of ``day``: passages, last_updated and a distinct-count sketch of each counted column; days without a date are one."""
    sketches = [F.hll_sketch_agg(c, SKETCH).alias(f"{c}_sketch") for c in _COUNTED]
    return docs.groupBy(F.to_date(day).alias("day")).agg(F.count(F.lit(1)).alias("passages"), F.max(day).alias("last_updated"), *sketches)


def update_stats(docs: DataFrame, folder: str, day: str = "created_at", since: object = None) -> None:
    """Adds to the stored daily rows those of days from ``since`` on (else all); only these days' rows are read.

    Days are partitions that are replaced whole, so a day that is counted again, or a run that is
    repeated, changes nothing else.
    """
    own = docs if since is None else docs.where(F.col(day) >= F.lit(since))
    daily_stats(own, day).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(folder)


def stored_stats(daily: DataFrame, figures: DataFrame) -> DataFrame:
    """The row of ``stats`` merged from daily rows; distinct counts are estimates."""
    distinct = lambda c: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")), F.lit(0)).alias(f"{c}s")
    own = daily.agg(F.coalesce(F.sum("passages"), F.lit(0)).alias("passages"), F.max("last_updated").alias("last_updated"), *[distinct(c) for c in _COUNTED])
    return own.crossJoin(figures.agg(F.count(F.lit(1)).alias("figures"))).withColumn("years_covered", F.lit(YEARS_COVERED))


def source_figures(chunks: DataFrame) -> DataFrame:
    """The sorted names found in the chunks of each source."""
    return chunks.select("source", F.explode("figures").alias("f")).groupBy("source").agg(F.array_sort(F.collect_set("f")).alias("figures"))


def figure_drift(docs: DataFrame, meta: DataFrame) -> DataFrame:
    """How many documents have names in the text, linked figures, or one without the other."""
    linked = meta.where(F.size("figure_ids") > 0).select(F.col("chunk_id").alias("_id")).distinct()
    both = docs.join(linked, docs["id"] == F.col("_id"), "left")
    named, has = F.coalesce(F.size("figures") > 0, F.lit(False)), F.col("_id").isNotNull()
    return both.agg(
        F.count(F.lit(1)).alias("documents"),
        F.count_if(named).alias("with_names"),
        F.count_if(has).alias("with_ids"),
        F.count_if(named & ~has).alias("names_only"),
        F.count_if(~named & has).alias("ids_only"),
    )


def key_variants(docs: DataFrame) -> DataFrame:
    """Normalised source keys that are spelt in more than one way."""
    norm = F.regexp_replace(F.lower("source"), "[-_ ]", "")
    return docs.groupBy(norm.alias("key")).agg(F.array_sort(F.collect_set("source")).alias("variants")).where(F.size("variants") > 1)
