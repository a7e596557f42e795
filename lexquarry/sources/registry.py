"""The source registry: descriptors of what to ingest, as a frame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "category string, identifier string, identifiers array<string>, url string, filename_hint string, short_name string, source string, source_type string, era array<string>, language string, translator string, reliability string, format string"


def load(spark: SparkSession, path: str) -> DataFrame:
    """Descriptors from JSON lines; an era may be one string or a list."""
    return spark.read.schema(SCHEMA).json(path)


def volumes(spark: SparkSession, n: int, base: dict[str, str]) -> DataFrame:
    """One descriptor per volume of a work: ``{n}`` in a value becomes the volume number."""
    rows = spark.range(1, n + 1).select(F.col("id").cast("string").alias("n"))
    return rows.select(*[F.replace(F.lit(v), F.lit("{n}"), F.col("n")).alias(k) for k, v in base.items()])


def by_categories(registry: DataFrame, categories: list[str] | None = None) -> DataFrame:
    return registry if not categories else registry.where(F.col("category").isin(*categories))


def unknown_categories(registry: DataFrame, categories: list[str]) -> list[str]:
    """Names that no descriptor has; the distinct categories are a handful."""
    known = {r[0] for r in registry.where(F.col("category").isin(*categories)).select("category").distinct().collect()}
    return [c for c in categories if c not in known]


def by_short_name(registry: DataFrame, short_name: str) -> DataFrame:
    return registry.where(F.col("short_name") == short_name).limit(1)


def counts(registry: DataFrame) -> DataFrame:
    return registry.groupBy("category").agg(F.count(F.lit(1)).alias("sources"))
