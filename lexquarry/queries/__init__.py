"""Registry of the engine's own queries and the SQL that they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexquarry.queries import _base, catalog, graph, ingest, retrieval, stories, text, usage  # noqa: F401  registration


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_base.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_base.SQL)
