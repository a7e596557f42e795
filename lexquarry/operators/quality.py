"""Integrity rules as frames of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexquarry import schema


def enum_violations(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Rows with another value; null passes, as in a CHECK constraint."""
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*allowed))


def unique_violations(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys that occur more than once, with their count; keys with a null are distinct."""
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return df.where(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def fk_violations(df: DataFrame, column: str, parent: DataFrame, key: str = "id") -> DataFrame:
    """Rows whose reference isn't null and has no parent."""
    return df.where(F.col(column).isNotNull()).join(parent.select(F.col(key).alias("_pk")), F.col(column) == F.col("_pk"), "left_anti")


def self_loops(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) == F.col(b))


def validate(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, rule, violations) of every rule of the schema whose tables are given."""
    out = []

    def put(table: str, rule: str, bad: DataFrame) -> None:
        out.append(bad.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations"))

    for (t, c), allowed in schema.ENUMS.items():
        if t in tables:
            put(t, f"enum {c}", enum_violations(tables[t], c, allowed))
    for t, sets in schema.UNIQUE.items():
        for keys in sets if t in tables else ():
            put(t, f"unique {', '.join(keys)}", unique_violations(tables[t], keys))
    for (t, c), parent in schema.FOREIGN.items():
        if t in tables and parent in tables:
            put(t, f"reference {c}", fk_violations(tables[t], c, tables[parent]))
    if "figure_relationships" in tables:
        put("figure_relationships", "no self loop", self_loops(tables["figure_relationships"], "figure_a_id", "figure_b_id"))
    return reduce(DataFrame.unionByName, out)
