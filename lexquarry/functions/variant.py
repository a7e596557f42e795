"""JSON parsed once into variants and read by path and type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def parsed(text: Column) -> Column:
    """The variant of a JSON text; null where it is broken."""
    return F.try_parse_json(text)


def at(value: Column, path: str, kind: str) -> Column:
    """The value at a path as a type; null where it isn't there or can't be one."""
    return F.try_variant_get(value, path, kind)


def kind(value: Column) -> Column:
    """null, boolean, number, text, array or object."""
    said = F.schema_of_variant(value)
    return (
        F.when(said == "VOID", "null").when(said == "BOOLEAN", "boolean").when(said == "STRING", "text")
        .when(said.startswith("ARRAY"), "array").when(said.startswith("OBJECT"), "object").when(said.isNotNull(), "number")
    )


def fields(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """(keys, field, value): the fields of each object, one level deep; rows that are no objects have none."""
    spark, own = df.sparkSession, df.where(kind(F.col(value)) == "object")
    named = ", ".join(f"d.`{k}`" for k in keys)
    return spark.sql(f"SELECT {named}{', ' if keys else ''}e.key AS field, e.value AS value FROM {{d}} AS d, LATERAL variant_explode(d.`{value}`) AS e", d=own)
