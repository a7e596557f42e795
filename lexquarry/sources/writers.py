"""Tables of the engine as Parquet: explicit schemas, appends, replacements and manifests."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry import schema

#: Documents are laid out by this column, which most searches filter on.
PARTITION = {"documents": "source_type"}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table with its declared schema; nothing is inferred."""
    return spark.read.schema(schema.TABLES[table]).parquet(f"{root}/{table}")


def conform(df: DataFrame, table: str) -> DataFrame:
    """The declared columns in order, cast; missing ones are null."""
    pairs = [c.strip().split(" ", 1) for c in schema.TABLES[table].split(", ")]
    return df.select(*[(F.col(n) if n in df.columns else F.lit(None)).cast(t).alias(n) for n, t in pairs])


def append(df: DataFrame, root: str, table: str) -> None:
    """Appends rows; one commit of the whole job, so a failed one leaves nothing behind."""
    out = conform(df, table).write.mode("append")
    if table in PARTITION:
        out = out.partitionBy(PARTITION[table])
    out.parquet(f"{root}/{table}")


def replace(df: DataFrame, root: str, table: str, key: Column) -> DataFrame:
    """The rows of a table where ``key`` doesn't hold, and the new ones; the caller writes them as the next version."""
    old = read(df.sparkSession, root, table)
    return old.where(~F.coalesce(key, F.lit(False))).unionByName(conform(df, table))


def overwrite_partitions(df: DataFrame, root: str, table: str) -> None:
    """Replaces those partitions that ``df`` has rows of."""
    conform(df, table).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PARTITION[table]).parquet(f"{root}/{table}")


def manifest(df: DataFrame, path: str) -> None:
    """Descriptors of sources as JSON lines."""
    df.write.mode("overwrite").json(path)


def publish(df: DataFrame, root: str, table: str) -> int:
    """Writes a whole new version of a table and makes it current; returns its number.

    The version is written first and named current afterwards, by one row in a folder of its own, so a
    reader has the old version or the new one, and a job that fails leaves the old one current.
    """
    spark = df.sparkSession
    version = current_version(spark, root, table) + 1
    conform(df, table).write.mode("overwrite").parquet(f"{root}/{table}/version={version}")
    spark.range(1).select(F.lit(version).alias("version")).coalesce(1).write.mode("append").parquet(f"{root}/{table}_current")
    return version


def current_version(spark: SparkSession, root: str, table: str) -> int:
    """0 if the table was never published."""
    try:
        return spark.read.schema("version int").parquet(f"{root}/{table}_current").agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.schema(schema.TABLES[table]).parquet(f"{root}/{table}/version={current_version(spark, root, table)}")


def replace_current(df: DataFrame, root: str, table: str, key: Column) -> int:
    """Publishes the current rows where ``key`` doesn't hold with the rows of ``df``."""
    old = read_current(df.sparkSession, root, table)
    return publish(old.where(~F.coalesce(key, F.lit(False))).unionByName(conform(df, table)), root, table)
