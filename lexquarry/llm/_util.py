"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: A frame is broadcast only if its measured number of rows is at most this.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and tables between jobs, which driver and executors share.

    It is the session's ``spark.checkpoint.dir``; a temporary one is set only where that is unset and
    one process runs everything, as in tests.
    """
    if spark.sparkContext.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames that are made within are deleted when their job ends, not when the driver next collects its garbage.

    For frames that are written or checkpointed once; a lost executor's part of a running job is still repeated.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Kept:
    """Parquet tables between jobs in the shared folder; what isn't deleted before goes at the end."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/kept-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame, by: str | None = None) -> DataFrame:
        """The frame as written, in row groups that are small also where single values are large; ``by``: a folder for each value."""
        path = f"{self.folder}/{name}"
        df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path, partitionBy=by)
        return self.spark.read.schema(df.schema).parquet(path).select(df.columns)

    def delete(self, name: str = "") -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Kept:
        return self

    def __exit__(self, *_) -> None:
        self.delete()


def small_or_shuffled(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast hint for a frame whose counted ``rows`` are few, else the frame itself."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def join_unique(left: DataFrame, right: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Left join with a right side that is unique by ``key``, safe against hot keys.

    ``weight`` of a right row is the number of left rows with its key. Keys that hold over a
    thousandth of ``total`` are at most 1,000, so these right rows are broadcast; the left rows
    of all other keys are joined by a shuffle in which no key is hot. Both frames should be
    materialised, since they are read twice. Null keys find no partner.
    """
    others = [c for c in right.columns if c != key]
    hot = right.where(F.col(weight) > max(1, total // 1000))
    cold = right.where(F.col(weight) <= max(1, total // 1000))
    marked = left.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    done = marked.where("_hot").drop("_hot")
    rest = marked.where(F.col("_hot").isNull()).drop("_hot", *others).join(cold, key, "left")
    return done.unionByName(rest.select(done.columns))


def ranked(values: DataFrame, col: str, out: str) -> DataFrame:
    """Adds ``out``, the place of each row's ``col`` in order from 0 (null first); values must be distinct.

    Rows are dealt by ranges of ``col`` and counted there, so no task holds all of them.
    """
    placed = materialise(values.repartitionByRange(F.col(col).asc_nulls_first()).withColumn("_p", F.spark_partition_id()))
    sizes = sorted((r["_p"], r["n"]) for r in placed.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).collect())  # one row a partition
    start, at = {}, 0
    for p, n in sizes:
        start[p], at = at, at + n
    if not start:
        return placed.withColumn(out, F.lit(0).cast("long")).drop("_p")
    before = F.element_at(F.array(*[F.lit(start.get(p, 0)) for p in range(max(start) + 1)]), F.col("_p") + 1)
    rn = F.row_number().over(Window.partitionBy("_p").orderBy(F.col(col).asc_nulls_first())) - 1
    return placed.withColumn(out, (rn + before).cast("long")).drop("_p")


def numbered(df: DataFrame, groups: list[str], spread: list[str], order: list[Column], rows: int, out: str, sums: dict[str, Column] | None = None, block_rows: int = 5_000) -> DataFrame:
    """Number the rows of each group from 0 without gaps, in blocks that no task outgrows.

    Rows are ordered inside blocks by ``order`` (which must be total, so that reruns agree);
    blocks come from a hash of the ``spread`` columns, so a group of any size is spread over
    ``rows / block_rows`` blocks. ``sums`` maps names to columns whose running totals (with the
    row itself) over the same order are added. Block totals are a frame of groups x blocks rows
    that is joined back by a shuffle or, if counted to be few, broadcast.
    """
    blocks = max(1, -(-rows // block_rows))
    sums = sums or {}
    df = df.withColumn("_block", F.pmod(F.xxhash64(*spread), F.lit(blocks)).cast("int"))
    totals = df.groupBy(*groups, "_block").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{k}") for k, c in sums.items()])
    before = Window.partitionBy(*groups).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in groups],
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"),
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_at_{k}") for k in sums],
    )
    starts = materialise(starts)
    w = Window.partitionBy(*groups, "_block").orderBy(*order)
    inner = df.withColumn("_rn", F.row_number().over(w) - 1)
    for k, c in sums.items():
        inner = inner.withColumn(f"_s_{k}", F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    same = F.col("_block") == F.col("_b")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    out_df = inner.join(small_or_shuffled(starts, starts.count()), same, "left").withColumn(out, (F.col("_rn") + F.col("_at")).cast("long"))
    for k in sums:
        out_df = out_df.withColumn(k, F.col(f"_s_{k}") + F.col(f"_at_{k}"))
    return out_df.drop("_block", "_b", "_rn", "_at", *[f"_g_{g}" for g in groups], *[f"_at_{k}" for k in sums], *[f"_s_{k}" for k in sums])
