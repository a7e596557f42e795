"""Acquisition gates, chunk tables and idempotent writes."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.functions import text as T

# File name endings by priority, for text and for documents, and names that are never taken.
TEXT_PRIORITY = (("_djvu.txt",), (".txt", ".text"), (".pdf",), (".djvu",), (".epub",), (".html", ".htm"))
DOCUMENT_PRIORITY = ((".pdf",), (".djvu",), (".epub",), ("_djvu.txt",), (".txt", ".text"), (".html", ".htm"))
SKIP = ("__ia_thumb", "_meta.xml", "_files.xml", "_meta.sqlite", ".torrent", "_archive.torrent", "_itemimage.jpg", "__ia_thumb.jpg", "_thumb.jpg")


def gate_status(raw: Column, cleaned: Column, exists: Column | None = None, least_raw: int = 500, least_clean: int = 1000, threshold: float = 0.40) -> Column:
    """The first gate that stops a source, else OK."""
    out = F.when(exists, "SKIPPED_EXISTS") if exists is not None else F.when(F.lit(False), "")
    return (
        out.when(raw.isNull(), "DOWNLOAD_FAILED")
        .when(F.length(T.strip(raw)) < least_raw, "TOO_SHORT")
        .when(F.length(cleaned) < least_clean, "TOO_SHORT_CLEAN")
        .when(~T.is_readable(cleaned, threshold), "FAILED_READABLE_FILTER")
        .otherwise("OK")
    )


def pick_best_file(files: DataFrame, priority: tuple = TEXT_PRIORITY, largest: bool = True, item: str = "item") -> DataFrame:
    """Per item, of the files (name, size, pos) the one of the best ending, then size, then input order.

    Where none has a listed ending, the first one that is not mere metadata.
    """
    low = F.lower("name")
    rank = F.lit(None).cast("int")
    for i, endings in reversed(list(enumerate(priority))):
        hit = F.lit(False)
        for e in endings:
            hit = hit | F.endswith(low, F.lit(e))
        rank = F.when(hit, i).otherwise(rank)
    skip = F.lit(False)
    for s in SKIP:
        skip = skip | F.contains(low, F.lit(s))
    size = F.coalesce(F.col("size").try_cast("bigint"), F.lit(0))
    ranked = files.where(~skip).withColumn("_rank", rank).withColumn("_size", F.when(F.col("_rank").isNotNull(), size))
    w = Window.partitionBy(item).orderBy(F.asc_nulls_last("_rank"), F.desc("_size") if largest else F.asc("_size"), "pos")
    return ranked.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn", "_rank", "_size")


def first_usable(candidates: DataFrame, least_words: int = 500, key: str = "source") -> DataFrame:
    """Per source the first candidate (priority, text) with more words than the floor."""
    good = candidates.where(T.word_count(F.col("text")) > least_words)
    return good.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy("priority"))).where("_rn = 1").drop("_rn")


def concat_parts(parts: DataFrame, key: str = "source", least_words: int = 0) -> DataFrame:
    """Parts (pos, text) of each source joined by a blank line in order; missing and short ones left out."""
    good = parts.where(F.col("text").isNotNull() & (T.word_count(F.col("text")) >= least_words))
    grouped = good.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("a"))
    return grouped.select(key, F.array_join(F.transform("a", lambda x: x["text"]), "\n\n").alias("text"))


def pending_sources(registry: DataFrame, docs: DataFrame, registered: DataFrame | None = None, least: int = 50) -> DataFrame:
    """Registry rows whose source has fewer than ``least`` chunks and whose short name isn't registered."""
    done = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select(F.col("source").alias("_s"))
    out = registry.join(done, registry["source"] == done["_s"], "left_anti")
    if registered is not None:
        names = registered.select(F.col("short_name").alias("_n"))
        out = out.join(names, out["short_name"] == names["_n"], "left_anti")
    return out


def new_rows(incoming: DataFrame, existing: DataFrame, pattern: str = r" Hadith (\S+):") -> DataFrame:
    """Incoming rows (source, number, ...) whose number no content of the same source has."""
    seen = existing.select(F.col("source").alias("_s"), F.regexp_extract("content", pattern, 1).alias("_n")).distinct()
    return incoming.join(seen, (incoming["source"] == F.col("_s")) & (incoming["number"].cast("string") == F.col("_n")), "left_anti")


def register(existing: DataFrame, new: DataFrame, key: str = "short_name") -> DataFrame:
    """Existing rows and the new ones with unknown keys, one row of each new key."""
    fresh = new.dropDuplicates([key]).join(existing.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert_latest(existing: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """New rows replace existing ones of the same key."""
    return existing.join(new.select(F.col(key).alias("_k")), F.col(key) == F.col("_k"), "left_anti").unionByName(new)


def dedupe_keep_min_id(edges: DataFrame, keys: list[str], id_col: str = "id", drop_self_loops: tuple[str, str] | None = None) -> DataFrame:
    """One row per key combination: the one of smallest id. One partial aggregation, no self join."""
    if drop_self_loops:
        edges = edges.where(F.col(drop_self_loops[0]) != F.col(drop_self_loops[1]))
    rest = [c for c in edges.columns if c not in keys]
    return edges.groupBy(*keys).agg(F.min_by(F.struct(*rest), id_col).alias("r")).select(*keys, "r.*")


def build_chunks(docs: DataFrame, chunker, id_col: str = "id", dedupe: str = "none") -> DataFrame:
    """(source id, chunk_index, content, word_count); ``dedupe='content_hash'`` keeps one row per content."""
    out = docs.select(id_col, F.posexplode(chunker(F.col("content"))).alias("chunk_index", "content")).withColumn("word_count", T.word_count(F.col("content")))
    if dedupe == "content_hash":
        first = Window.partitionBy(F.sha2("content", 256)).orderBy(id_col, "chunk_index")
        out = out.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")
    return out


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``; only where one process runs everything a temporary one will do."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoint-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The frame as a reliable checkpoint, so that a lost executor can't change what was read."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of frames that are written within are deleted when their job ends, not when the driver next collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbered_after(new: DataFrame, order: list[str], last_id: int = 0) -> DataFrame:
    """Serial ids from a stable order.

    Partitions are ranges of the order, so a row's number is its place in the partition after the
    rows of the partitions before; only counts per partition meet in one place.
    """
    ranged = new.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id())
    ranged = written(ranged)
    before = Window.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy(F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first")).select("_q", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"))
    return ranged.join(starts, F.col("_p") == F.col("_q")).withColumn("id", F.col("_m") - F.col("_first") + F.col("_at") + last_id + 1).drop("_p", "_q", "_m", "_first", "_at")


def hadith_chunks(rows: DataFrame, collection: str, least_chars: int = 30) -> DataFrame:
    """Rows (hadiths: array of number, text, grades; others are carried) to chunks; the index is counted before short ones go."""
    from lexquarry.functions.tagging import chain_strength_first

    others = [c for c in rows.columns if c != "hadiths"]
    out = rows.select(*others, F.posexplode("hadiths").alias("chunk_index", "h"))
    text = F.trim("h.text")
    return out.where(F.length(text) >= least_chars).select(
        *others,
        "chunk_index",
        F.concat(F.lit(f"[{collection}] Hadith "), F.col("h.hadithnumber").cast("string"), F.lit(": "), text).alias("content"),
        chain_strength_first(F.transform("h.grades", lambda g: g["grade"])).alias("chain_strength"),
    )


def verse_groups(verses: DataFrame, size: int = 5, key: str = "group_key", position: str = "pos", line: str = "line") -> DataFrame:
    """``size`` consecutive verses of each chapter as one chunk, with a dense index."""
    grouped = verses.groupBy(key, F.floor(F.col(position) / size).cast("int").alias("chunk_index")).agg(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(line).alias("l")))).alias("a"))
    return grouped.select(key, "chunk_index", F.array_join(F.transform("a", lambda x: x["l"]), "\n").alias("content"))


def ocr_job_status(jobs: DataFrame) -> DataFrame:
    """DONE if the output exists, READY if the input does, else MISSING."""
    return jobs.withColumn("status", F.when(F.col("output_exists"), "DONE").when(F.col("input_exists"), "READY").otherwise("MISSING"))
