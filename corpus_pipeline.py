"""A training corpus from raw documents, in five stages.

Each stage is a function of (spark, docs, sf_dir). Its result is written as Parquet in the shared
folder and read again as the next stage's documents, so a lost executor costs one stage at most.
A stage's folder is deleted once the next stage is written; that of the last stays.
All stages but the last return the columns of documents:

* quality: documents that the Kneser-Ney classifier rejects go;
* exact_dedup: of equal texts the smallest doc_id stays;
* simhash_golay: of each component of near-duplicates the smallest doc_id stays;
* mixing: documents are left out or repeated as the target weights of their sources ask;
* unigram_sp: whole texts become piece ids that decode to the text exactly.

Decisions of the first four stages hold for rows, told apart by digests of their ids and texts (and of
what else decides), so null and repeated ids are no matter. Rows that repeat all of these are one row
with several copies: exact_dedup leaves one, mixing takes them together. Null texts count as empty, and
the first stage keeps empty ones; very long texts are read whole in every stage; ties go to the smallest
id, then the smallest digest; an empty table passes through; other columns of documents are carried
along, whatever their names.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexquarry.llm._util import materialise, small_or_shuffled, table
from lexquarry.llm.exact_dedup import exact_dedup, normalised
from lexquarry.llm.kn_quality import quality
from lexquarry.llm.mixing import mix
from lexquarry.llm.simhash_golay import simhash_golay
from lexquarry.llm.unigram_sp import encode


def _sha(c: Column) -> Column:
    return F.coalesce(F.sha2(c.cast("string"), 256), F.lit("-"))


def _key(*digests: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws("/", *digests), 256))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that the documents don't have."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _without(docs: DataFrame, key: Column, gone: DataFrame, again: DataFrame | None = None) -> DataFrame:
    """Documents whose key is none of ``gone``, and one document only of each key in ``again``.

    Both have a column ``key`` and are broadcast if counted to be few.
    """
    columns, own, other = docs.columns, _free(docs, "_key"), _free(docs, "_of")
    docs = docs.withColumn(own, key)

    def those(keys: DataFrame, kind: str) -> DataFrame:
        keys = materialise(keys.select(F.col("key").alias(other)).distinct())
        return docs.join(small_or_shuffled(keys, keys.count()), F.col(own) == F.col(other), kind)

    docs = those(gone, "left_anti")
    if again is not None and not (again := materialise(again)).isEmpty():
        docs = those(again, "left_anti").unionByName(those(again, "left_semi").dropDuplicates([own]))
    return docs.select(*columns)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _key(_sha(docs["doc_id"]), _sha(docs["lang"]), _sha(docs["text"]))
    return _without(docs, key, quality(docs, table(spark, sf_dir, "labels"), key=key).where("not kept"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    verdict = exact_dedup(docs).where("not kept").select("doc_id", "keep_id", "text_sha256")
    verdict = materialise(verdict.select(_key(_sha(F.col("doc_id")), F.col("text_sha256")).alias("key"), F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("same")))
    # rows that repeat both id and text of the one that stays: all but one of them go
    return _without(docs, _key(_sha(docs["doc_id"]), F.sha2(normalised(docs["text"]), 256)), verdict.where("not same"), verdict.where("same"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key = _key(_sha(docs["doc_id"]), _sha(docs["text"]))
    verdict = materialise(simhash_golay(docs, key=key).select("key", "first"))
    again = verdict.where("first").groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return _without(docs, key, verdict.where("not first"), again)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of a document are equal rows."""
    own, other, n, rows = (_free(docs, x) for x in ("_key", "_of", "_copies", "_rows"))
    keyed = docs.withColumn(own, _key(_sha(docs["doc_id"]), _sha(docs["source"]), _sha(docs["text"])))
    copies = mix(keyed, id_col=own).groupBy(F.col(own).alias(other)).agg(F.sum("copies").alias(n), F.count(F.lit(1)).alias(rows))
    copies = materialise(copies)
    repeated = copies.where(F.col(rows) > 1).select(other)
    if not repeated.isEmpty():
        same = F.col(own) == F.col(other)
        keyed = keyed.join(repeated, same, "left_anti").unionByName(keyed.join(repeated, same, "left_semi").dropDuplicates([own]))
    taken = keyed.join(copies.where(F.col(n) > 0).drop(rows), F.col(own) == F.col(other))
    again = _free(docs, "_again")
    return taken.withColumn(again, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n)))).select(*docs.columns)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(docs.select("doc_id", "text"), public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("simhash_golay", near_stage),
    ("mixing", mixing_stage),
    ("unigram_sp", pieces_stage),
]

#: Perplexities, fingerprints and Viterbi search are beyond SQL; the tests use brute force instead.
ORACLE_SQL = None


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    if spark.sparkContext.getCheckpointDir() is None:
        materialise(spark.range(0))  # sets the folder where the cluster names none
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    read = None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        if read:
            _delete(spark, read)
        read = f"{folder}/{name}"
        docs = spark.read.parquet(read)
    return docs
