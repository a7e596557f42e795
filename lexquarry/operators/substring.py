"""A kept index for substring search: trigrams of texts, intersected, then verified.

Up to ``BLOCK`` documents make a block; an index row holds, of one trigram and block, which documents of
the block have it. A pattern's literal runs give the trigrams that any match must have: blocks that lack
one go first, from the rows' heads alone, then documents; what is left is compared with the pattern itself.
Texts are in lower case, so matches ignore case. Patterns without three literal characters in a row have
no trigram, and those of which more than a share ``COMMON`` of all documents are candidates would fetch
nearly every text one by one: both are compared with all texts in one scan instead.

The index is written where it is made, sorted by trigram within files; a trigram is one number of its
three code points. Null texts match nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexquarry.operators.ingest import written

#: Documents of a block, characters of a text that are looked at together, share of documents from which a scan is cheaper, and rows up to which a side is broadcast.
BLOCK, SPAN, COMMON, BROADCAST_ROWS = 512, 1 << 20, 0.02, 200_000
_BITS = 21


def _small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def text_trigrams(text: str) -> np.ndarray:
    """The distinct trigrams of a text as numbers; a long one is read in spans that overlap by two."""
    found = [np.zeros(0, np.int64)]
    for s in range(0, max(1, len(text) - 2), SPAN):
        c = np.frombuffer(text[s : s + SPAN + 2].encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        if len(c) > 2:
            found.append(np.unique(c[:-2] << 2 * _BITS | c[1:-1] << _BITS | c[2:]))
    return np.unique(np.concatenate(found)) if len(found) > 2 else found[-1]


def write_trigrams(docs: DataFrame, folder: str, id_col: str = "id", text_col: str = "content", block: int = BLOCK) -> None:
    """Writes the index (gram, block, n, ats, ids) as Parquet; rows with a null gram name the documents of a block."""
    kind = docs.schema[id_col].dataType
    out = T.StructType([*T._parse_datatype_string("gram long, block long, n int, ats array<int>").fields, T.StructField("ids", T.ArrayType(kind))])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rb in batches:
            schema = pa.schema([("gram", pa.int64()), ("block", pa.int64()), ("n", pa.int32()), ("ats", pa.list_(pa.int32())), ("ids", pa.list_(rb.column(0).type))])
            for i in range(0, rb.num_rows, block):
                own = rb.slice(i, block)
                grams = [text_trigrams(t or "") for t in own.column(1).to_pylist()]
                at, gram = np.repeat(np.arange(len(grams)), [len(g) for g in grams]), np.concatenate(grams)
                order = np.argsort(gram, kind="stable")
                gram, first, n = np.unique(gram[order], return_index=True, return_counts=True)
                size = len(grams)
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.array([number]), pa.array([size], pa.int32()), pa.nulls(1, schema.field("ats").type), pa.ListArray.from_arrays(pa.array([0, size], pa.int32()), own.column(0))], schema=schema)
                lists = pa.ListArray.from_arrays(pa.array(np.r_[first, len(at)], pa.int32()), pa.array(at[order], pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(gram), pa.array(np.full(len(gram), number)), pa.array(n, pa.int32()), lists, pa.nulls(len(gram), schema.field("ids").type)], schema=schema)
                number += 1

    rows = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("text")).mapInArrow(step, out)
    rows.sortWithinPartitions("gram", "block").write.parquet(folder)


def literal_runs(pattern: Column) -> Column:
    """The literal runs of a LIKE pattern in lower case; a backslash makes the next character literal."""
    marked = F.regexp_replace(F.lower(pattern), r"(?s)\\(.)|[%_]", "\u0000$1\u0001")  # escaped: NUL, itself, SOH; wild card: NUL, SOH
    parts = F.split(F.regexp_replace(marked, "\u0000([^\u0001])\u0001", "$1"), "\u0000\u0001")
    return F.filter(parts, lambda p: F.length(p) > 0)


def pattern_trigrams(pattern: Column) -> Column:
    """The distinct trigrams that a match of the pattern must have, as numbers."""
    point = lambda run, i: F.conv(F.hex(F.encode(F.substr(run, i, F.lit(1)), "UTF-32")), 16, 10).cast("long")
    gram = lambda run, i: F.shiftleft(point(run, i), 2 * _BITS).bitwiseOR(F.shiftleft(point(run, i + 1), _BITS)).bitwiseOR(point(run, i + 2))
    of_run = lambda run: F.when(F.length(run) > 2, F.transform(F.sequence(F.lit(1), F.length(run) - 2), lambda i: gram(run, i))).otherwise(F.array().cast("array<bigint>"))
    return F.array_distinct(F.flatten(F.transform(literal_runs(pattern), of_run)))


def matching(spark: SparkSession, folder: str, docs: DataFrame, patterns: DataFrame, id_col: str = "id", text_col: str = "content") -> tuple[DataFrame, DataFrame]:
    """(pattern_id, id) of the documents whose text is LIKE a pattern (pattern_id, pattern), whatever the case; and (pattern_id, candidates) of those looked up in the index.

    ``docs`` are those that the index was written from, with ids of their own.
    """
    own = written(patterns.select("pattern_id", "pattern", pattern_trigrams(F.col("pattern")).alias("grams")))
    index = spark.read.parquet(folder)
    asked = written(own.select("pattern_id", F.size("grams").alias("k"), F.explode("grams").alias("gram")))
    heads = index.select("gram", "block").join(_small(asked), "gram")
    blocks = written(heads.groupBy("pattern_id", "block", "k").agg(F.count(F.lit(1)).alias("n")).where("n = k").drop("n"))
    held = index.select("gram", "block", "ats").join(_small(asked), "gram").join(_small(blocks.select("pattern_id", "block")), ["pattern_id", "block"])
    places = held.select("pattern_id", "block", "k", F.explode("ats").alias("at")).groupBy("pattern_id", "block", "k", "at").agg(F.count(F.lit(1)).alias("n")).where("n = k")
    names = index.where("gram is null").select("block", "ids")
    found = written(places.join(names, "block").select("pattern_id", F.get("ids", F.col("at")).alias("_id")))
    total = index.where("gram is null").agg(F.sum("n")).first()[0] or 0
    counts = written(found.groupBy("pattern_id").agg(F.count(F.lit(1)).alias("candidates")))
    common = _small(counts.where(F.col("candidates") > COMMON * total).select("pattern_id"))
    rare = written(found.join(common, "pattern_id", "left_anti"))
    text = docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("_text"))
    low = own.select("pattern_id", F.lower("pattern").alias("_like"))
    like = F.expr("_text LIKE _like")
    looked_up = text.join(_small(rare), F.col("id") == F.col("_id")).join(_small(low), "pattern_id").where(like)
    rest = own.where(F.size("grams") == 0).select("pattern_id").unionByName(counts.where(F.col("candidates") > COMMON * total).select("pattern_id"))
    scanned = text.join(_small(written(low.join(_small(rest), "pattern_id"))), like)
    return looked_up.select("pattern_id", "id").unionByName(scanned.select("pattern_id", "id")), counts
