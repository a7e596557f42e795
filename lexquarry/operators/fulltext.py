"""A kept inverted index: postings in blocks of documents, and top-k search that skips blocks.

``write_index`` reads texts once and exchanges nothing. Documents are numbered in the order they are
stored in; up to ``BLOCK`` of them make a block, and an index row holds one term's postings of one block
(places in the block, term frequencies, lengths) with the block's frontier for that term: the postings that
no other beats in both frequency and length. The largest BM25 weight of the block is reached on its
frontier whatever the mean length, so blocks can be added later and bounds stay exact. A row of the empty
term holds a block's ids. The engine splits texts into words; Arrow batches of these are grouped as arrays,
since a row for each word would cost several times as much.

``search`` answers many queries at once. It reads frontiers of the queries' terms, bounds each block
by the sum of its largest weights, scores the ``n`` blocks of highest bound, and then only those others
whose bound reaches the n-th score found: no other document can be among the best. The result is the
exact top-k.

Each file holds its documents' blocks, sorted by term, so a filter on terms skips row groups and a
frequent term is spread over all files.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexquarry.operators.ingest import written
from lexquarry.operators.retrieval import BM25_B, BM25_K1, tokens

#: Documents of a block.
BLOCK = 256
#: Distinct terms up to which a filter is handed to the scan, and rows up to which a query side is broadcast.
PUSHED_TERMS, BROADCAST_ROWS = 2_000, 200_000
#: What rounding may take from a bound.
_SLACK = 1e-6


def _weight(tf: Column, dl: Column, mean: Column) -> Column:
    """BM25 without the idf."""
    return tf * (BM25_K1 + 1) / (tf + BM25_K1 * (1 - BM25_B + BM25_B * dl / mean))


def frontiers(term: np.ndarray, tf: np.ndarray, dl: np.ndarray) -> np.ndarray:
    """Which postings (ordered by term) none of their term beats: by length, those with more occurrences than all shorter ones. Their places, by term and length."""
    order = np.lexsort((-tf, dl, term))
    wide = np.int64(tf.max() + 1) if len(tf) else 1
    rank = np.cumsum(np.r_[0, np.diff(term[order]) != 0]) if len(tf) else order
    most = np.maximum.accumulate(rank * wide + tf[order])  # a term's numbers are above those of the terms before
    return order[np.r_[True, most[1:] > most[:-1]]] if len(tf) else order


def _block(words: pa.ListArray, ids: pa.Array, number: int, schema: pa.Schema) -> pa.RecordBatch:
    """The index rows of one block."""
    dl = words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = words.flatten().dictionary_encode()
    order = pa.compute.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    at = np.repeat(np.arange(len(dl)), dl)
    keys, tf = np.unique(rank[coded.indices.to_numpy()] * len(dl) + at, return_counts=True)
    term, at = np.divmod(keys, max(1, len(dl)))
    best = frontiers(term, tf, dl[at])
    n = np.bincount(term, minlength=len(order))
    held = np.bincount(term[best], minlength=len(order))
    lists = lambda values, sizes, kind: pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int32()), pa.array(values, kind))
    head = pa.RecordBatch.from_arrays([pa.array([""]), pa.array([number]), pa.array([len(dl)], pa.int32()), *[pa.nulls(1, schema.field(c).type) for c in ("frontier", "ats", "tfs")], lists(dl, [len(dl)], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(dl)], pa.int32()), ids)], schema=schema)
    rows = pa.RecordBatch.from_arrays([
        coded.dictionary.take(pa.array(order)), pa.array(np.full(len(order), number)), pa.array(n, pa.int32()), lists(dl[at[best]] << 32 | tf[best], held, pa.int64()),
        lists(at, n, pa.int32()), lists(tf, n, pa.int32()), lists(dl[at], n, pa.int32()), pa.nulls(len(order), schema.field("ids").type),
    ], schema=schema)
    return pa.Table.from_batches([head, rows]).combine_chunks().to_batches()[0]


def index_rows(docs: DataFrame, id_col: str = "id", text_col: str = "content", block: int = BLOCK) -> DataFrame:
    """(term, block, n, frontier, ats, tfs, dls, ids); a posting of the frontier is length * 2**32 + frequency."""
    kind = docs.schema[id_col].dataType
    ints, fields = pa.list_(pa.int32()), "term string, block long, n int, frontier array<long>, ats array<int>, tfs array<int>, dls array<int>"

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for rb in batches:
            schema = pa.schema([("term", pa.string()), ("block", pa.int64()), ("n", pa.int32()), ("frontier", pa.list_(pa.int64())), ("ats", ints), ("tfs", ints), ("dls", ints), ("ids", pa.list_(rb.column(0).type))])
            for i in range(0, rb.num_rows, block):
                own = rb.slice(i, block)
                yield _block(own.column(1), own.column(0), number, schema)
                number += 1

    out = T.StructType([*T._parse_datatype_string(fields).fields, T.StructField("ids", T.ArrayType(kind))])
    return docs.select(F.col(id_col).alias("id"), tokens(F.col(text_col)).alias("w")).mapInArrow(step, out)


def write_index(docs: DataFrame, folder: str, id_col: str = "id", text_col: str = "content", block: int = BLOCK) -> None:
    """Writes the index as Parquet; an existing folder is an error."""
    rows = index_rows(docs, id_col, text_col, block).sortWithinPartitions("term", "block")
    rows.write.option("parquet.bloom.filter.enabled#term", "true").parquet(folder)


class Index:
    """A written index."""

    def __init__(self, spark: SparkSession, folder: str):
        self.rows = spark.read.parquet(folder)
        total = self.rows.where("term = ''").agg(F.sum("n").alias("docs"), F.sum(F.aggregate("dls", F.lit(0).cast("long"), lambda a, x: a + x)).alias("words")).first()
        self.docs, self.mean = total["docs"] or 0, (total["words"] or 0) / max(1, total["docs"] or 0)

    def _of_terms(self, terms: DataFrame) -> DataFrame:
        """Index rows of the terms; a filter where these are few, so that row groups are skipped."""
        names = [r["term"] for r in terms.select("term").distinct().limit(PUSHED_TERMS + 1).collect()]
        return self.rows.where(F.col("term").isin(names)) if len(names) <= PUSHED_TERMS else self.rows

    def _heads(self, terms: DataFrame) -> DataFrame:
        """(term, block, n, frontier) of the terms, read once."""
        return written(self._of_terms(terms).select("term", "block", "n", "frontier").join(_small(terms.select("term").distinct()), "term", "left_semi"))

    def _asked(self, terms: DataFrame, heads: DataFrame) -> DataFrame:
        """(query_id, term, idf): terms of each query that some document has."""
        df = heads.groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.log(1 + (F.lit(self.docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return written(terms.join(_small(written(df)), "term").select("query_id", "term", idf.alias("idf")))

    def bounds(self, asked: DataFrame, heads: DataFrame | None = None) -> DataFrame:
        """(query_id, block, bound): the most that a document of the block can score."""
        heads = self._of_terms(asked).select("term", "block", "frontier") if heads is None else heads
        most = F.array_max(F.transform("frontier", lambda p: _weight(p.bitwiseAND((1 << 32) - 1), F.shiftright(p, 32), F.lit(self.mean))))
        return heads.join(_small(asked), "term").groupBy("query_id", "block").agg(F.sum(F.col("idf") * most).alias("bound"))

    def _scored(self, chosen: DataFrame, asked: DataFrame) -> DataFrame:
        """(query_id, id, score) of every document with a term in the chosen blocks (query_id, block)."""
        read = self._of_terms(asked).select("term", "block", "ats", "tfs", "dls").join(_small(asked), "term").join(_small(chosen), ["query_id", "block"])
        each = read.select("query_id", "block", "idf", F.explode(F.arrays_zip("ats", "tfs", "dls")).alias("p"))
        score = F.sum(F.col("idf") * _weight(F.col("p.tfs"), F.col("p.dls"), F.lit(self.mean)))
        scores = each.groupBy("query_id", "block", F.col("p.ats").alias("at")).agg(F.round(score, 6).alias("score"))
        names = self.rows.where("term = ''").select(F.col("block").alias("_b"), "ids")
        names = names.join(_small(chosen.select(F.col("block").alias("_b")).distinct()), "_b", "left_semi")
        return scores.join(names, F.col("block") == F.col("_b")).select("query_id", F.get("ids", F.col("at")).alias("id"), "score")

    def search(self, queries: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
        """The best n of each query (query_id, query) as (query_id, id, score, rank), ties to smaller ids; and (query_id, blocks, read).

        ``blocks`` have a term of the query, ``read`` of them were scored.
        """
        terms = written(queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term")))
        heads = self._heads(terms)
        asked = self._asked(terms, heads)
        place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "block"))
        bounds = written(self.bounds(asked, heads))
        first = written(bounds.withColumn("_rn", place).where(F.col("_rn") <= n).drop("_rn"))
        best = lambda df: df.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))).where(F.col("rank") <= n)
        found = written(best(self._scored(first, asked)))
        least = found.where(F.col("rank") == n).select("query_id", F.col("score").alias("least"))
        rest = bounds.join(first.select("query_id", "block"), ["query_id", "block"], "left_anti").join(_small(least), "query_id", "left")
        rest = written(rest.where(F.col("least").isNull() | (F.col("bound") >= F.col("least") - _SLACK)).select("query_id", "block"))
        both = found.drop("rank").unionByName(self._scored(rest, asked))
        read = reduce(DataFrame.unionByName, [first.select("query_id", "block"), rest]).groupBy("query_id").agg(F.count(F.lit(1)).alias("read"))
        return best(both), bounds.groupBy("query_id").agg(F.count(F.lit(1)).alias("blocks")).join(read, "query_id")


def _small(df: DataFrame) -> DataFrame:
    """Broadcast if counted to be few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
