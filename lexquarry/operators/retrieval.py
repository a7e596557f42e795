"""Filtered vector search, full-text search, fusion and the shaping of results.

Columns follow the chunk table (id, content, source, source_type, era, embedding, ...) unless a
parameter names another. Every order is total: ties end at an id or a position.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexquarry.functions.text import let
from lexquarry.operators.ingest import written

#: Repeated ids up to which they are broadcast.
BROADCAST_ROWS = 200_000
#: Reciprocal rank constant (Cormack, Clarke and Buettcher, 2009); BM25 parameters (Robertson and Zaragoza, 2009).
RRF_K, BM25_K1, BM25_B = 60, 1.2, 0.75
# Ranks of account types and transmission grades; anything else ranks as 5.
ACCOUNT_RANK = {"eyewitness": 1, "transmitted": 2, "later_compilation": 3, "commentary": 4}
CHAIN_RANK = {"sahih": 1, "hasan": 2, "daif": 3, "scholarly": 2, "unknown": 4}
NOISE_PENALTY = 10


def dot(a: Column, b: Column) -> Column:
    product = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(product, F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """In double precision; null for a zero or null vector."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_literal(q: Sequence[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in q])


def optional_filters(df: DataFrame, era: str | None = None, source_type: str | None = None, authenticated_only: bool = False, metadata: Column | None = None) -> DataFrame:
    """Only conditions that are asked for; they reach the scan."""
    conditions = []
    if era:
        conditions.append(F.col("era") == era)
    if source_type:
        conditions.append(F.col("source_type") == source_type)
    if authenticated_only:
        conditions.append((metadata if metadata is not None else F.get_json_object("metadata", "$.authentication")) == "classical_islamic")
    return df.where(reduce(lambda a, b: a & b, conditions)) if conditions else df


def exclude_noise(chunks: DataFrame, meta: DataFrame, id_col: str = "id") -> DataFrame:
    noise = meta.where(F.col("noise_flag")).select(F.col("chunk_id").alias("_noise"))
    return chunks.join(noise, chunks[id_col] == noise["_noise"], "left_anti")


def with_metadata(chunks: DataFrame, meta: DataFrame, id_col: str = "id", one_row: bool = False) -> DataFrame:
    """Left join; a chunk with several metadata rows is repeated unless ``one_row`` takes the one of smallest id."""
    meta = meta.select("chunk_id", "id", "account_type", "chain_strength", "conflict_flag").withColumnRenamed("id", "_meta_id")
    if one_row:
        meta = meta.groupBy("chunk_id").agg(*[F.min_by(c, "_meta_id").alias(c) for c in ("account_type", "chain_strength", "conflict_flag")])
    return chunks.join(meta.withColumnRenamed("chunk_id", "_chunk"), chunks[id_col] == F.col("_chunk"), "left").drop("_chunk", "_meta_id")


def vector_topk(chunks: DataFrame, query: Sequence[float], n: int, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """The n rows of largest cosine; a top-n per task and one merge, no full sort."""
    scored = chunks.where(F.col(vec_col).isNotNull()).withColumn("similarity", F.round(cosine(F.col(vec_col), vector_literal(query)), 6))
    return scored.orderBy(F.desc_nulls_last("similarity"), id_col).limit(n)


#: Queries and rows that are multiplied with each other at a time.
QUERY_BLOCK, ROW_BLOCK = 1_000, 20_000


def multi_query_topk(chunks: DataFrame, queries: DataFrame, n: int, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """Top n of each query (query_id, query) over all chunks, with the chunks' other columns.

    One plan whatever the number of queries: blocks of queries meet blocks of rows in a join on the two
    blocks' numbers, each pair is one product of matrices in double precision, and hands on n rows for
    each of its queries. A row without a direction comes last, without a similarity.
    """
    rows = chunks.where(F.col(vec_col).isNotNull())
    q_blocks, r_blocks = max(1, -(-queries.count() // QUERY_BLOCK)), max(1, -(-rows.count() // ROW_BLOCK))
    others = [c for c in rows.columns if c != vec_col]
    numbers = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    block = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")  # noqa: E731  a cogroup doesn't align the types of its keys, and equal numbers of two types are hashed apart
    doubles = lambda c: F.transform(c, lambda x: x.cast("double"))
    rows = rows.select(block(F.monotonically_increasing_id(), r_blocks).alias("_r"), numbers(q_blocks).alias("_q"), *others, doubles(vec_col).alias("_v"))
    asked = queries.select(block("query_id", q_blocks).alias("_qb"), numbers(r_blocks).alias("_rb"), "query_id", doubles("query").alias("_v"))
    kind = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), *[chunks.schema[c] for c in others], T.StructField("similarity", T.DoubleType())])

    def pair(some: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if some.empty or own.empty:
            return pd.DataFrame({f.name: pd.Series([], dtype=object) for f in kind})
        own, some = own.sort_values(id_col, kind="stable", ignore_index=True), some[some["_v"].notna()].reset_index(drop=True)
        x, q = (np.stack(df["_v"].to_numpy()) if len(df) else np.zeros((0, 1)) for df in (own, some))
        with np.errstate(divide="ignore", invalid="ignore"):
            sims = np.round(q @ x.T / np.linalg.norm(q, axis=1)[:, None] / np.linalg.norm(x, axis=1), 6) if len(q) else np.zeros((0, len(x)))
        order = np.argsort(-np.where(np.isnan(sims), -np.inf, sims), axis=1, kind="stable")[:, :n]  # ties stay in order of the ids
        who = np.repeat(np.arange(len(q)), order.shape[1])
        out = own.loc[order.ravel(), others].reset_index(drop=True)
        out.insert(0, "query_id", some["query_id"].to_numpy()[who])
        best = np.take_along_axis(sims, order, 1).ravel()
        out["similarity"] = pd.Series(best).astype(object).where(~np.isnan(best), None)
        return out

    found = asked.groupBy("_qb", "_rb").cogroup(rows.groupBy("_q", "_r")).applyInPandas(pair, kind)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc_nulls_last("similarity"), id_col))
    return found.withColumn("rank", rank).where(F.col("rank") <= n)


def by_account_types(chunks: DataFrame, meta: DataFrame, types: Sequence[str], id_col: str = "id") -> DataFrame:
    """Chunks that have a metadata row of one of these account types."""
    own = meta.where(F.col("account_type").isin(*types)).select(F.col("chunk_id").alias("_typed"))
    return chunks.join(own, chunks[id_col] == own["_typed"], "left_semi")


def gates(found: DataFrame, key: str = "query_id", least: int = 5, top: float = 0.70, first: int = 3, each: float = 0.65) -> DataFrame:
    """Per query of ranked results (rank, similarity): how many, the best score, the least of the first ones, and which gates they pass."""
    per = found.groupBy(key).agg(F.count(F.lit(1)).alias("results"), F.max("similarity").alias("best"), F.min(F.when(F.col("rank") <= first, F.col("similarity"))).alias("least_of_first"))
    return per.withColumns({"not_empty": F.col("results") > 0, "enough": F.col("results") >= least, "best_is_near": F.col("best") > top, "first_are_near": (F.col("results") >= first) & (F.col("least_of_first") >= each)})


def ann_topk(chunks: DataFrame, query: Sequence[float], n: int, tables: int = 8, bucket: float = 1.0, id_col: str = "id", vec_col: str = "embedding") -> DataFrame:
    """(id, distance): the n nearest to a unit vector found by locality-sensitive hashing, for corpora where an exact scan is too dear.

    Rows that share a bucket with the query in one of the hash tables are compared exactly. With these
    parameters the recall of the ten nearest among nearly uniform vectors is 0.96 or more; shorter
    buckets compare fewer rows and find fewer.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.linalg import Vectors

    v = chunks.where(F.col(vec_col).isNotNull()).select(id_col, array_to_vector(vec_col).alias("v"))
    model = BucketedRandomProjectionLSH(inputCol="v", outputCol="h", bucketLength=bucket, numHashTables=tables, seed=7).fit(v)
    norm = sum(x * x for x in query) ** 0.5
    return model.approxNearestNeighbors(v, Vectors.dense([x / norm for x in query]), n).select(id_col, F.round("distCol", 6).alias("distance"))


def merge_topics(found: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per chunk with the best score over the topics."""
    return found.groupBy(id_col).agg(F.max("similarity").alias("similarity"))


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def postings(chunks: DataFrame, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """(id, dl, term, tf): term counts with the length of the text.

    A row's words are counted in place, as runs of its sorted words; only rows that share their id meet, so
    where ids are unique nothing is shuffled.
    """
    own = chunks.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    again = written(own.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("id").alias("_again")))
    n = again.count()

    def runs(w: Column) -> Column:
        first = F.filter(F.sequence(F.lit(0), F.size(w) - 1), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1)))
        size = lambda i, end: (end - i).cast("long")
        return let(first, lambda f: F.transform(f, lambda i, k: F.struct(F.size(w).alias("dl"), F.get(w, i).alias("term"), size(i, F.coalesce(F.get(f, k + 1), F.size(w))).alias("tf"))))

    def counted(rows: DataFrame) -> DataFrame:
        """Words are named once, or the plan would find them again for each use."""
        return rows.select("id", F.inline(let(F.sort_array(tokens(F.col("text"))), lambda w: F.when(F.size(w) > 0, runs(w)))))

    if not n:
        return counted(own)
    hint = F.broadcast(again) if n <= BROADCAST_ROWS else again
    same = own["id"].eqNullSafe(hint["_again"])
    met = counted(own.join(hint, same, "left_semi")).groupBy("id", "dl", "term").agg(F.sum("tf").alias("tf"))
    return counted(own.join(hint, same, "left_anti")).unionByName(met)


def fts_topk(chunks: DataFrame, query: str, n: int, id_col: str = "id", text_col: str = "content") -> DataFrame:
    """BM25 over the distinct terms of the query.

    One scan of the texts counts the words and the query's terms in place; these numbers, a few per
    row, are written once and give document frequencies, mean length and scores.
    """
    terms = sorted(set(_query_terms(query)))
    lower, word = F.lower(F.col(text_col)), r"[\p{L}\p{N}]"
    counts = [F.regexp_count(lower, F.lit(rf"(?<!{word}){t}(?!{word})")) for t in terms]
    tf = written(chunks.select(F.col(id_col).alias("id"), F.regexp_count(lower, F.lit(f"{word}+")).alias("dl"), *[c.alias(f"tf{i}") for i, c in enumerate(counts)]))
    stats = tf.agg(F.count(F.lit(1)).alias("n_docs"), F.avg("dl").alias("avgdl"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
    joined = tf.where(reduce(lambda a, b: a | b, [F.col(f"tf{i}") > 0 for i in range(len(terms))])).crossJoin(F.broadcast(stats))

    def part(i: int) -> Column:
        t, df = F.col(f"tf{i}"), F.col(f"df{i}")
        idf = F.log(1 + (F.col("n_docs") - df + 0.5) / (df + 0.5))
        return idf * t * (BM25_K1 + 1) / (t + BM25_K1 * (1 - BM25_B + BM25_B * F.col("dl") / F.col("avgdl")))

    score = reduce(lambda a, b: a + b, [part(i) for i in range(len(terms))])
    return joined.select(F.col("id").alias(id_col), F.round(score, 6).alias("score")).orderBy(F.desc("score"), id_col).limit(n)


def _query_terms(query: str) -> list[str]:
    import re

    found = re.findall(r"[^\W_]+", query.lower())
    if not found:
        raise ValueError("the query has no terms")
    return found


def hybrid_rrf(lists: Sequence[DataFrame], n: int, id_col: str = "id", score_col: str = "score", k: int = RRF_K) -> DataFrame:
    """Fuses bounded candidate lists (id, score) by the sum of 1 / (k + rank)."""
    ranked = [df.select(id_col, F.row_number().over(Window.orderBy(F.desc(score_col), id_col)).alias("rank")) for df in lists]
    both = reduce(DataFrame.unionByName, ranked)
    fused = both.groupBy(id_col).agg(F.round(F.sum(1.0 / (F.lit(k) + F.col("rank"))), 6).alias("rrf_score"))
    return fused.orderBy(F.desc("rrf_score"), id_col).limit(n)


def merge_dedupe_prefix(lists: DataFrame, prefix: int = 100, text_col: str = "content") -> DataFrame:
    """Of rows (list_no, pos, ...) with the same first characters, the first in list order."""
    w = Window.partitionBy(F.substring(text_col, 1, prefix)).orderBy("list_no", "pos")
    return lists.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def merged_top(lists: DataFrame, n: int = 20, prefix: int = 100, text_col: str = "content", score_cols: Sequence[str] = ("score", "similarity_score")) -> DataFrame:
    """Merged rows by the first score that is there, else 0; ties keep list order."""
    score = F.coalesce(*[F.col(c) for c in score_cols], F.lit(0.0))
    return merge_dedupe_prefix(lists, prefix, text_col).withColumn("_s", score).orderBy(F.desc("_s"), "list_no", "pos").limit(n).drop("_s")


def fallback_broaden(first: DataFrame, broader: DataFrame, least: int = 5, prefix: int = 200, text_col: str = "content") -> DataFrame:
    """The first results; if fewer than ``least``, then the broader ones with unseen prefixes after them.

    Columns pos and list_no give the order. Both inputs are bounded result lists.
    """
    seen = F.substring(text_col, 1, prefix)
    few = first.agg((F.count(F.lit(1)) < least).alias("_few"))
    fresh = broader.join(first.select(seen.alias("_seen")).distinct(), F.substring(broader[text_col], 1, prefix) == F.col("_seen"), "left_anti")
    fresh = fresh.withColumn("_rn", F.row_number().over(Window.partitionBy(seen).orderBy("pos"))).where("_rn = 1").drop("_rn")
    return first.withColumn("list_no", F.lit(0)).unionByName(fresh.crossJoin(F.broadcast(few)).where("_few").drop("_few").withColumn("list_no", F.lit(1)))


def rank_value(account_type: Column, chain: Column, noise: Column) -> Column:
    pick = lambda c, table: reduce(lambda rest, kv: F.when(c == kv[0], kv[1]).otherwise(rest), table.items(), F.lit(5))
    return pick(account_type, ACCOUNT_RANK) + pick(F.coalesce(chain, F.lit("unknown")), CHAIN_RANK) + F.when(noise, NOISE_PENALTY).otherwise(0)


def rank_by_reliability(chunks: DataFrame, position: str = "pos") -> DataFrame:
    value = rank_value(F.col("account_type"), F.col("chain_strength"), F.col("noise_flag"))
    return chunks.withColumn("reliability_rank", value).orderBy("reliability_rank", position)


def source_map(accounts: DataFrame, score_col: str = "similarity_score") -> DataFrame:
    """Per source: how often, and the best score, at least 0."""
    return accounts.groupBy("source").agg(F.count(F.lit(1)).alias("count"), F.greatest(F.lit(0.0), F.max(score_col)).alias("max_score"))


def clean_chunk(chunks: DataFrame) -> DataFrame:
    """The columns and defaults of a search answer."""
    return chunks.select(
        "content", "source", "source_type", "era",
        F.round("similarity", 4).alias("score"),
        F.coalesce("chain_strength", F.lit("unknown")).alias("chain_strength"),
        F.coalesce("account_type", F.lit("unknown")).alias("account_type"),
        F.coalesce("conflict_flag", F.lit(False)).alias("conflict_flag"),
        F.coalesce(F.get_json_object("metadata", "$.authentication"), F.lit("")).alias("authentication"),
    )


def context_lines(chunks: DataFrame, chars: int = 600) -> DataFrame:
    """Adds ``line``: the head line of a chunk and the start of its text."""
    head = F.format_string("[SOURCE: %s | Era: %s | Chain: %s | Score: %.3f]\n", F.coalesce("source", F.lit("")), F.coalesce("era", F.lit("")), F.coalesce("chain_strength", F.lit("")), F.coalesce("score", F.lit(0.0)))
    return chunks.withColumn("line", F.concat(head, F.substring("content", 1, chars)))


def context_block(chunks: DataFrame, position: str = "pos", chars: int = 600) -> DataFrame:
    """One row: the lines of a bounded result list in order, a blank line between."""
    lines = context_lines(chunks, chars).agg(F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), "line"))).alias("a"))
    return lines.select(F.array_join(F.transform("a", lambda x: x["line"]), "\n\n").alias("context"))


def recent_turns(turns: DataFrame, n: int = 11, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """The last n turns of a conversation by users and assistants that aren't empty."""
    good = turns.where(F.col("role").isin("user", "assistant") & (F.trim("text") != ""))
    back = F.row_number().over(Window.partitionBy(conv).orderBy(F.desc(turn)))
    return good.withColumn("_back", back).where(F.col("_back") <= n).drop("_back")


def claim_presence(claims: DataFrame, meta: DataFrame) -> DataFrame:
    """Adds ``verdict`` to (figure_id, event_id) claims: CONFIRMED if one chunk has both, PARTIAL if some chunk has the figure, else NOT FOUND."""
    seen = meta.select(F.explode("figure_ids").alias("figure_id"), "event_id").distinct()
    both = seen.where("event_id is not null").withColumn("both", F.lit(True))
    one = seen.select("figure_id").distinct().withColumn("one", F.lit(True))
    return claims.join(both, ["figure_id", "event_id"], "left").join(one, "figure_id", "left").withColumn("verdict", F.when(F.col("both"), "CONFIRMED").when(F.col("one"), "PARTIAL").otherwise("NOT FOUND")).drop("both", "one")

