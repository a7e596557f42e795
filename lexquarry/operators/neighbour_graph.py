"""A kept index for nearest neighbours: a layered proximity graph per partition, as a table of links.

Rows are dealt evenly to partitions of about ``PART_ROWS``. In each, nodes of layer 0 are all rows and
every layer above holds one node in ``THIN`` of the one below; a node is linked to near nodes of its layer
that are not nearer to each other than to it, and back. The table has a row for each node with its unit
vector and its links by layer; it is written once and read by every search.

A search meets blocks of queries with partitions. Within a pair all queries descend together: greedily
through the upper layers, then with ``beam`` candidates kept on layer 0. Each pair gives its best ``n``, and
the best of all partitions are the answer. Similarities that were computed are counted.

Null, zero and non-finite vectors take no part. Ties go to smaller ids.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lexquarry.operators.ingest import written
from lexquarry.operators.retrieval import dot

#: Rows of a partition, links of a node (twice as many with those back), candidates for them, share of nodes in the next layer, queries that descend together.
PART_ROWS, LINKS, CANDIDATES, THIN, TOGETHER = 4_096, 16, 64, 16, 512
#: Candidates kept on layer 0.
BEAM = 96


def _near(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest others of each row, nearest first, and all similarities."""
    s = v @ v.T
    np.fill_diagonal(s, -np.inf)
    k = min(k, len(v) - 1)
    near = np.argpartition(-s, k - 1, axis=1)[:, :k] if k < len(v) - 1 else np.argsort(-s, axis=1)[:, :k]
    return np.take_along_axis(near, np.argsort(-np.take_along_axis(s, near, 1), axis=1, kind="stable"), 1), s


def _links(v: np.ndarray, links: int = LINKS) -> list[list[int]]:
    """Links of one layer: of the nearest candidates those that no kept one is nearer to, filled up by the nearest, and the links back."""
    m = len(v)
    if m == 1:
        return [[]]
    near, s = _near(v, CANDIDATES)
    kept = np.full((m, links), -1)
    size = np.zeros(m, int)
    rows = np.arange(m)
    for fill in (False, True):
        for r in range(near.shape[1]):
            c = near[:, r]
            open_ = size < links
            beside = np.where(kept >= 0, s[c[:, None], kept], -np.inf).max(axis=1)
            same = (kept == c[:, None]).any(axis=1)
            take = open_ & ~same & (fill | (beside < s[rows, c]))
            kept[rows[take], size[take]] = c[take]
            size[take] += 1
    back: list[list[int]] = [[] for _ in range(m)]
    out = [k[:n].tolist() for k, n in zip(kept, size)]
    for i, own in enumerate(out):
        for j in own:
            back[j].append(i)
    for i in range(m):
        known = set(out[i])
        more = sorted((j for j in back[i] if j not in known), key=lambda j: (-s[i, j], j))
        out[i] = out[i] + more[:links]
    return out


def build_graph(vectors: DataFrame, id_col: str = "id", vec_col: str = "embedding", part_rows: int = PART_ROWS) -> DataFrame:
    """(part, node, id, vec, links): the index as a frame; write it to keep it."""
    norm = F.sqrt(dot(F.col(vec_col), F.col(vec_col)))
    rows = vectors.where(norm.isNotNull() & (norm > 0) & (norm < float("inf"))).select(F.col(id_col).alias("id"), F.transform(vec_col, lambda x: (x / norm).cast("float")).alias("vec"))
    rows = written(rows.withColumn("_n", F.monotonically_increasing_id()))
    parts = max(1, -(-rows.count() // part_rows))
    dealt = rows.select(F.pmod(F.xxhash64("_n"), F.lit(parts)).cast("int").alias("part"), "id", "vec")
    kind = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("node", T.IntegerType()), T.StructField("id", vectors.schema[id_col].dataType), T.StructField("vec", T.ArrayType(T.FloatType())), T.StructField("links", T.ArrayType(T.ArrayType(T.IntegerType())))])

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", kind="stable", ignore_index=True)
        v = np.stack(pdf["vec"].to_numpy()).astype(np.float32)
        order = np.random.default_rng(0).permutation(len(v))  # a prefix of this is a layer
        by_node: list[list[list[int]]] = [[] for _ in range(len(v))]
        size = len(v)
        while True:
            nodes = np.sort(order[:size])
            for i, own in zip(nodes.tolist(), _links(v[nodes])):
                by_node[i].append(nodes[own].tolist() if own else [])
            if size <= THIN:
                break
            size //= THIN
        return pd.DataFrame({"part": key[0], "node": np.arange(len(v)), "id": pdf["id"], "vec": list(v), "links": by_node})

    return dealt.groupBy("part").applyInPandas(one, kind)


class Graph:
    """One partition's graph in arrays."""

    def __init__(self, vec: np.ndarray, links: list):
        self.v = vec
        self.layers = []
        for layer in range(max(len(x) for x in links)):
            width = max([1, *(len(x[layer]) for x in links if len(x) > layer)])
            table = np.full((len(vec), width), -1)
            for i, x in enumerate(links):
                if len(x) > layer:
                    table[i, : len(x[layer])] = x[layer]
            self.layers.append(table)
        self.entries = np.flatnonzero([len(x) == len(self.layers) for x in links])

    def search(self, q: np.ndarray, n: int, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(nodes, similarities, computed similarities) of each query, best first; -1 where there are fewer."""
        rows = np.arange(len(q))
        first = q @ self.v[self.entries].T
        count = np.full(len(q), len(self.entries))
        at, best = self.entries[first.argmax(axis=1)], first.max(axis=1)
        for table in reversed(self.layers[1:]):
            moving = rows
            while len(moving):
                near = table[at[moving]]
                sims = np.where(near >= 0, np.einsum("qld,qd->ql", self.v[near], q[moving]), -np.inf)
                count[moving] += (near >= 0).sum(axis=1)
                k = sims.argmax(axis=1)
                top = sims[np.arange(len(moving)), k]
                better = top > best[moving]
                moving, k, top, near = moving[better], k[better], top[better], near[better]
                at[moving], best[moving] = near[np.arange(len(moving)), k], top
        beam = max(beam, n)
        nodes, sims = np.full((len(q), beam), -1), np.full((len(q), beam), -np.inf, np.float32)
        nodes[:, 0], sims[:, 0] = at, best
        done = np.ones((len(q), beam), bool)
        done[:, 0] = False
        seen = np.zeros((len(q), len(self.v)), bool)
        seen[rows, at] = True
        active = rows
        while len(active):
            k = np.where(done[active], -np.inf, sims[active]).argmax(axis=1)
            done[active, k] = True
            near = self.layers[0][nodes[active, k]]
            fresh = (near >= 0) & ~seen[active[:, None], near]
            seen[np.repeat(active, fresh.sum(axis=1)), near[fresh]] = True
            count[active] += fresh.sum(axis=1)
            new = np.where(fresh, np.einsum("qld,qd->ql", self.v[near], q[active]), -np.inf)
            all_nodes, all_sims = np.concatenate([nodes[active], np.where(fresh, near, -1)], 1), np.concatenate([sims[active], new], 1)
            all_done = np.concatenate([done[active], ~fresh], 1)
            keep = np.argpartition(-all_sims, beam - 1, axis=1)[:, :beam]
            nodes[active], sims[active], done[active] = (np.take_along_axis(x, keep, 1) for x in (all_nodes, all_sims, all_done))
            active = active[(~done[active]).any(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")[:, :n]
        return np.take_along_axis(nodes, order, 1), np.take_along_axis(sims, order, 1), count


def graph_topk(graph: DataFrame, queries: DataFrame, n: int, beam: int = BEAM) -> tuple[DataFrame, DataFrame]:
    """The n most similar found of each query (query_id, query) as (query_id, id, similarity, rank); and (query_id, computed) similarities.

    Blocks of ``TOGETHER`` queries meet every partition, so a pair's memory is that of one partition and
    one block. Queries without a direction have no answer.
    """
    norm = F.sqrt(dot(F.col("query"), F.col("query")))
    own = queries.where(norm.isNotNull() & (norm > 0) & (norm < float("inf"))).select("query_id", F.transform("query", lambda x: (x / norm).cast("float")).alias("query"))
    own = written(own)
    blocks = max(1, -(-own.count() // TOGETHER))
    numbers = graph.agg(F.max("part")).first()[0]
    if numbers is None:
        none = own.where("false").select("query_id", F.lit(None).cast(graph.schema["id"].dataType).alias("id"), F.lit(0.0).alias("similarity"), F.lit(0).alias("rank"))
        return none, none.select("query_id", F.lit(0).cast("long").alias("computed"))
    asked = own.select(F.explode(F.sequence(F.lit(0), F.lit(numbers))).alias("p"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("b"), "query_id", "query")
    stored = graph.select("part", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "node", "id", "vec", "links")
    kind = T.StructType([T.StructField("query_id", queries.schema["query_id"].dataType), T.StructField("id", graph.schema["id"].dataType), T.StructField("similarity", T.DoubleType()), T.StructField("computed", T.LongType())])

    def pair(part: pd.DataFrame, some: pd.DataFrame) -> pd.DataFrame:
        if part.empty or some.empty:
            return pd.DataFrame({f.name: [] for f in kind}).astype({"similarity": float, "computed": "int64"})
        part = part.sort_values("node", ignore_index=True)
        found = Graph(np.stack(part["vec"].to_numpy()), part["links"].tolist())
        q = np.stack(some["query"].to_numpy())
        nodes, sims, count = found.search(q, min(n, len(part)), beam)
        keep = nodes >= 0
        who = np.repeat(np.arange(len(q)), keep.sum(axis=1))
        first = np.r_[True, who[1:] != who[:-1]]  # a query's count is on one of its rows
        exact = np.einsum("nd,nd->n", found.v[nodes[keep]].astype(float), q[who].astype(float))
        return pd.DataFrame({"query_id": some["query_id"].to_numpy()[who], "id": part["id"].to_numpy()[nodes[keep]], "similarity": exact, "computed": np.where(first, count[who], 0)})

    got = written(stored.groupBy("part", "block").cogroup(asked.groupBy("p", "b")).applyInPandas(pair, kind))
    best = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    top = got.withColumn("similarity", F.round("similarity", 6)).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n)
    return top.select("query_id", "id", "similarity", "rank"), got.groupBy("query_id").agg(F.sum("computed").alias("computed"))
