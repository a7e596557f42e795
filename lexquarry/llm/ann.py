"""Approximate nearest neighbours by learned partitions.

A bounded sample gives a neighbour graph, which is cut into balanced parts (recursive spectral
bisection at the median, then balanced swaps). A small classifier learns to tell in which parts a
vector's neighbours lie; it places every row into its most probable part and routes each query to
several of the most probable parts, where all rows are scored exactly (Dong et al., 2020).

The number of probed parts is the smallest whose recall on held-out sample queries, against
brute force within the sample, reaches ``AIM``. Parts grow in number with the rows, and the sample
with the parts. Parts that turn out large are dealt into blocks of at most ``BLOCK_BYTES`` of rows
and of queries, so a vector that holds a third of all rows is spread over many tasks; a row is sent
once for each block of queries of its part, a query once for each block of the parts it probes. Each
block passes on its best k for each query.

Nearness is the largest inner product, summed in order of the components in double precision;
ties go to the smaller id.

Defined results: vectors that are null, empty, zero, or that hold null or non-finite components take
no part, nor do rows with a null id; vectors of another length than most are compared with those of
their own length, all of them; rows that repeat an id count once, with the best score of their
vectors, and a query that repeats an id has one answer, of its vectors' best scores; a query with
fewer candidates gets all of them; very long vectors make blocks of few rows; an empty table gives
an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.llm._util import materialise, small_or_shuffled

#: Parts of usual tables, rows that a part has at least, and rows from which there are more parts; sample
#: rows at least and for each part, and the most parts.
PARTS, LEAST_ROWS, PART_ROWS, SAMPLE, SAMPLE_PART, MOST_PARTS = 16, 30, 50_000, 4_000, 64, 1_024
NEIGHBOURS, HIDDEN, AIM = 12, 96, 0.93
#: Bytes of vectors in a block; pairs scored at a time.
BLOCK_BYTES, TILE = 32 << 20, 4 << 20


def usable(c: Column) -> Column:
    """The vector as doubles, or null if it takes no part."""
    v = c.cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(v.isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0), v)


def inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products summed component by component, so that equal vectors have equal scores anywhere."""
    out = np.zeros(len(rows))
    for d in range(rows.shape[1]):
        out += rows[:, d] * query[d]
    return out


def _neighbours(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest of each sample row by inner product, itself left out."""
    k, out = min(k, len(x) - 1), []
    for at in range(0, len(x), step := max(1, TILE // len(x))):
        s = (x[at : at + step] @ x.T).astype(np.float32)
        s[np.arange(len(s)), np.arange(at, at + len(s))] = -np.inf
        out.append(np.argpartition(-s, k - 1, axis=1)[:, :k])
    return np.concatenate(out)


def _edges(near: np.ndarray) -> np.ndarray:
    """The neighbour graph, each edge in both directions once: rows (from, to)."""
    n, k = near.shape
    a, b = np.repeat(np.arange(n), k), near.ravel()
    both = np.unique(np.r_[a * n + b, b * n + a])
    return np.stack([both // n, both % n])


def balanced_parts(edges: np.ndarray, n: int, parts: int, rng: np.random.Generator) -> np.ndarray:
    """Part numbers of the graph's n nodes; sizes differ by about one."""
    label, place = np.zeros(n, np.int64), np.zeros(n, np.int64)

    def cut(nodes: np.ndarray, own: np.ndarray, count: int, first: int) -> None:
        if count <= 1 or len(nodes) < 2:
            label[nodes] = first
            return
        m = len(nodes)
        place[nodes] = np.arange(m)
        a, b = place[own]
        times = lambda v: np.bincount(a, v[b], m)
        degree = np.bincount(a, minlength=m)
        scale = 1 / np.sqrt(np.maximum(degree, 1))
        flat = 1 / scale
        flat /= np.linalg.norm(flat)
        v = rng.standard_normal(m)
        for _ in range(60):
            v = v - flat * (flat @ v)
            v = 0.5 * (v + scale * times(scale * v))
            v /= np.linalg.norm(v) + 1e-30
        left = np.zeros(m, bool)
        left[np.argsort(v * scale, kind="stable")[: m * (count // 2) // count]] = True
        linked = np.sort(a * m + b)
        for _ in range(20):  # swap the pairs that gain most, so that sizes stay
            to_left = times(left.astype(float))
            gain = np.where(left, degree - 2 * to_left, 2 * to_left - degree)
            out, into = (side[np.argsort(-gain[side], kind="stable")] for side in (np.flatnonzero(left), np.flatnonzero(~left)))
            k = min(len(out), len(into), max(1, m // 50))
            out, into = out[:k], into[:k]
            pair = out * m + into
            joined = len(linked) and linked[np.minimum(np.searchsorted(linked, pair), len(linked) - 1)] == pair
            pick = gain[out] + gain[into] - 2 * joined > 0
            if not pick.any():
                break
            before = (left[a] != left[b]).sum()
            left[out[pick]], left[into[pick]] = False, True
            if (left[a] != left[b]).sum() >= before:
                left[out[pick]], left[into[pick]] = True, False
                break
        in_left = left[a] & left[b]
        in_right = ~left[a] & ~left[b]
        cut(nodes[left], own[:, in_left], count // 2, first)
        cut(nodes[~left], own[:, in_right], count - count // 2, first + count // 2)

    cut(np.arange(n), edges, parts, 0)
    return label


class Router:
    """A classifier with one hidden layer; gives the log odds of every part.

    ``near`` are the parts of each row's neighbours and of itself, whose shares it learns.
    """

    def __init__(self, x: np.ndarray, near: np.ndarray, parts: int, rng: np.random.Generator, steps: int = 400, rate: float = 0.01):
        self.mean, self.scale = x.mean(0), x.std() + 1e-12
        z = (x - self.mean) / self.scale
        w = [rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]), np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
        m, s = [0 * p for p in w], [0 * p for p in w]
        for step in range(1, steps + 1):
            pick = rng.integers(0, len(z), min(len(z), 1024))
            a, y = z[pick], near[pick]
            h = np.maximum(a @ w[0] + w[1], 0)
            o = h @ w[2] + w[3]
            p = np.exp(o - o.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            np.subtract.at(p, (np.arange(len(y))[:, None], y), 1 / y.shape[1])
            p /= len(y)
            back = (p @ w[2].T) * (h > 0)
            for i, g in enumerate((a.T @ back, back.sum(0), h.T @ p, p.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                s[i] = 0.99 * s[i] + 0.01 * g * g
                w[i] = w[i] - rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(s[i] / (1 - 0.99**step)) + 1e-8)
        self.w = w

    def odds(self, x: np.ndarray) -> np.ndarray:
        w = self.w
        return np.maximum(((x - self.mean) / self.scale) @ w[0] + w[1], 0) @ w[2] + w[3]


def fit(sample: np.ndarray, parts: int, k: int, seed: int = 7) -> tuple[Router, np.ndarray]:
    """The router, and the recall by number of probed parts of a tenth of the sample, held out for that."""
    rng = np.random.default_rng(seed)
    held = np.arange(len(sample)) % 10 == 0
    x = sample[~held]
    near = _neighbours(x, NEIGHBOURS)
    label = balanced_parts(_edges(near), len(x), parts, rng)
    router = Router(x, label[np.c_[np.arange(len(x)), near]], parts, rng)
    home = router.odds(sample).argmax(1)
    order = np.argsort(-router.odds(sample[held]), axis=1, kind="stable")
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(parts)[None, :], axis=1)
    met = np.zeros(parts)
    for at, i in enumerate(np.flatnonzero(held)):
        s = sample @ sample[i]
        s[i] = -np.inf
        true = np.argpartition(-s, min(k, len(s) - 1) - 1)[: min(k, len(s) - 1)]
        met += np.bincount(place[at, home[true]], minlength=parts)  # the probe at which each true neighbour is met
    return router, np.cumsum(met) / met.sum()


def _best(x: np.ndarray, xi: np.ndarray, query: np.ndarray, near: np.ndarray, starts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of one query. Rows are sorted by id, ``near`` are rough scores, ``starts`` where ids begin."""
    by_id = np.maximum.reduceat(near, starts) if len(starts) < len(near) else near
    m = min(k, len(by_id))
    slack = 1e-9 * max(1.0, float(np.abs(by_id[np.isfinite(by_id)]).max(initial=0.0)))
    keep = (near >= np.partition(by_id, len(by_id) - m)[len(by_id) - m] - slack) & (near > -np.inf)
    exact, ids = inner(x[keep], query), xi[keep]
    order = np.lexsort((ids, -exact))
    _, first = np.unique(ids[order], return_index=True)
    top = order[np.sort(first)[:k]]
    return ids[top], exact[top]


def search(vectors: DataFrame, k: int = 20, query: Column | None = None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id, score): the k nearest found of each row for which ``query`` holds (default: id divisible by 20)."""
    is_query = query if query is not None else vectors[id_col] % 20 == 0
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), usable(vectors[vec_col]).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("v is not null and id is not null")
    lengths = rows.groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not lengths:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(id_col), F.lit(0.0).alias("score"))
    dim, n = lengths[0]
    rows = materialise(rows)
    usual, others = rows.where(F.size("v") == dim), rows.where(F.size("v") != dim)
    parts = int(max(1, min(max(PARTS, -(-n // PART_ROWS)), MOST_PARTS, n // LEAST_ROWS)))
    router, probes = None, 1
    if parts > 1:
        most = max(SAMPLE, SAMPLE_PART * parts)
        # twice the sample by a hash, so that the tasks don't each send a whole one
        share = min(1 << 30, -(-2 * most * (1 << 30) // n))
        drawn = usual.select("id", "v").where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share)
        sample = drawn.orderBy(F.xxhash64("id"), "id").limit(most).collect()
        router, recall = fit(np.array([r["v"] for r in sample]), parts, k)
        probes = int(np.argmax(recall >= AIM)) + 1

    def home(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, dim)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array((router.odds(x).argmax(1) if router else np.zeros(len(x))).astype(np.int32))], ["id", "v", "q", "part"])

    # after the parts of the usual length, one part for each other length
    lengths = others.select(F.size("v").alias("d")).distinct().withColumn("part", (F.lit(parts - 1) + F.row_number().over(Window.orderBy("d"))).cast("int"))
    lengths = materialise(lengths)
    odd = others.join(small_or_shuffled(lengths, lengths.count()), F.size("v") == F.col("d")).select("id", "v", "q", "part")
    placed = materialise(usual.mapInArrow(home, "id long, v array<double>, q boolean, part int").unionByName(odd))
    count = lambda df: {r["part"]: (r["n"], r["d"]) for r in df.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).collect()}  # noqa: E731  # at most MOST_PARTS and the lengths
    sizes = count(placed)
    size_of = np.array([sizes.get(p, (0, 0))[0] for p in range(parts)])

    def route(batches):
        for b in batches:
            x = b.column(1).flatten().to_numpy().reshape(-1, dim)
            order = np.argsort(-router.odds(x), axis=1, kind="stable") if router else np.zeros((len(x), 1), int)
            met = np.cumsum(size_of[order], axis=1) - size_of[order]
            row, col = np.nonzero((np.arange(parts)[None, :] < probes) | (met < 4 * k + 1))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(row)), b.column(1).take(pa.array(row)), pa.array(order[row, col].astype(np.int32))], ["id", "v", "part"])

    routed = placed.where((F.col("part") < parts) & F.col("q")).select("id", "v").mapInArrow(route, "id long, v array<double>, part int")
    asked = materialise(routed.unionByName(placed.where((F.col("part") >= parts) & F.col("q")).select("id", "v", "part")))
    asks = count(asked)
    last = max(parts, max(sizes) + 1)

    def blocks(counts: dict) -> Column:
        """How many blocks the rows or queries of a row's part make, by look-up in an array."""
        n_of = [max(1, -(-c * 8 * d // BLOCK_BYTES)) for c, d in (counts.get(p, (0, 0)) for p in range(last))]
        return F.element_at(F.array(*map(F.lit, n_of)), F.col("part") + 1)

    own = lambda counts: F.pmod(F.xxhash64("id", "v"), blocks(counts)).cast("int")
    every = lambda counts: F.explode(F.sequence(F.lit(0), (blocks(counts) - 1).cast("int")))
    left = placed.select("id", "v", "part", own(sizes).alias("rb")).select("*", every(asks).alias("qb"))
    right = asked.select("id", "v", "part", own(asks).alias("qb")).select("*", every(sizes).alias("rb"))

    def best(part: pa.Table, queries: pa.Table) -> pa.Table:
        qs, ids, scores = [], [], []
        if part.num_rows and queries.num_rows:
            mat = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
            x, y, xi, yi = mat(part), mat(queries), part.column("id").to_numpy(), queries.column("id").to_numpy()
            order = np.argsort(xi, kind="stable")
            x, xi = x[order], xi[order]
            starts = np.flatnonzero(np.r_[True, xi[1:] != xi[:-1]])
            for at in range(0, len(y), step := max(1, TILE // len(x))):
                near = y[at : at + step] @ x.T
                for i, row in enumerate(near, at):
                    row[np.searchsorted(xi, yi[i]) : np.searchsorted(xi, yi[i], "right")] = -np.inf
                    found, exact = _best(x, xi, y[i], row, starts, k)
                    qs.append(np.full(len(found), yi[i]))
                    ids.append(found)
                    scores.append(exact)
        cat = lambda a, t: pa.array(np.concatenate(a) if a else np.zeros(0), t)
        return pa.table({"query_id": cat(qs, pa.int64()), "id": cat(ids, pa.int64()), "score": cat(scores, pa.float64())})

    keys = ["part", "rb", "qb"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(best, "query_id long, id long, score double")
    # one shuffle by the query serves both the best score of each id and the rank
    found = found.repartition("query_id").groupBy("query_id", "id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
