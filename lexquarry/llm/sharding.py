"""Sharding by a k-d tree over metadata.

A node that must yield k shards is split along its widest metadata dimension at the weighted
quantile that leaves the room of its first k // 2 shards on one side, until every leaf is one
shard. The quantiles are exact to a set share of a leaf: histograms of all rows, refined bin by
bin, whose size is shards x bins whatever the number of rows. Names are dimensions by their rank
among the distinct ones.

Documents of equal text go to one shard. A group over a ``PIECE``-th of a leaf would spoil the balance
of the tree; there are at most shards x PIECE of them, and they are placed whole, heaviest first,
into the emptiest shard, and the tree shares out the room that is left. Only a group that fits whole
into no shard, as one heavier than a leaf, is split: its rows are points of their own, told apart
by a hash.

Defined results: null texts have size 1 and count as empty, null metadata sort first; repeated
rows are rows with slots of their own, equal but for these; equal metadata are told apart by a hash
of the text, so there are no ties between texts; very long texts are points like others, and are
groups by themselves where they are heavy; an empty table gives an empty result; other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm._util import BROADCAST_ROWS, join_unique, materialise, numbered, ranked

PIECE, BINS, NEAR = 16, 2048, 0.0005
_SIDE = 1 << 30


def _within(cuts: dict[int, tuple[str, int]], node: int) -> Column:
    """Whether a row falls into a node; node i has children 2i and 2i + 1, the root is 1."""
    out = F.lit(True)
    while node > 1:
        dim, cut = cuts[node // 2]
        out = out & (F.col(dim) >= cut if node % 2 else F.col(dim) < cut)
        node //= 2
    return out


def _choose(cuts: dict[int, tuple[str, int]], values: dict) -> Column:
    """The value of the node, among disjoint ones, into which a row falls; null if into none."""
    return F.coalesce(*[F.when(_within(cuts, i), v) for i, v in values.items()])


def _by_rank(rows: DataFrame, name: str, n: int) -> DataFrame:
    """A string dimension replaced by the rank of its value among the distinct ones, null first."""
    of = rows.groupBy(name).agg(F.count(F.lit(1)).alias("_n"))
    of = materialise(ranked(of, name, "_rank").withColumn("_of", F.coalesce(F.concat(F.lit("+"), name), F.lit("-"))).select("_of", "_rank", "_n"))
    rows = rows.withColumn("_of", F.coalesce(F.concat(F.lit("+"), name), F.lit("-")))
    found = rows.join(F.broadcast(of), "_of", "left") if of.count() <= BROADCAST_ROWS else join_unique(materialise(rows), of, "_of", "_n", n)
    return found.withColumn(name, F.col("_rank").cast("double")).drop("_of", "_rank", "_n")


def _whole(heavy: list[tuple[int, int]], shards: int, leaf: float) -> tuple[dict[int, int], list[float]]:
    """(shard of each heavy group that fits whole, room left by shard) from (weight, group)."""
    room, at = [leaf] * shards, {}
    for w, g in sorted(heavy, reverse=True):
        i = max(range(shards), key=lambda j: (room[j], -j))
        if w <= room[i]:
            room[i] -= w
            at[g] = i
    return at, room


def kd_shards(docs: DataFrame, shards: int = 16, dims: dict[str, Column] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``bytes``).

    ``dims`` are expressions on ``docs``, numbers or names; by default source, lang and size.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    dims = dims or {"source": docs["source"], "lang": docs["lang"], "size": F.log2(F.octet_length(text) + 1)}
    names = [f"d{i}" for i in range(len(dims))]
    rows = docs.select(
        docs[id_col].alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("crc"),
        F.xxhash64(text).alias("g"),
        F.monotonically_increasing_id().alias("uid"),
        *[c.alias(d) for d, c in zip(names, dims.values())],
    )
    rows = materialise(rows)
    n = rows.count()
    for d in names:
        rows = _by_rank(rows, d, n) if rows.schema[d].dataType.typeName() == "string" else rows.withColumn(d, F.coalesce(F.col(d).cast("double"), F.lit(-1.0)))
    rows = materialise(rows)
    total, *ends = rows.agg(F.sum("size"), *[f(d) for d in names for f in (F.min, F.max)]).first()
    total = total or 0
    groups = materialise(rows.groupBy("g").agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"), *[F.min(d).alias(f"g_{d}") for d in names]))
    joined = join_unique(rows, groups, "g", "n", n)
    leaf = total / shards
    heavy = [(r["w"], r["g"]) for r in groups.where(F.col("w") > max(1.0, leaf / PIECE)).select("w", "g").collect()]  # shards x PIECE at most
    whole, room = _whole(heavy, shards, leaf)
    of = lambda gs, value: F.element_at(F.create_map(*[F.lit(x) for g in gs for x in (g, value(g))]), F.col("g")) if gs else F.lit(None)
    split = [g for _, g in heavy if g not in whole]
    alone = F.coalesce(of(split, lambda g: True), F.lit(False))
    tie = F.pmod(F.xxhash64(F.when(alone, F.xxhash64("id", "uid")).otherwise(F.col("g")), F.lit(7)), F.lit(1 << 32))
    spans = {d: (lo, max(hi - lo, 1e-9)) for d, lo, hi in zip(names, ends[::2], ends[1::2]) if lo is not None}
    at = {d: F.floor((F.when(alone, F.col(d)).otherwise(F.col(f"g_{d}")) - lo) / width * (_SIDE - 1)) * (1 << 32) + tie for d, (lo, width) in spans.items()}
    # repeated rows of one text are spread over blocks of the numbering by the place they were read at
    near = F.when(F.col("n") > 1000, F.col("uid"))
    points = materialise(joined.select("id", "uid", "size", "crc", near.alias("near"), of(whole, whole.get).cast("int").alias("whole"), *[at.get(d, tie).cast("long").alias(d) for d in names]))
    free = points.where("whole is null")
    cuts, parts, depth = {}, {1: (0, shards)}, 0
    while any(b - a > 1 for i, (a, b) in parts.items() if i.bit_length() == depth + 1):
        open_ = {i: ab for i, ab in parts.items() if ab[1] - ab[0] > 1 and i.bit_length() == depth + 1}
        stats = free.groupBy(_choose(cuts, {i: F.lit(i) for i in open_}).alias("node")).agg(F.sum("size").alias("w"), *[f(d).alias(f"{f.__name__}_{d}") for d in names for f in (F.min, F.max)]).collect()
        found = {r["node"]: r for r in stats}
        state = {}
        for i, (a, b) in open_.items():
            middle = a + (b - a) // 2
            parts[2 * i], parts[2 * i + 1] = (a, middle), (middle, b)
            if r := found.get(i):
                dim = max(names, key=lambda d: (r[f"max_{d}"] >> 32) - (r[f"min_{d}"] >> 32))
                share = sum(room[a:middle]) / max(sum(room[a:b]), 1e-9)
                state[i] = {"dim": dim, "lo": r[f"min_{dim}"], "hi": r[f"max_{dim}"] + 1, "below": 0, "want": r["w"] * share, "w": r["w"]}
            else:
                state[i] = {"dim": names[0], "lo": 0, "hi": 1, "done": 0}
        while todo := {i: s for i, s in state.items() if "done" not in s}:
            _refine(free, cuts, todo, NEAR * leaf)
        for i in open_:
            cuts[i] = (state[i]["dim"], state[i]["done"])
        depth += 1
    reached = _choose(cuts, {i: F.lit(a) for i, (a, b) in parts.items() if b - a == 1})
    placed = numbered(points.withColumn("shard", F.coalesce("whole", reached).cast("int")), ["shard"], ["id", "crc", "near"], [F.col("id"), F.col("crc"), F.col("uid")], n, "slot")
    return placed.select(F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def _refine(points: DataFrame, cuts: dict, todo: dict[int, dict], near: float) -> None:
    """One pass over all rows: narrows each node's interval to the bin that holds its quantile."""
    step = {i: max(1, -(-(s["hi"] - s["lo"]) // BINS)) for i, s in todo.items()}
    held = lambda i, s: (F.col(s["dim"]) >= s["lo"]) & (F.col(s["dim"]) < s["hi"])
    bins = {i: F.when(held(i, s), F.lit(i * BINS) + F.expr(f"({s['dim']} - {s['lo']}L) div {step[i]}L")) for i, s in todo.items()}
    counted = points.select(_choose(cuts, bins).alias("bin"), "size").where("bin is not null").groupBy("bin").agg(F.sum("size").alias("w")).collect()
    of = {i: [] for i in todo}
    for r in sorted(counted):
        of[r["bin"] // BINS].append((r["bin"] % BINS, r["w"]))
    for i, s in todo.items():
        below, b, w = s["below"], 0, 0
        for b, w in of[i]:
            if below + w >= s["want"]:
                break
            below += w
        lo = s["lo"] + b * step[i]
        hi = min(s["hi"], lo + step[i])
        under, over = s["want"] - below, below + w - s["want"]
        if min(under, over) <= near or step[i] == 1:
            s["done"] = lo if under <= over else hi
        else:
            s |= {"lo": lo, "hi": hi, "below": below}
