"""Mixing sources to target token weights by entropy balancing.

Of all document rates r >= 0 with sum(r * size) = target in each source, those nearest to 1 in
entropy are exponentially tilted: r = exp(lambda * size), cut at the largest allowed rate. The
convex dual in lambda is solved by Newton steps, kept inside a bracket, whose gradient and
curvature are distributed sums over the (source, size) histogram; sums are in fixed point, so
reruns agree bit by bit.

Rates become whole copies in blocks of about ``BLOCK_ROWS`` documents of a source: long documents
first, each takes the copies that bring the words taken in its block nearest to the words that the
rates ask for up to there. What a long document is off by is so made good by shorter ones, and a
block ends off by about half of its shortest document.

Everything is DataFrame expressions. The histogram and the per-source state stay distributed, sources
are numbered by ranges of their names and weights by a few sums; the driver sees one row a step.

Defined results: null texts have size 0; a null source is a source of its own, last in order;
sources without words get nothing; rows that repeat id, size and source share their copies evenly,
and which of them gets one more doesn't matter, since they are equal; documents of one size are
taken in order of their ids; very long texts are documents like others, so a source whose few
documents are long can be off its target by half of one; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm._util import join_unique, materialise, numbered, ranked, small_or_shuffled

MOST, BLOCK_ROWS = 3, 1_000


def n_words(text: Column) -> Column:
    """The number of runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """Adds ``target`` to (sid, total) rows, one per source; sid is its place in order from 0.

    Weights 1, 2, 3 repeat. Targets are level * weight, cut at MOST times the total; what is cut
    raises the level of the others, until none is above. The level is a ratio of whole numbers, so it
    doesn't depend on the order of summing.
    """
    ranked_ = sources.withColumn("weight", F.col("sid") % 3 + 1).withColumn("room", F.col("total") * MOST)
    ranked_ = materialise(ranked_)
    level, cut = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("room") < F.lit(level) * F.col("weight")
        r = ranked_.agg(F.sum("total").alias("all"), F.sum(F.when(over, F.col("room")).otherwise(0)).alias("cut"), F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("free"), F.count_if(over).alias("n")).first()
        if r["n"] == cut or not r["free"]:
            break
        level, cut = (r["all"] - r["cut"]) / r["free"], r["n"]
    return ranked_.withColumn("target", F.least(F.col("room").cast("double"), F.lit(level or 0.0) * F.col("weight"))).drop("weight", "room")


def tilts(sizes: DataFrame, sources: DataFrame, n_sources: int, steps: int = 60) -> DataFrame:
    """Adds ``lam`` and ``scale`` to (sid, total, target): the rate of a size is least(MOST, exp(lam * size / scale))."""
    hist = materialise(sizes.where("size > 0").groupBy("sid", "size").agg(F.count(F.lit(1)).alias("n")))
    span = hist.groupBy("sid").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("scale"), F.min("size").alias("least"))
    state = sources.join(span, "sid", "left").select(
        "sid", "total", "target", "scale",
        F.lit(0.0).alias("lam"),
        F.when(F.col("target") >= F.col("total"), F.lit(0.0)).otherwise(F.lit(-1e6)).alias("lo"),
        F.when(F.col("target") >= F.col("total"), F.lit(1.0001) * F.log(F.lit(float(MOST))) * F.col("scale") / F.col("least")).otherwise(F.lit(0.0)).alias("hi"),
        F.lit(False).alias("done"),
    )
    # where the target is all that may be taken, the dual has its solution at the upper end
    full = F.col("target") >= F.col("total") * MOST * (1 - 1e-9)
    state = materialise(state.withColumn("lam", F.when(full, F.col("hi")).otherwise(F.col("lam"))).withColumn("done", full | F.col("scale").isNull()))
    for _ in range(steps):
        x = F.col("size") / F.col("scale")
        rate = F.exp(F.least(F.col("lam") * x, F.lit(10.0)))
        held = F.least(rate, F.lit(float(MOST)))
        fixed = lambda c: F.sum((F.col("n") * F.col("size") * c * 1024).cast("long")) / 1024
        open_ = state.where("not done")
        sums = hist.join(small_or_shuffled(open_, n_sources), "sid").groupBy("sid").agg(fixed(held).alias("got"), fixed(F.when(rate < MOST, x * rate).otherwise(0.0)).alias("slope"))
        gap = F.col("got") - F.col("target")
        close = F.abs(gap) <= F.greatest(F.col("target") * 1e-6, F.lit(0.5))
        lo, hi = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo")), F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.try_divide(gap, F.col("slope"))
        middle = (lo + hi) / 2
        moved = F.when(close, F.col("lam")).when((newton > lo) & (newton < hi), newton).otherwise(middle)
        after = state.join(sums, "sid", "left").select(
            "sid", "total", "target", "scale",
            F.when(F.col("done"), F.col("lam")).otherwise(moved).alias("lam"),
            F.when(F.col("done"), F.col("lo")).otherwise(lo).alias("lo"),
            F.when(F.col("done"), F.col("hi")).otherwise(hi).alias("hi"),
            (F.col("done") | close).alias("done"),
        )
        state = materialise(after)
        if state.where("not done").isEmpty():
            break
    else:
        if not state.where("not done").isEmpty():
            raise RuntimeError("the dual did not settle")
    return state.select("sid", "total", "target", F.coalesce("scale", F.lit(1.0)).alias("scale"), "lam")


def _copies(items: Column) -> Column:
    """Copies of each of a block's items (size, n, rate), in order: an array as long as ``items``."""
    state = F.struct(F.lit(0.0).alias("short"), F.array().cast("array<long>").alias("copies"))

    def step(a: Column, x: Column) -> Column:
        asked = a["short"] + x["rate"] * x["size"] * x["n"]
        took = F.greatest(F.lit(0), F.least(F.floor(asked / F.greatest(x["size"], F.lit(1)) + 0.5), MOST * x["n"])).cast("long")
        took = F.when(x["size"] > 0, took).otherwise(0)
        return F.struct((asked - took * x["size"]).alias("short"), F.concat(a["copies"], F.array(took)).alias("copies"))

    return F.aggregate(items, state, step)["copies"]


def mix(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """One row per document: id, size, source_size, target, taken, copies (0 to MOST) and rate."""
    rows = docs.select(
        docs[id_col].alias("id"),
        F.when(docs[source_col].isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), docs[source_col].cast("string"))).alias("src"),
        n_words(docs[text_col].cast("string")).alias("size"),
        F.monotonically_increasing_id().alias("uid"),
    )
    rows = materialise(rows)
    per = rows.groupBy("src").agg(F.sum("size").alias("total"), F.count(F.lit(1)).alias("n_docs"))
    # "+" comes before "-", so the null source is last
    per = materialise(ranked(per, "src", "sid"))
    n_sources, n = per.count(), rows.count()
    sized = materialise(join_unique(rows, per.select("src", "sid", "n_docs"), "src", "n_docs", n).select("id", "uid", "size", "sid"))
    solved = tilts(sized, targets(per.select("sid", "total")), n_sources)
    solved = materialise(solved.join(small_or_shuffled(per.select("sid", "n_docs"), n_sources), "sid"))
    items = materialise(sized.groupBy("sid", "id", "size").agg(F.count(F.lit(1)).alias("n")))
    rated = join_unique(items, solved, "sid", "n_docs", n)
    rate = F.least(F.exp(F.least(F.col("lam") * F.col("size") / F.col("scale"), F.lit(10.0))), F.lit(float(MOST)))
    block = F.pmod(F.xxhash64("id", "size"), F.ceil(F.col("n_docs") / BLOCK_ROWS)).alias("block")
    item = F.struct((-F.col("size")).alias("_long"), "id", "size", "n", F.when(F.col("size") > 0, rate).otherwise(0.0).alias("rate"))
    blocks = rated.groupBy("sid", block).agg(F.first("total").alias("source_size"), F.first("target").alias("target"), F.array_sort(F.collect_list(item)).alias("items"))
    done = blocks.withColumn("copies", _copies(F.col("items"))).select("sid", "source_size", "target", F.explode(F.arrays_zip("items", "copies")).alias("x"))
    done = materialise(done.select("sid", "source_size", "target", "x.items.id", "x.items.size", "x.items.n", "x.items.rate", "x.copies"))
    out = ["id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate"]
    single = done.where("n = 1").select(*out)
    repeated = done.where("n > 1")
    if not repeated.isEmpty():
        key = F.struct("sid", "id", "size").alias("key")
        equal = materialise(join_unique(materialise(sized.select("uid", key)), materialise(repeated.select(key, "source_size", "target", "rate", "n", F.col("copies").alias("all"))), "key", "n", n).where("n is not null"))
        placed = numbered(equal, ["key"], ["uid"], [F.col("uid")], equal.count(), "k")
        copies = (F.floor((F.col("k") + 1) * F.col("all") / F.col("n")) - F.floor(F.col("k") * F.col("all") / F.col("n"))).cast("long")
        single = single.unionByName(placed.select("key.id", "key.size", "source_size", "target", "rate", copies.alias("copies")).select(*out))
    return single.withColumnRenamed("id", id_col)
