"""A Merkle manifest of a dataset: leaves, a stored tree of digests per group and over groups, proofs.

A row's leaf is the digest of its fields. Leaves of a group (a source) ascend by id; every ``FAN``
consecutive nodes become one node above, until one is left, the group's subroot. Subroots in order of
their groups make a second tree of the same sort, whose last node is the root.

The node store lies outside memory: leaves are dealt out and sorted by ranges of (group, id), so a
group of any size spreads over many sorted runs, and numbered by the sizes of the runs before. A level is
one Parquet folder, ``level=k``, whose rows are the runs of ``FAN`` siblings at their coordinates (group,
number of the run), in order; each level is made by one pass over the level before. Proofs are merged
from the top down: a level's runs meet the node above them at their coordinates and hand the way to
the root on to their nodes, so each level is read once and no join is by group alone.

Defined results: a null field is ``-``, an empty one ``0:``; very long texts are digested whole; null
groups come first and are a group; rows of one group and id (null ids first) are ordered by their
leaves, and rows that are equal altogether are leaves of their own, side by side; an empty table has
no root and gives an empty result; other columns are ignored, whatever their names. A row without an
id is not tampered with.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.llm._util import materialise, shared_folder, small_or_shuffled

#: Nodes that become one.
FAN = 3
#: The fields of a document in a leaf, in order.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """SHA-256 of each field's byte count, a colon and its value; a hyphen for null."""
    part = lambda s: F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[part(f.cast("string")) for f in fields]), 256)


def _numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``idx``, the place in the group ``grp`` by ``order``, and ``n``, the group's size.

    Rows of one place in the order are told apart by a number that was written with them, so the
    ranges can split any group and any run of equal rows.
    """
    rows = materialise(rows.withColumn("_row", F.monotonically_increasing_id()))
    by = [F.col(c).asc_nulls_first() for c in ("grp", *order, "_row")]
    runs = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("_row")
    runs = materialise(runs.withColumn("_p", F.spark_partition_id()).withColumn("_m", F.monotonically_increasing_id()))
    sizes = runs.groupBy(F.col("grp").alias("_g"), F.col("_p").alias("_q")).agg(F.count(F.lit(1)).alias("_n"), F.min("_m").alias("_first"))
    own = Window.partitionBy("_g")
    before = own.orderBy("_q").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(sizes.select("_g", "_q", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_at"), F.sum("_n").over(own).alias("n")))
    same = F.col("grp").eqNullSafe(F.col("_g")) & (F.col("_p") == F.col("_q"))
    return runs.join(small_or_shuffled(starts, starts.count()), same).withColumn("idx", F.col("_m") - F.col("_first") + F.col("_at")).drop("_p", "_q", "_g", "_m", "_first", "_at")


def write_tree(rows: DataFrame, order: Sequence[str], folder: str, fan: int = FAN) -> int:
    """Writes the levels of the trees of all groups below ``folder`` and returns how many there are.

    ``rows`` has the columns grp, digest and others, which level 0 carries along. A level's row is
    (grp, run, n, nodes): ``n`` nodes has the group at this level; one node is the group's last.
    """
    carried = [c for c in rows.columns if c != "grp"]
    nodes, level = _numbered(rows, order), 0
    most = None
    while True:
        kept = F.array_sort(F.collect_list(F.struct("idx", *carried)))
        runs = nodes.groupBy("grp", F.expr(f"idx div {fan}").alias("run"), "n").agg(kept.alias("nodes"))
        path = f"{folder}/level={level}"
        runs.sortWithinPartitions(F.col("grp").asc_nulls_first(), "run").write.parquet(path)
        below = rows.sparkSession.read.schema(runs.schema).parquet(path)
        if most is None:
            most = below.agg(F.max("n")).first()[0] or 0
        level += 1
        if most <= 1:
            return level
        most, carried = -(-most // fan), ["digest"]
        digest = F.sha2(F.array_join(F.transform("nodes", lambda x: x["digest"]), ""), 256)
        nodes = below.where("n > 1").select("grp", F.col("run").alias("idx"), F.ceil(F.col("n") / fan).alias("n"), digest.alias("digest"))


def read_tree(spark: SparkSession, folder: str, levels: int) -> list[DataFrame]:
    return [spark.read.parquet(f"{folder}/level={k}") for k in range(levels)]


def last_nodes(levels: Sequence[DataFrame]) -> DataFrame:
    """(grp, digest): what remains of each group."""
    ends = [x.where("n = 1").select("grp", F.col("nodes")[0]["digest"].alias("digest")) for x in levels]
    out = ends[0]
    for x in ends[1:]:
        out = out.unionByName(x)
    return out


def proofs(levels: Sequence[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of level 0 with ``path``: for each level above, the siblings left and right of the way, up to the group's end and on by ``tops``.

    ``tops`` has a row for each group: grp, path (how its last node goes on) and columns that are handed down.
    """
    others = [c for c in tops.columns if c not in ("grp", "path")]
    tops = tops.withColumnRenamed("grp", "_g")
    own = F.col("grp").eqNullSafe(F.col("_g"))
    step = F.struct(
        F.array_join(F.slice("digests", F.lit(1), F.col("at")), "").alias("left"),
        F.array_join(F.slice("digests", F.col("at") + 2, F.size("digests")), "").alias("right"),
    )
    above = None
    for runs in reversed(levels):
        held = runs.where("n = 1").join(tops, own)
        if above is not None:
            higher = above.select(F.col("grp").alias("_g"), F.col("idx").alias("_i"), "path", *others)
            held = held.unionByName(runs.where("n > 1").join(higher, own & (F.col("run") == F.col("_i"))).drop("_i"))
        each = held.drop("_g").select("grp", "n", "path", *others, F.transform("nodes", lambda x: x["digest"]).alias("digests"), F.posexplode("nodes").alias("at", "node"))
        above = each.select("grp", "node.*", *others, F.when(F.col("n") > 1, F.concat(F.array(step), F.col("path"))).otherwise(F.col("path")).alias("path"))
    return above


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings make."""
    return F.aggregate(path, leaf, lambda below, s: F.sha2(F.concat(s["left"], below, s["right"]), 256))


def merkle(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source", text_col: str = "text", folder: str | None = None) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    The store goes to ``folder``, else to a new one beside the checkpoints. To show that proofs tell
    tampered rows from others, line feeds are deleted from the texts of rows whose id has an even CRC-32
    before their leaves are folded.
    """
    spark = docs.sparkSession
    folder = folder or f"{shared_folder(spark)}/merkle-{uuid.uuid4().hex}"
    column = {f: docs[f] for f in fields}
    changed = column | {text_col: F.replace(docs[text_col], F.lit("\n"), F.lit(""))}
    tampered = F.crc32(docs[id_col].cast("string")) % 2 == 0
    rows = docs.select(
        docs[group_col].alias("grp"), docs[id_col].alias("id"), leaf_digest(*column.values()).alias("digest"),
        F.when(tampered, leaf_digest(*changed.values())).alias("changed"),
    )
    tree = read_tree(spark, f"{folder}/rows", write_tree(rows, ["id", "digest"], f"{folder}/rows"))
    groups = last_nodes(tree).select(F.lit(0).alias("grp"), F.col("grp").alias("name"), "digest")
    over = read_tree(spark, f"{folder}/groups", write_tree(groups, ["name"], f"{folder}/groups"))
    end = last_nodes(over).first()
    root = F.lit(end["digest"] if end else None).cast("string")
    start = spark.range(1).select(F.lit(0).alias("grp"), F.array().cast("array<struct<left:string,right:string>>").alias("path"))
    tops = materialise(proofs(over, start).select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path"))
    out = proofs(tree, tops)
    folded = fold(F.coalesce("changed", "digest"), F.col("path"))
    proof = F.sha2(F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), ""), 256)
    out = out.select(F.col("id").alias(id_col), F.col("digest").alias("leaf"), "subroot", root.alias("root"), proof.alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
