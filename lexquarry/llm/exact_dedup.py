"""Exact deduplication of an incoming batch against immutable snapshots.

A snapshot never changes, so each of its digest shards gets a static three-wise binary fuse
filter (Graf and Lemire, 2022), built once. Digests of an incoming batch are grouped among
themselves first, then screened shard by shard. What a filter rejects is new for certain; what
it lets pass joins the snapshot's exact buckets by the whole digest, and the texts of both
representatives are compared before the groups are merged.

Defined results: null texts count as empty; of equal texts the row with the smallest id stays,
and of repeated rows with that id exactly one; null ids come after all others; very long texts are
compared whole, and none is moved but a representative's; an empty table gives an empty result; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexquarry.llm._util import BROADCAST_ROWS, join_unique, materialise, small_or_shuffled

#: Digests of one shard, hence of one filter and one task; bits of the map of wanted ids (32 MB).
SHARD_KEYS, MAP_BITS = 50_000, 1 << 28


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _mix(keys: np.ndarray, seed: int) -> np.ndarray:
    h = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


class BinaryFuse:
    """A static filter of 16-bit prints over distinct 64-bit keys: no false negatives, 2**-16 false positives."""

    def __init__(self, seed: int, segment: int, segments: int, prints: np.ndarray):
        self.seed, self.segment, self.segments, self.prints = seed, segment, segments, prints

    @staticmethod
    def _slots(h: np.ndarray, segment: int, segments: int) -> np.ndarray:
        first = ((h >> np.uint64(32)) * np.uint64(segments * segment)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        second = (first + np.uint64(segment)) ^ ((h >> np.uint64(18)) & mask)
        third = (first + np.uint64(2 * segment)) ^ (h & mask)
        return np.stack([first, second, third]).astype(np.int64)

    @staticmethod
    def _print(h: np.ndarray) -> np.ndarray:
        return ((h ^ (h >> np.uint64(32))) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        keys = np.unique(keys.astype(np.uint64))
        n = max(2, len(keys))
        segment = 1 << max(2, min(18, int(math.log(n) / math.log(3.33) + 2.25)))
        factor = max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(n))
        segments = max(1, -(-int(n * factor + 0.5) // segment) - 2)
        for seed in range(1, 1000):
            h = _mix(keys, seed * 0x9E3779B97F4A7C15 % (1 << 64))
            order = cls._peel(cls._slots(h, segment, segments), (segments + 2) * segment)
            if order is None:
                continue
            slots, prints = cls._slots(h, segment, segments), np.zeros((segments + 2) * segment, np.uint16)
            own = cls._print(h)
            for at, slot in reversed(order):
                a, b, c = slots[:, at]
                prints[slot] = own[at] ^ prints[a] ^ prints[b] ^ prints[c]  # the key's own slot still holds 0
            return cls(seed, segment, segments, prints)
        raise RuntimeError("no seed peels this key set")

    @staticmethod
    def _peel(slots: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """Rounds of (keys, the slot that only this key still uses); None if keys remain."""
        n = slots.shape[1]
        degree = np.bincount(slots.ravel(), minlength=size)
        holder = np.zeros(size, np.int64)
        for row in slots:
            np.bitwise_xor.at(holder, row, np.arange(n))
        left, order = n, []
        single = np.flatnonzero(degree == 1)
        while len(single):
            at, pick = np.unique(holder[single], return_index=True)
            slot = single[pick]
            order.append((at, slot))
            left -= len(at)
            touched = slots[:, at]
            np.subtract.at(degree, touched.ravel(), 1)
            for row in touched:
                np.bitwise_xor.at(holder, row, at)
            near = np.unique(touched)
            single = near[degree[near] == 1]
        return order if left == 0 else None

    def contains(self, keys: np.ndarray) -> np.ndarray:
        h = _mix(keys.astype(np.uint64), self.seed * 0x9E3779B97F4A7C15 % (1 << 64))
        a, b, c = self._slots(h, self.segment, self.segments)
        return (self.prints[a] ^ self.prints[b] ^ self.prints[c]) == self._print(h)


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter row per shard of a snapshot with columns shard and key (long)."""

    def build(part: pa.Table) -> pa.Table:
        f = BinaryFuse.build(part.column("key").to_numpy().view(np.uint64))
        return pa.table({"shard": part.column("shard")[:1], "seed": [f.seed], "segment": [f.segment], "segments": [f.segments], "prints": [f.prints.tobytes()]})

    return snapshot.select("shard", "key").groupBy("shard").applyInArrow(build, "shard int, seed long, segment long, segments long, prints binary")


def screen(incoming: DataFrame, filters: DataFrame) -> DataFrame:
    """Adds ``maybe`` to incoming rows (shard, key, ...): false if the snapshot surely lacks the key."""
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in incoming.schema)}, maybe boolean"

    def run(rows: pa.Table, own: pa.Table) -> pa.Table:
        if rows.num_rows == 0 or own.num_rows == 0:
            return rows.append_column("maybe", pa.array([False] * rows.num_rows, pa.bool_()))
        f = own.to_pylist()[0]
        fuse = BinaryFuse(f["seed"], f["segment"], f["segments"], np.frombuffer(f["prints"], np.uint16))
        return rows.append_column("maybe", pa.array(fuse.contains(rows.column("key").to_numpy().view(np.uint64))))

    return incoming.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(run, schema)


def among(df: DataFrame, key: Column, wanted: DataFrame) -> DataFrame:
    """The rows of df whose ``key`` is perhaps among ``wanted`` (column ``key``), and few others.

    A bitmap of hashed keys, ``MAP_BITS`` at most whatever the number of keys, is broadcast; rows
    that it rules out go no further.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(MAP_BITS))
    bits = wanted.select(place(F.col("key")).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("_map"))
    at = df.withColumn("_at", place(key))
    met = at.join(F.broadcast(bits), F.bitmap_bucket_number("_at") == F.col("_bucket"))
    bit = F.bitmap_bit_position("_at")
    byte = F.conv(F.hex(F.substring("_map", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return met.where(F.getbit(byte, (bit % 8).cast("int")) == 1).drop("_at", "_bucket", "_map")


def _same_bytes(docs: DataFrame, pairs: DataFrame, n_pairs: int, id_col: str, text_col: str) -> DataFrame:
    """Digests of those pairs (digest, a, b: ids) whose two texts are the same byte by byte.

    Only the texts of representatives are fetched: their ids are broadcast if counted to be few; else
    a bitmap of them, and the texts that it lets pass are shuffled.
    """
    key = lambda i, digest: F.concat(F.coalesce(i.cast("string"), F.lit("-")).cast("binary"), digest)
    wanted = pairs.select("digest", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("id")), F.struct(F.lit(1).alias("side"), F.col("b").alias("id")))).alias("x")).select("digest", "x.side", key(F.col("x.id"), F.col("digest")).alias("_want"), F.coalesce(F.col("x.id").cast("string"), F.lit("-")).alias("key"))
    texts = docs.select(docs[id_col].alias("_have"), docs[text_col].alias("_text"))
    own = F.coalesce(F.col("_have").cast("string"), F.lit("-"))
    if 2 * n_pairs > BROADCAST_ROWS:
        texts = among(texts, own, wanted)
    else:
        texts = texts.join(F.broadcast(wanted.select(F.col("key").alias("_k")).distinct()), own == F.col("_k"), "left_semi")
    texts = texts.select("_have", normalised(F.col("_text")).alias("norm"))
    texts = texts.select(key(F.col("_have"), F.unhex(F.sha2("norm", 256))).alias("_key"), "norm")
    found = texts.join(small_or_shuffled(wanted, 2 * n_pairs), F.col("_key") == F.col("_want"))
    both = found.groupBy("digest").agg((F.min("norm") == F.max("norm")).alias("same"), F.min("side").alias("lo"), F.max("side").alias("hi"))
    return both.where("same and lo = 0 and hi = 1").select("digest")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", is_snapshot: Column | None = None) -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256.

    ``is_snapshot`` tells the rows of the immutable snapshot from the incoming batch; by default
    the snapshot is the lower half of the ids, or half of them by a hash where ids are no numbers. Shuffled are digests, never whole texts, but for
    the representatives of groups that snapshot and batch share, and the few that a map of their
    ids can't tell from them.
    """
    rows = docs.select(
        docs[id_col].alias("id"),
        F.unhex(F.sha2(normalised(docs[text_col]), 256)).alias("digest"),
        F.monotonically_increasing_id().alias("uid"),
        (is_snapshot if is_snapshot is not None else F.lit(None).cast("boolean")).alias("old"),
    )
    rows = materialise(rows)
    numbers = isinstance(docs.schema[id_col].dataType, T.NumericType)
    n, middle = rows.agg(F.count(F.lit(1)), F.percentile_approx("id", 0.5) if numbers else F.lit(None)).first()
    if is_snapshot is None:
        rows = rows.withColumn("old", F.coalesce(F.col("id") < F.lit(middle) if numbers else F.xxhash64("id") < 0, F.lit(False)))
    rows = rows.withColumn("old", F.coalesce("old", F.lit(False)))
    shards = max(32, -(-n // SHARD_KEYS))

    def groups(part: DataFrame) -> DataFrame:
        first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "uid")).alias("first")
        key = F.xxhash64("digest")
        return part.groupBy("digest").agg(first, F.count(F.lit(1)).alias("n")).select(F.pmod(key, F.lit(shards)).cast("int").alias("shard"), key.alias("key"), "digest", "first", "n")

    snapshot = materialise(groups(rows.where("old")))
    flat = groups(rows.where(~F.col("old"))).select("shard", "key", "digest", "first.*", "n")
    screened = screen(flat, build_filters(snapshot)).withColumn("first", F.struct("none", "id", "uid"))
    screened = materialise(screened.select("digest", "first", "n", "maybe"))
    bucket = snapshot.select("digest", F.col("first").alias("a"), F.col("n").alias("n_a"))
    pairs = materialise(screened.where("maybe").select("digest", F.col("first").alias("b"), F.col("n").alias("n_b")).join(bucket, "digest"))
    same = _same_bytes(docs, pairs.select("digest", F.col("a.id").alias("a"), F.col("b.id").alias("b")), pairs.count(), id_col, text_col)
    merged = pairs.join(same, "digest", "left_semi").select("digest", F.least("a", "b").alias("keep"), (F.col("n_a") + F.col("n_b")).alias("size"))

    def side(part: DataFrame, tag: int) -> DataFrame:
        """The final groups of one side's rows, by digest and side, so that no collision mixes them."""
        out = part.select("digest", "first", "n").join(merged, "digest", "left")
        return out.select(F.concat("digest", F.lit(bytes([tag]))).alias("gid"), F.coalesce("keep", "first").alias("keep"), F.coalesce("size", "n").alias("size"), "n")

    final = materialise(side(snapshot, 1).unionByName(side(screened, 0)))
    keyed = rows.withColumn("gid", F.concat("digest", F.when(F.col("old"), F.lit(b"\x01")).otherwise(F.lit(b"\x00"))))
    return join_unique(keyed, final, "gid", "n", n).select(
        F.col("id").alias(id_col),
        F.col("keep.id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("keep.uid") == F.col("uid")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
