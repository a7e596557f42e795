"""SimHash near-duplicates by Golay-code fuzzy hashing.

Two 64-bit fingerprints that differ in at most four bits are cut into three segments of 22, 21
and 21 bits, each read as a word of the perfect binary Golay code (23, 12). With errors a <= b
<= c in the segments, a + b <= 2, so by pigeonhole some two segments are hit (0, <= 2) or (1, 1):

* two words within two bits share an index among those that the words at most one bit from each
  decode to (their middle word does), at most six per word. Keys: one segment itself with these
  indices of another, for each ordered pair of segments;
* for (1, 1), one side offers the near indices of the first segment with the own index of the
  second, the other the reverse; both sides offer both.

That is some 64 keys a distinct fingerprint. Rows meet by key in sorted partitions, each meeting
is verified by its Hamming distance, and only links that a spanning forest needs are passed on,
so no group emits all its pairs. Components come from alternating star contraction.

A (1, 1) key leaves the third segment out, so it holds 24 bits: rows per key grow with the number of
distinct fingerprints, by some 60 per 10^9, and are compared within a key by sorted passes over them.

Defined results: a null text counts as empty and has fingerprint zero, linked like any other;
repeated rows share a component; null ids get the component of their text; a bit set in exactly half
of the hashes is 0; very long texts are read whole, their hashes counted in slices; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexquarry.llm._util import join_unique, materialise

SEED, SHINGLE, MOST = 42, 4, 4
SEGMENTS = ((42, 22), (21, 21), (0, 21))  # (shift, bits)
#: Fixed value: the generator polynomial of the binary Golay code.
_GENERATOR = 0b110001110101


@lru_cache(maxsize=1)
def _errors() -> np.ndarray:
    """By syndrome: the one word of at most three bits that has it."""
    rest = np.arange(1 << 23, dtype=np.int64)
    single = {}
    for i in range(23):
        r = 1 << i
        for bit in range(22, 10, -1):
            if r >> bit & 1:
                r ^= _GENERATOR << (bit - 11)
        single[i] = r
    del rest
    table = np.zeros(1 << 11, np.int64)
    for i in range(23):
        table[single[i]] = 1 << i
        for j in range(i):
            table[single[i] ^ single[j]] = 1 << i | 1 << j
            for k in range(j):
                table[single[i] ^ single[j] ^ single[k]] = 1 << i | 1 << j | 1 << k
    return table


def decode(words: np.ndarray) -> np.ndarray:
    """The 12-bit index of the codeword nearest to each 23-bit word."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= (rest >> bit & 1) * (_GENERATOR << (bit - 11))
    return (words ^ _errors()[rest]) >> 11


def near_indices(words: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Per word, sorted, the indices that it and its neighbours in ``bits`` bits decode to; a mask of the distinct ones."""
    every = np.stack([decode(words), *(decode(words ^ (1 << i)) for i in range(bits))], axis=1)
    every.sort(axis=1)
    fresh = np.ones(every.shape, bool)
    fresh[:, 1:] = every[:, 1:] != every[:, :-1]
    return every, fresh


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row numbers, keys) of all meeting places of the fingerprints."""
    words = [(prints >> np.uint64(s)).astype(np.int64) & ((1 << b) - 1) for s, b in SEGMENTS]
    own = [decode(w) for w in words]
    near = [near_indices(w, b) for w, (_, b) in zip(words, SEGMENTS)]
    rows, out, kind = [], [], 0

    def put(left: np.ndarray, right: np.ndarray, mask: np.ndarray) -> None:
        row, col = np.nonzero(mask)
        rows.append(row)
        out.append(np.int64(kind << 40) | np.broadcast_to(left, mask.shape)[row, col] << 12 | np.broadcast_to(right, mask.shape)[row, col])

    for i in range(3):
        for j in range(3):
            if i != j:
                put(words[i][:, None], near[j][0], near[j][1])
                kind += 1
    for i in range(3):
        for j in range(i + 1, 3):
            put(near[i][0], own[j][:, None], near[i][1])
            put(own[i][:, None], near[j][0], near[j][1])
            kind += 1
    return np.concatenate(rows), np.concatenate(out)


def fingerprint(text: str) -> int:
    """A bit is 1 if it is set in over half the hashes of the shingles of a whole text, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words), initial=0))
    n = max(1, len(words) - SHINGLE + 1)
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    span = list(zip(ends, (e - 1 for e in ends[SHINGLE:]))) if len(words) >= SHINGLE else [(0, len(joined))]
    for at in range(0, n, 1 << 14):
        h = np.array([digest(joined[s:e], SEED) for s, e in span[at : at + (1 << 14)]], np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def _forest(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Links of a spanning forest over distinct fingerprints that met in one place."""
    left, right, rest = [], [], prints
    while len(rest):
        front, rest = [rest[0]], rest[1:]
        while front and len(rest):
            u = front.pop()
            near = np.bitwise_count(rest ^ u) <= MOST
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                left.append(np.full(len(found), u))
                right.append(found)
    return left, right


def _links(k: np.ndarray, f: np.ndarray, few: int = 8) -> pa.RecordBatch | None:
    """Verified links among rows sorted by key, then fingerprint."""
    if len(k):
        fresh = np.ones(len(k), bool)
        fresh[1:] = (k[1:] != k[:-1]) | (f[1:] != f[:-1])
        k, f = k[fresh], f[fresh]
    starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(k)])
    left, right = [], []
    for at in np.flatnonzero(sizes > few):
        a, b = _forest(f[starts[at] : starts[at] + sizes[at]])
        left += a
        right += b
    small = np.repeat((sizes > 1) & (sizes <= few), sizes)
    k, f = k[small], f[small]
    for d in range(1, few):
        hit = np.flatnonzero((k[d:] == k[:-d]) & (np.bitwise_count(f[d:] ^ f[:-d]) <= MOST)) if len(k) > d else []
        if len(hit):
            left.append(f[hit])
            right.append(f[hit + d])
    if not left:
        return None
    a, b = np.concatenate(left).view(np.int64), np.concatenate(right).view(np.int64)
    pairs = np.unique(np.stack([np.maximum(a, b), np.minimum(a, b)], axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])


def links(prints: DataFrame) -> DataFrame:
    """Links (u > v) among distinct fingerprints (column fp), enough of them to connect every component."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy()
            for at in range(0, len(every), 4096):
                fp = every[at : at + 4096]
                row, key = keys(fp.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row])], ["key", "fp"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, f = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            k = np.r_[k, batch.column(0).to_numpy()]
            f = np.r_[f, batch.column(1).to_numpy().view(np.uint64)]
            cut = np.searchsorted(k, k[-1])  # the last run may go on
            if cut and (out := _links(k[:cut], f[:cut])) is not None:
                yield out
            k, f = k[cut:], f[cut:]
        if (out := _links(k, f)) is not None:
            yield out

    met = prints.select("fp").mapInArrow(emit, "key long, fp long").repartition("key").sortWithinPartitions("key", "fp")
    return met.mapInArrow(meet, "u long, v long")


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v); root is the smallest node of its component.

    Alternates large and small star contraction (Kiveris et al., 2014) until nothing changes. Every
    round is written to the shared folder; the driver sees two sums a round.
    """
    state = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    def with_least(links: DataFrame, least: Column) -> tuple[DataFrame, DataFrame]:
        """(the links with the least neighbour m of u, every u with its m). A node of many links is not joined in one task."""
        low = materialise(links.groupBy("u").agg(least.alias("m"), F.count(F.lit(1)).alias("n")))
        return join_unique(links, low, "u", "n", low.agg(F.sum("n")).first()[0] or 0).drop("n"), low.select("u", "m")

    for _round in range(most):
        both = materialise(state.unionByName(state.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        near, _ = with_least(both, F.least(F.min("v"), F.first("u")))
        large = materialise(near.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        near, low = with_least(large, F.min("v"))
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        state = materialise(small.where("u <> v").distinct())
        now = tuple(state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return state.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = now
    raise RuntimeError("components did not settle")


def simhash_golay(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key: Column | None = None) -> DataFrame:
    """One row per document: id, fingerprint (16 hex digits), component_id (the smallest id reachable).

    With a binary ``key`` of the rows, also that and ``first``: whether it is the key of the component's
    smallest id (nulls last), the smallest such key.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                fp = np.array([fingerprint(t or "") for t in part.column(1).to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fp.view(np.int64)), part.column(2)], ["id", "fp", "key"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"), (F.lit(None).cast("binary") if key is None else key).alias("key")).mapInArrow(run, f"id {kind}, fp long, key binary")
    rows = materialise(rows)
    prints = materialise(rows.groupBy("fp").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"), F.count(F.lit(1)).alias("n")))
    found = components(links(prints))
    rooted = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = materialise(rooted)
    lowest = materialise(rooted.groupBy("root").agg(F.min("first").alias("keep"), F.count(F.lit(1)).alias("prints")))
    placed = materialise(join_unique(rooted, lowest, "root", "prints", rooted.count()).select("fp", "n", "keep"))
    out = join_unique(rows, placed, "fp", "n", rows.count())
    own = [] if key is None else ["key", (F.col("key") == F.col("keep.key")).alias("first")]
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("keep.id").alias("component_id"), *own)
