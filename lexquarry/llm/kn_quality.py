"""Quality by the perplexity of an interpolated modified Kneser-Ney trigram model.

The model is trained on trusted text (labelled good and not toxic), all of it but what is held out
to set thresholds. Its counts are tables sharded by the middle word of a trigram, so the
trigram, its context, its continuation bigram and that one's context meet in one shard; frequent
middle words are spread over several shards by their left neighbour, with their bigrams copied.
Documents are scored by joining their trigrams with these shards: a batch of documents sends each
shard its sorted trigrams and gets back packed partial sums of log probabilities, which are added up
batch by batch. Counts, joins and scores cover all text; what is moved grows with it.

The vocabulary is open: every word has its own counts in all three orders. The ``VOCABULARY`` most
frequent words of the trusted text are listed and have short numbers, and their unigrams go to every
worker; any other word has a number by a hash of ``_HASH`` bits, and its unigram is in a sharded table
that grows with the text. A bigram that was seen carries the unigram of its last word. Of one that
wasn't, the unigram is a factor, whose logarithm the shard of the last word adds. What the unigrams
leave over is shared evenly by all numbers, so a word that the trusted text lacks is as unlikely as
one of 2**_HASH spellings. A Bloom filter of the unlisted words, of at most ``FILTER_SEGMENTS``
segments, spares most trigrams whose middle word is unknown the way to a shard, where nothing would
be found; a word that it lets pass wrongly, and all words once it is full, take that way with the
same result.

Shards grow with the trusted text and with the documents. Where they would hold more than
``SALT_BYTES`` of the documents each, batches of documents are dealt to several copies of a shard.
So a task reads one shard of the model and a bounded share of the documents, whatever their number.
Documents are scored in ``TURNS``, each a share of them by a hash against the whole model, and what a turn
shuffled is deleted when it ends: their trigrams take more room than their texts do in Parquet, and only
a turn's lie on disk at a time. Tables between the jobs go as soon as nothing reads them.

Of each language a tenth of the trusted documents is held out, more (up to half) where that would be
under ``HELD_DOCS`` documents. A document is rejected if its perplexity exceeds a quantile of the
held-out trusted documents of its language and its length class. Where these are fewer than ``LEAST_HELD``, the language decides
over all lengths: by the quantile of the distances of its log perplexities from their median, which
are taken to shrink with the square root of the tokens up to ``LENGTHS[1]``. Where the language has
fewer than ``LEAST_HELD`` too, its own median stays and the distances are those of all languages from
their medians; a language without any takes the median of all. Only if fewer than ``LEAST_HELD`` were
held out altogether, there is no threshold and all stay.

Defined results: null and empty texts have no tokens and are kept; a null language is a language
of its own; repeated rows are scored alike; without trusted text everything is kept; a perplexity
equal to its threshold is kept; very long texts are scored whole, in a batch of their own; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from lexquarry.llm._util import Kept, materialise, shuffles_freed, small_or_shuffled

VOCABULARY, QUANTILE, LEAST_HELD = 16_000, 0.999, 40
#: Held out of a language: this share of its trusted documents, or so many, but no more than that share.
HELD, HELD_DOCS, HELD_MOST = 0.1, 100, 0.5
#: Trusted tokens that a shard has the trigrams of, and the least number of shards; tokens and
#: documents gathered before a batch is sent; keys in one row.
SHARD_TOKENS, LEAST_SHARDS, BATCH_TOKENS, BATCH_DOCS, ROW_KEYS = 16_000_000, 36, 600_000, 10_000, 100_000
#: Bytes of documents that a shard is made for, the most shards made for their sake, and the bytes from
#: which a shard has several copies.
SHARD_BYTES, MOST_BY_BYTES, SALT_BYTES = 128 << 20, 4096, 512 << 20
#: Turns in which documents are scored.
TURNS = 4
#: Bits of a segment of the filter, words that it is made for, and the most segments (32 MB).
SEGMENT_BITS, SEGMENT_WORDS, FILTER_SEGMENTS = 1 << 19, 40_000, 512
#: Length classes by tokens; short documents have widely spread perplexities.
LENGTHS = (12, 40, 120, 400)
_BITS, _MASK = 15, (1 << 15) - 1
_TOKEN = re.compile(r"\w+|[^\w\s]+")
#: The start of a text; numbers other than those of listed words; where numbers by hash begin.
_START, _HASH = 0, 31
_FIRST, _RARE = 1 + (1 << _HASH), 1 << _BITS
#: The number of every word that the filter doesn't know; numbers by hash are larger.
_UNKNOWN = _RARE
_MODEL3, _MODEL2, _MODEL1, _META, _QUERY, _QUERY1, _STATS, _UNIGRAM = range(8)
_SCHEMA = "shard int, kind int, a binary, b binary, batch long, pos int, uid long, id {kind}, lang string, n long, key binary"


def word_class(w: str) -> int:
    """The number of a word that isn't listed, from 1."""
    return 1 + (xxhash.xxh3_64_intdigest(w.encode()) & (1 << _HASH) - 1)


def pack(x: np.ndarray, sorted_: bool = True) -> bytes:
    """Differences of a sorted column, or another column itself, byte plane by byte plane, compressed."""
    d = np.diff(x.astype(np.int64), prepend=np.int64(0)) if sorted_ else x.astype(np.int64)
    wide = next(w for w in (1, 2, 4, 8) if len(d) == 0 or (d.min() >= -(1 << 8 * w - 1) and d.max() < 1 << 8 * w - 1))
    planes = np.ascontiguousarray(d.astype(f"i{wide}").view(np.uint8).reshape(-1, wide).T)
    return bytes([wide if sorted_ else wide | 16]) + zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def unpack(b: bytes) -> np.ndarray:
    wide, raw = b[0] & 15, np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8)
    d = np.ascontiguousarray(raw.reshape(wide, -1).T).view(f"i{wide}").ravel().astype(np.int64)
    return d if b[0] & 16 else np.cumsum(d)


def pack_all(first: np.ndarray, *others: np.ndarray) -> bytes:
    """A sorted column and others, each after its length."""
    parts = [pack(first), *[pack(x, False) for x in others]]
    return b"".join(len(x).to_bytes(4, "little") + x for x in parts)


def unpack_all(b: bytes) -> list[np.ndarray]:
    at, out = 0, []
    while at < len(b):
        n = int.from_bytes(b[at : at + 4], "little")
        out.append(unpack(b[at + 4 : at + 4 + n]))
        at += 4 + n
    return out


def pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Two numbers of at most 32 bits in one of 64."""
    return x << 32 | y


def halves(k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (k.view(np.uint64) >> np.uint64(32)).astype(np.int64), k & 0xFFFFFFFF


def trigram(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of a pair and a word; trigrams of one shard are too few to share one."""
    x = context.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) + last.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (x ^ (x >> np.uint64(32))).view(np.int64)


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a place of each distinct value, in ascending order; which of them each value is)."""
    order = np.argsort(x)
    new = np.ones(len(x), bool)
    new[1:] = x[order[1:]] != x[order[:-1]]
    back = np.empty(len(x), np.int64)
    back[order] = np.cumsum(new) - 1
    return order[new], back


class Shards:
    """Where trigrams go: by middle word; of frequent ones, by the left word too."""

    def __init__(self, count: int, share: np.ndarray):
        self.count = count
        self.spread = np.maximum(1, np.minimum(count, np.ceil(share * count * 2))).astype(np.int64)

    def _hash(self, x: np.ndarray) -> np.ndarray:
        x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)).astype(np.int64)

    def _spread(self, mid: np.ndarray) -> np.ndarray:
        return np.where(mid < len(self.spread), self.spread[np.minimum(mid, len(self.spread) - 1)], 1)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Of listed words (middle, left, last), packed."""
        return self.at(keys >> 2 * _BITS, keys >> _BITS & _MASK)

    def at(self, mid: np.ndarray, left: np.ndarray) -> np.ndarray:
        return (self._hash(mid) + left % self._spread(mid)) % self.count

    def home(self, word: np.ndarray) -> np.ndarray:
        return self._hash(word) % self.count

    def all_of(self, mid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions in ``mid``, shards) of every shard that may hold a middle word."""
        spread = self._spread(mid)
        at = np.repeat(np.arange(len(mid)), spread)
        step = np.arange(len(at)) - np.repeat(np.cumsum(spread) - spread, spread)
        return at, (self._hash(mid[at]) + step) % self.count


class Filter:
    """A Bloom filter of numbers in segments, each filled by one task."""

    def __init__(self, segments: np.ndarray):
        self.bits, self.count = segments.reshape(-1), len(segments)

    @staticmethod
    def hashed(x: np.ndarray) -> np.ndarray:
        h = (x.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(29))

    @staticmethod
    def places(h: np.ndarray) -> np.ndarray:
        """Four places in a segment per hashed number; the lowest 16 bits of the hash choose the segment."""
        step = h >> np.uint64(43) | np.uint64(1)
        return np.stack([((h >> np.uint64(16)) + np.uint64(i) * step) & np.uint64(SEGMENT_BITS - 1) for i in range(4)]).astype(np.int64)

    @classmethod
    def segment(cls, x: np.ndarray) -> np.ndarray:
        flags = np.zeros(SEGMENT_BITS, np.uint8)
        flags[cls.places(cls.hashed(x)).ravel()] = 1
        return np.packbits(flags, bitorder="little")
    def has(self, x: np.ndarray) -> np.ndarray:
        if not self.count:
            return np.zeros(len(x), bool)
        h = self.hashed(x)
        at = (h & np.uint64(0xFFFF)).astype(np.int64) % self.count * SEGMENT_BITS + self.places(h)
        return (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(axis=0)


class Coder:
    """Texts to trigrams; with a filter, words that it lacks are all one."""

    def __init__(self, words: list[str], known: Filter | None = None):
        self.ids, self.known = {w: i for i, w in enumerate(words, 1)}, known

    def keys(self, text: str) -> np.ndarray:
        """Rows: pairs (middle word, left word), last words."""
        get = self.ids.get
        words = _TOKEN.findall(text)
        w = np.fromiter((get(x) or _RARE + word_class(x) for x in words), np.int64, len(words))
        if self.known is not None:
            rare = np.flatnonzero(w > _RARE)
            w[rare[~self.known.has(w[rare])]] = _UNKNOWN
        padded = np.r_[_START, _START, w]
        return np.stack([pair(padded[1:-1], padded[:-2]), w])


def discounts(n: np.ndarray) -> np.ndarray:
    """D(1), D(2), D(3+) from the numbers of types counted 1 to 4 times (Chen and Goodman, 1999)."""
    n = np.maximum(np.asarray(n, float), 0.5)
    y = n[0] / (n[0] + 2 * n[1])
    d = np.array([k - (k + 1) * y * n[k] / n[k - 1] for k in (1, 2, 3)])
    return np.clip(d, 0.05, [0.95, 1.9, 2.8])


def _minus(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    return d[np.minimum(c, 3) - 1]


class Level:
    """One order of the model: keys with their contexts (by default their upper bits) and counts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, d: np.ndarray, contexts: np.ndarray | None = None):
        order = np.argsort(keys)
        self.keys, self.order, self.top = keys[order], order, (counts - _minus(counts, d))[order]
        self.contexts, at = np.unique(keys >> _BITS if contexts is None else contexts, return_inverse=True)
        self.total = np.bincount(at, counts, len(self.contexts))
        self.left = np.bincount(at, _minus(counts, d), len(self.contexts)) / self.total

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which keys are there, their places in the keys given first)."""
        if not len(self.keys):
            return np.zeros(len(keys), bool), np.zeros(len(keys), int)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.keys[i] == keys, self.order[i]

    def mix(self, keys: np.ndarray, lower: np.ndarray, contexts: np.ndarray | None = None) -> np.ndarray:
        if not len(self.keys):
            return lower
        contexts = keys >> _BITS if contexts is None else contexts
        at = np.minimum(np.searchsorted(self.contexts, contexts), len(self.contexts) - 1)
        known = self.contexts[at] == contexts
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        top = np.where(self.keys[i] == keys, self.top[i], 0.0)
        return np.where(known, top / self.total[at] + self.left[at] * lower, lower)


def unigrams(counts: np.ndarray, d: np.ndarray, total: int | None = None, rest: float | None = None) -> np.ndarray:
    """Probabilities by counts; ``total`` and what is left for each word are given where there are other words."""
    total = total or max(counts.sum(), 1)
    top = np.where(counts > 0, counts - _minus(np.maximum(counts, 1), d), 0.0)
    return top / total + ((1 - top.sum() / total) / len(counts) if rest is None else rest)


def _sum_by_key(keys: list[list[np.ndarray]], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Sums by keys of one or two columns."""
    k, c = [np.concatenate(x) for x in zip(*keys)], np.concatenate(counts)
    order = np.lexsort([k[-1], k[0].view(np.uint64)] if len(k) > 1 else [k[0].view(np.uint64)])
    k, c = [x[order] for x in k], c[order]
    if not len(c):
        return k, c
    new = np.zeros(len(c) - 1, bool)
    for x in k:
        new |= x[1:] != x[:-1]
    starts = np.flatnonzero(np.r_[True, new])
    return [x[starts] for x in k], np.add.reduceat(c, starts)


class _Rows:
    """Builds batches of the one row format that all steps exchange."""

    def __init__(self, id_type: pa.DataType):
        self.types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), id_type, pa.string(), pa.int64(), pa.binary()]
        self.names = ["shard", "kind", "a", "b", "batch", "pos", "uid", "id", "lang", "n", "key"]

    def batch(self, rows: list[tuple]) -> pa.RecordBatch:
        cols = zip(*rows) if rows else [[]] * len(self.types)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, self.types)], self.names)

    @staticmethod
    def chunks(shard: int, kind: int, keys: list[np.ndarray], b: np.ndarray) -> Iterator[tuple]:
        for at in range(0, len(b), ROW_KEYS):
            yield (int(shard), kind, pack_all(*[x[at : at + ROW_KEYS] for x in keys]), pack(b[at : at + ROW_KEYS], False), *[None] * 7)

    @staticmethod
    def stats(level: int, counts: np.ndarray) -> tuple:
        """How many keys were counted 1 to 4 times, all keys, and the sum of their counts."""
        return (0, _STATS, pack_all(np.arange(6)), pack(np.array([*[(counts == i).sum() for i in (1, 2, 3, 4)], len(counts), counts.sum()]), False), None, None, level, *[None] * 4)

    def dealt(self, shard: np.ndarray, kind: int, keys: list[np.ndarray], b: np.ndarray) -> Iterator[tuple]:
        order = np.argsort(shard, kind="stable")
        of, starts = np.unique(shard[order], return_index=True)
        for s, i in zip(of, np.split(order, starts[1:])):
            yield from self.chunks(s, kind, [x[i] for x in keys], b[i])


def _by_shard(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Consecutive rows of one shard as tuples in the order of the row format."""
    from itertools import groupby

    flat = (r for batch in rows for at in range(0, batch.num_rows, 16) for r in zip(*[c.to_pylist() for c in batch.slice(at, 16).columns]))
    return groupby(flat, key=lambda r: r[0])


def _count_trigrams(coder: Coder, shards: Shards, rows: _Rows):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send():
            k, c = _sum_by_key(held, [np.ones(n, np.int64)])
            return rows.batch(list(rows.dealt(shards.at(*halves(k[0])), _MODEL3, k, c)))

        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.append(coder.keys(text or ""))
                n += held[-1].shape[1]
                if n >= BATCH_TOKENS:
                    yield send()
                    held, n = [], 0
        if n:
            yield send()

    return run


def _merge(rows: _Rows, per_shard):
    """Sums keys and counts of each shard, merging as they come; ``per_shard`` turns the sums into rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, part in _by_shard(batches):
            keys, counts, n = [], [], 0
            for r in part:
                keys.append(unpack_all(r[2]))
                counts.append(unpack(r[3]))
                n += len(counts[-1])
                if n > 2 * len(counts[0]) + 2_000_000:
                    k, c = _sum_by_key(keys, counts)
                    keys, counts, n = [k], [c], len(k)
            k, c = _sum_by_key(keys, counts)
            out = []
            for r in per_shard(shard, k, c):
                out.append(r)
                if len(out) == 16:
                    yield rows.batch(out)
                    out = []
            yield rows.batch(out)

    return run


def _together(df: DataFrame, shards: int) -> DataFrame:
    """Each shard in a partition of its own, the model first."""
    return df.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind")


def filter_of(numbers: DataFrame, count: int) -> Filter:
    """The filter of a column ``k`` of ``count`` distinct numbers, built segment by segment; the driver gets 32 MB at most."""
    segments = min(FILTER_SEGMENTS, -(-count // SEGMENT_WORDS))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = (Filter.hashed(batch.column(0).to_numpy()) & np.uint64(0xFFFF)).astype(np.int64) % segments
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), batch.column(0)], ["s", "k"])

    def fill(part: pa.Table) -> pa.Table:
        return pa.table({"s": part.column("s")[:1], "bits": [Filter.segment(part.column("k").to_numpy()).tobytes()]})

    out = np.zeros((segments, SEGMENT_BITS // 8), np.uint8)
    if segments:
        for r in numbers.mapInArrow(mark, "s int, k long").groupBy("s").applyInArrow(fill, "s int, bits binary").collect():
            out[r["s"]] = np.frombuffer(r["bits"], np.uint8)
    return Filter(out)


def train(texts: DataFrame, words: list[str], share: np.ndarray, shards: Shards, id_kind: str, id_type: pa.DataType, kept: Kept) -> tuple[DataFrame, dict, dict, Filter]:
    """(model rows by shard, which lie in ``kept``, unigram probabilities of listed words and figures of the others, discounts by order, the filter of other words) from a column of trusted texts."""
    rows, coder = _Rows(id_type), Coder(words)
    schema = _SCHEMA.format(kind=id_kind)

    def tri(shard, k, c):
        yield from rows.chunks(shard, _MODEL3, k, c)
        mid, _ = halves(k[0])
        (pairs,), n = _sum_by_key([[pair(mid, k[1])]], [np.ones(len(c), np.int64)])
        mid, last = halves(pairs)
        # all bigrams of a last word that isn't listed meet, so that its unigram is counted there
        yield from rows.dealt(shards.home(np.where(last < _RARE, mid, last)), _MODEL2, [pairs], n)
        yield rows.stats(3, c)

    def bi(shard, k, c):
        mid, last = halves(k[0])
        word, back, n = np.unique(last, return_inverse=True, return_counts=True)
        listed = word < _RARE
        at, to = shards.all_of(mid)
        yield from rows.dealt(to, _MODEL2, [k[0][at], np.where(last < _RARE, 0, n[back])[at]], c[at])
        yield from rows.chunks(shard, _UNIGRAM, [word[listed]], n[listed])
        yield from rows.dealt(shards.home(word[~listed]), _MODEL1, [word[~listed]], n[~listed])
        yield rows.stats(2, c)
        yield rows.stats(1, n[~listed])

    three = kept.write("three", _together(texts.mapInArrow(_count_trigrams(coder, shards, rows), schema), shards.count).mapInArrow(_merge(rows, tri), schema), by="kind")
    two = kept.write("two", _together(three.where(F.col("kind") == _MODEL2), shards.count).mapInArrow(_merge(rows, bi), schema))
    kept.delete(f"three/kind={_MODEL2}")
    three = three.where(F.col("kind") != _MODEL2)

    def loose(batches):
        for batch in batches:
            for a, b, level in zip(*[c.to_pylist() for c in batch.columns]):
                k = unpack_all(a)[0]
                yield pa.RecordBatch.from_arrays([pa.array([level] * len(k), pa.int64()), pa.array(k), pa.array(unpack(b))], ["level", "k", "c"])

    small = three.unionByName(two).where(F.col("kind").isin(_STATS, _UNIGRAM)).select("a", "b", F.coalesce("uid", F.lit(0)).alias("level")).mapInArrow(loose, "level long, k long, c long")
    sums = small.groupBy("level", "k").agg(F.sum("c").alias("c")).collect()  # at most the listed words and some twenty more
    of = {level: {r["k"]: r["c"] for r in sums if r["level"] == level} for level in (0, 1, 2, 3)}
    seen = np.zeros(1 + len(words), np.int64)
    for k, c in of[0].items():
        seen[k] = c
    times = {level: np.array([of[level].get(i, 0) for i in range(6)]) for level in (1, 2, 3)}
    d = {level: discounts(times[level][:4]) for level in (2, 3)}
    met, rare = seen[seen > 0], times[1]
    d[1] = discounts([(seen == i).sum() + rare[i - 1] for i in (1, 2, 3, 4)])
    total = max(int(met.sum() + rare[5]), 1)
    spared = _minus(met, d[1]).sum() + rare[:2] @ d[1][:2] + (rare[4] - rare[:2].sum()) * d[1][2] if len(met) or rare[4] else total
    unigram = {"d": d[1], "total": total, "rest": float(spared / total / (_FIRST + len(words)))}
    model = three.where(F.col("kind") == _MODEL3).unionByName(two.where(F.col("kind").isin(_MODEL2, _MODEL1)))
    others = two.where(F.col("kind") == _MODEL1).select("a", "b", F.lit(0).alias("level")).mapInArrow(loose, "level long, k long, c long").select("k")
    return model, unigram | {"listed": unigrams(seen, **unigram)}, d, filter_of(others, int(rare[4]))


def _place(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(which are among the sorted keys, their places)."""
    i = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[i] == wanted, i


def _levels(parts: dict, d: dict) -> tuple[list[Level], tuple[np.ndarray, np.ndarray]]:
    """(trigrams and bigrams, words that aren't listed with their counts) of a shard."""
    none = np.zeros(0, np.int64)
    # a shard's trigrams are summed already; in the order of their contexts, as they were written, they sort fast
    rows = sorted(zip(*parts[_MODEL3]), key=lambda r: int(r[0][0].view(np.uint64)[0])) or [([none, none], none)]
    context, last, c = [np.concatenate(x) for x in zip(*[(*k, n) for k, n in rows])]
    three = Level(trigram(context, last), c, d[3], context)
    (two, ends), c = [np.concatenate(x) for x in zip(*(parts[_MODEL2][0] or [[none, none]]))], np.concatenate(parts[_MODEL2][1] or [none])
    level = Level(two, c, d[2], halves(two)[0])
    level.ends = ends
    (word,), n = _sum_by_key(parts[_MODEL1][0] or [[none - 1]], parts[_MODEL1][1] or [none])
    return [three, level], (word, n) if len(word) else (np.array([-1]), np.array([0]))


def score(docs: DataFrame, model: DataFrame, base: dict, d: dict, known_: Filter, shards: Shards, salts: int, words: list[str], id_kind: str, id_type: pa.DataType) -> DataFrame:
    """(uid, id, lang, n, key, logp) per row of docs (uid, id, lang, text, key)."""
    rows, coder = _Rows(id_type), Coder(words, known_)
    schema, rare = _SCHEMA.format(kind=id_kind), {k: v for k, v in base.items() if k != "listed"}
    log_listed, log_rest = np.log(base["listed"]), float(np.log(unigrams(np.zeros(1, np.int64), **rare))[0])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meta, held, n = [], [], 0

        def send():
            first = meta[0][0]
            context, last = np.concatenate(held, axis=1)
            doc = np.repeat(np.arange(len(held)), [h.shape[1] for h in held])
            mid, left = halves(context)
            # what needs no shard: after an unknown word only the unigram counts, and that of an unknown word is known
            seen, listed, unknown = mid != _UNKNOWN, last < _RARE, last == _UNKNOWN
            own = np.bincount(doc[unknown], minlength=len(held)) * log_rest
            alone = ~seen & listed
            own += np.bincount(doc[alone], log_listed[last[alone]], minlength=len(held))
            yield rows.batch([(u % (shards.count * salts), _META, x.tobytes(), None, first, pos, u, i, lang, k.shape[1], key) for pos, ((u, i, lang, key), k, x) in enumerate(zip(meta, held, own))])
            yield from asked(_QUERY, shards.at(mid[seen], left[seen]), context[seen], [last[seen]], doc[seen], first)
            rare_ = ~listed & ~unknown
            yield from asked(_QUERY1, shards.home(last[rare_]), last[rare_], [], doc[rare_], first)

        def asked(kind, shard, key, others, doc, first):
            shard = shard + shards.count * (xxhash.xxh3_64_intdigest(str(first).encode()) % salts)
            order = np.argsort(key.view(np.uint64), kind="stable")
            order = order[np.argsort(shard[order].astype(np.min_scalar_type(shards.count * salts)), kind="stable")]  # narrow numbers are sorted by their digits
            of, starts = np.unique(shard[order], return_index=True)
            yield rows.batch([(int(s), kind, pack_all(key[i], *[x[i] for x in others]), pack(doc[i], False), first, *[None] * 6) for s, i in zip(of, np.split(order, starts[1:]))])

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for uid, id_, lang, text, key in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns]):
                    meta.append((uid, id_, lang, key))
                    held.append(coder.keys(text or ""))
                    n += held[-1].shape[1]
                    if n >= BATCH_TOKENS or len(held) >= BATCH_DOCS:
                        yield from send()
                        meta, held, n = [], [], 0
        if held:
            yield from send()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part in _by_shard(batches):
            parts, levels, meta = {k: ([], []) for k in (_MODEL3, _MODEL2, _MODEL1)}, None, []
            for row in part:
                _, kind, a, b, first, *_ = row
                if kind in parts:
                    parts[kind][0].append(unpack_all(a))
                    parts[kind][1].append(unpack(b))
                    continue
                if kind == _META:
                    meta.append(row)
                    if len(meta) == 4096:
                        yield rows.batch(meta)
                        meta = []
                    continue
                if levels is None:
                    levels, own = _levels(parts, d)
                    parts = {}
                asked_, doc = unpack_all(a), unpack(b)
                if kind == _QUERY1:
                    there, i = _place(own[0], asked_[0])
                    logs = np.log(unigrams(np.where(there, own[1][i], 0), **rare))
                else:
                    at, back = distinct(trigram(*asked_))
                    context, last = asked_[0][at], asked_[1][at]
                    mid, _ = halves(context)
                    two = pair(mid, last)
                    there, i = levels[1].find(two)
                    # of other words that were seen here the unigram is known, and is added again where it is looked up
                    lower = np.where(last < _RARE, base["listed"][np.minimum(last, len(base["listed"]) - 1)], 1.0)
                    known = there & (last >= _RARE)
                    lower[known] = unigrams(levels[1].ends[i[known]], **rare)
                    p = levels[0].mix(trigram(context, last), levels[1].mix(two, lower, mid), context)
                    logs = (np.log(p) - np.where(known, np.log(lower), 0.0))[back]
                sums = np.bincount(doc, logs)
                met = np.flatnonzero(np.bincount(doc))
                yield rows.batch([(0, _QUERY, pack(met), sums[met].astype(np.float32).tobytes(), first, *[None] * 6)])
            yield rows.batch(meta)

    def add_up(part: pa.Table) -> pa.Table:
        docs_, sums = part.filter(pc.equal(part["kind"], _META)), part.filter(pc.equal(part["kind"], _QUERY))
        total = np.zeros(docs_.num_rows)
        for a, b in sorted(zip(sums["a"].to_pylist(), sums["b"].to_pylist())):
            total[unpack(a)] += np.frombuffer(b, np.float32)
        at = docs_["pos"].to_numpy()
        total = total[at] + np.frombuffer(b"".join(docs_["a"].to_pylist()), np.float64)
        return docs_.select(["uid", "id", "lang", "n", "key"]).append_column("logp", pa.array(total))

    asked = docs.select("uid", "id", "lang", "text", "key").mapInArrow(ask, schema)
    if salts > 1:
        model = model.withColumn("shard", F.explode(F.sequence(F.col("shard"), F.col("shard") + F.lit(shards.count * (salts - 1)), F.lit(shards.count))))
    answered = _together(model.unionByName(asked), shards.count * salts).mapInArrow(answer, schema)
    return answered.groupBy("batch").applyInArrow(add_up, f"uid long, id {id_kind}, lang string, n long, key binary, logp double")


def _most_frequent(counted: DataFrame, most: int) -> DataFrame:
    """The ``most`` words (w, n) of largest count.

    Powers of two of the counts, some sixty rows, tell which words can be among them, so that the
    tasks don't each send that many candidates.
    """
    power = F.floor(F.log2("n")).cast("int")
    least, seen = 0, 0
    for r in sorted(counted.groupBy(power.alias("p")).agg(F.count(F.lit(1)).alias("k")).collect(), reverse=True):
        least, seen = r["p"], seen + r["k"]
        if seen >= most:
            break
    return counted.where(F.col("n") >= 2**least).orderBy(F.desc("n"), "w").limit(most)


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", key: Column | None = None) -> DataFrame:
    """One row per document: id, lang, n_tokens, perplexity (null without tokens), threshold (null if none), kept.

    A binary ``key`` of the rows, if given, is a column of the result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = to_arrow_type(docs.schema[id_col].dataType)
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs[id_col].alias("id"), docs[lang_col].cast("string").alias("lang"), docs[text_col].cast("string").alias("text"), (F.lit(None).cast("binary") if key is None else key).alias("key"))
    own = [] if key is None else ["key"]
    good = labels.groupBy(labels["doc_id"].alias("good")).agg(F.min("quality").alias("q"), F.max("toxic").alias("t")).where("q = 1 and t = 0").select("good")
    good = materialise(good)
    n_good = good.count()
    trusted = lambda df: df.join(small_or_shuffled(good, n_good), F.col("id") == F.col("good"), "left_semi")
    share = F.greatest(F.lit(HELD), F.least(F.lit(HELD_DOCS) / F.count(F.lit(1)), F.lit(HELD_MOST)))
    shares = materialise(trusted(rows.select("id", "lang")).groupBy(F.col("lang").alias("of")).agg((share * (1 << 20)).cast("int").alias("share")))
    n_langs = shares.count()

    def held(df: DataFrame) -> DataFrame:
        """Adds ``held`` to rows with id and lang."""
        at = df.join(small_or_shuffled(shares, n_langs), F.col("lang").eqNullSafe(F.col("of")), "left")
        return at.withColumn("held", F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("share")).drop("of", "share")

    texts = held(trusted(rows)).where("not held").select("text")
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        send = lambda: pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], ["w", "n"])
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(_TOKEN.findall(text or ""))
                if len(seen) > 100_000:
                    yield send()
                    seen.clear()
        yield send()

    length = F.lit(0)
    for at in LENGTHS:
        length = length + (F.col("n") >= at).cast("int")
    turn = F.pmod(F.xxhash64("id", "text"), F.lit(TURNS))
    with shuffles_freed(spark), Kept(spark) as kept:
        counted = kept.write("words", texts.mapInArrow(count, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")))
        total = counted.agg(F.sum("n")).first()[0] or 0
        if total:
            top = _most_frequent(counted, VOCABULARY).collect()
            kept.delete("words")
            words = [r["w"] for r in top]
            share = np.r_[0.02, np.array([r["n"] for r in top]) / total]
            shards = Shards(max(LEAST_SHARDS, -(-total // SHARD_TOKENS), min(MOST_BY_BYTES, n_bytes // SHARD_BYTES)), share)
            salts = max(1, -(-n_bytes // (TURNS * shards.count * SALT_BYTES)))
            model, base, d, known = train(texts, words, share, shards, kind, id_type, kept)
            turns = []
            for k in range(TURNS):
                scored = score(rows.where(turn == k), model, base, d, known, shards, salts, words, kind, id_type)
                turns.append(materialise(scored.select("id", "lang", "n", "key", F.when(F.col("n") > 0, F.exp(-F.col("logp") / F.col("n"))).alias("perplexity"), length.alias("length"), F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("-")).alias("_lang"))))
    if not total:
        return rows.select(F.col("id").alias(id_col), "lang", F.lit(0).cast("long").alias("n_tokens"), F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"), F.lit(True).alias("kept"), *own)
    scored = reduce(DataFrame.unionByName, turns)
    sure = held(trusted(scored.where("n > 0"))).where("held")
    wide = F.sqrt(F.least("n", F.lit(LENGTHS[1])) / F.lit(LENGTHS[1]))
    top = lambda c: F.percentile_approx(c, quantile, 10_000)
    enough = F.count(F.lit(1)) >= LEAST_HELD
    sure = materialise(sure.select(F.col("_lang").alias("l1"), F.col("length").alias("c1"), "n", "perplexity", F.log("perplexity").alias("log")))
    cells = materialise(sure.groupBy("l1", "c1").agg(F.when(enough, top("perplexity")).alias("cut")))
    medians = materialise(sure.groupBy(F.col("l1").alias("l2")).agg(F.percentile_approx("log", 0.5, 10_000).alias("median")))
    n_langs = medians.count()
    far = sure.join(small_or_shuffled(medians, n_langs), F.col("l1") == F.col("l2")).select("l2", "median", "log", ((F.col("log") - F.col("median")) * wide).alias("far"), wide.alias("wide"))
    far = materialise(far)
    langs = materialise(far.groupBy("l2").agg(F.first("median").alias("median"), F.when(enough, top("far")).alias("most")))
    middle = far.agg(F.percentile_approx("log", 0.5, 10_000)).first()[0]
    known, unknown = far.agg(F.when(enough, top("far")), F.when(enough, top((F.col("log") - F.lit(middle).cast("double")) * F.col("wide")))).first()
    out = scored.join(small_or_shuffled(cells, cells.count()), (F.col("_lang") == F.col("l1")) & (F.col("length") == F.col("c1")), "left").join(small_or_shuffled(langs, n_langs), F.col("_lang") == F.col("l2"), "left")
    most = F.coalesce("most", F.when(F.col("median").isNotNull(), F.lit(known).cast("double")).otherwise(F.lit(unknown).cast("double")))
    # a little more, so that the document which sets a threshold is within it
    by_lang = F.when(F.col("n") > 0, F.exp(F.coalesce("median", F.lit(middle).cast("double")) + most / wide) * (1 + 1e-9))
    threshold = F.coalesce("cut", by_lang)
    return out.select(F.col("id").alias(id_col), "lang", F.col("n").alias("n_tokens"), "perplexity", threshold.alias("threshold"), (F.coalesce(F.col("perplexity") <= threshold, F.lit(True))).alias("kept"), *own)
