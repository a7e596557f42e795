"""Alignment of two tokenizers over the same bytes.

Each byte of a text has a label: no token ends there, one of A, one of B, or one of both. A regular
expression cuts the label string after every both-label; the labels in a span count the tokens of A and B
that make a group. The last tokens of a group end together and are linked; how often a pair of ids is
linked in the corpus, and which pair is a B id's most frequent, goes back to every document.

Texts are cut at single spaces between other characters, where both tokenizers provably cut as well:
A's pre-tokenizer starts a piece with such a space, and no piece of B has a space after another
character. What such a part becomes is remembered, so a worker encodes a frequent word once; parts that
are new in a batch are encoded side by side in one call. A text for which this doesn't hold (it has
B's space marker, or a part that B doesn't give back) is encoded whole.

A batch of documents, at most ``BATCH_CHARS`` long or one document, is a row of its pairs and their
counts beside its documents' parts. Pairs are counted by a shuffle of these, so each batch sends a pair
once however frequent it is; a B id's highest count is a maximum over distinct pairs. The counts return
to each batch by a join of (batch, pair), and batches add them up for their documents. No table of all pairs is
held anywhere.

Defined results: null and empty texts have no tokens, and neither has a text that either tokenizer
doesn't give back byte by byte; very long texts are encoded whole; repeated rows are rows, and their links
count each; ties for the highest count are all best; an empty table gives an empty result; other
columns are ignored, whatever their names; rows with null ids are kept.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexquarry.llm._util import materialise

#: Characters of a batch, remembered parts and their length, characters that are encoded in one call.
BATCH_CHARS, MEMO, MEMO_CHARS, CALL_CHARS = 4_000_000, 600_000, 64, 200_000
_MARK = "▁"
_PART = re.compile(r"(?<=\S) (?=\S)")
_TWO = re.compile(r"\s\s")
#: Labels of bytes, and the spans that end in a both-label.
_A, _B = 1, 2
_SPAN = re.compile(rb"[\x00-\x02]*\x03")


class Aligner:
    """Encodes texts with both tokenizers and cuts them into groups."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        plain = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
        rest = iter(range(256, 512))
        of = {chr(b) if b in plain else chr(next(rest)): b for b in range(256)}
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        cutter = spec.get("pre_tokenizer") or {}
        self.in_parts = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space") and not spec.get("normalizer") and not any(re.search(f"[^{_MARK}]{_MARK}", p) for p in pieces)
        self.said_a, self.said_b = (list(map(str, range(len(t)))) for t in (self.bytes_a, self.bytes_b))
        self._memo: dict[str, tuple] = {}
        self._missed = 0
        self._spans: dict[bytes, tuple[int, int]] = {}

    def parts(self, text: str) -> list[str]:
        """The text cut at single spaces between others; the spaces are left out."""
        if not self.in_parts or _MARK in text:
            return [text]
        if _TWO.search(text) or text[0].isspace() or text[-1].isspace():
            return _PART.split(text)
        return text.split(" ")

    def _encode(self, parts: list[str]) -> list[tuple[int, int, str, bytes] | None]:
        """Of each part with a space before it (n_a, n_b, groups, linked pairs), or None if bytes are not given back. Parts follow each other by single spaces."""
        text = " ".join(parts)
        raw = (" " + text).encode()
        ids_a, ids_b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        if b"".join(map(self.bytes_a.__getitem__, ids_a)) != raw or b"".join(map(self.bytes_b.__getitem__, ids_b)) != raw:
            return [None] if len(parts) == 1 else [self._encode([p])[0] for p in parts]
        said_a, said_b = list(map(self.said_a.__getitem__, ids_a)), list(map(self.said_b.__getitem__, ids_b))
        ids_a, ids_b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        labels = np.zeros(len(raw), np.uint8)
        labels[np.cumsum(self.size_a[ids_a]) - 1] |= _A
        labels[np.cumsum(self.size_b[ids_b]) - 1] |= _B
        spans = _SPAN.findall(labels.tobytes())
        known = self._spans
        for span in set(spans).difference(known):
            known[span] = (span.count(b"\x01") + 1, span.count(b"\x02") + 1)
        counts = list(map(known.__getitem__, spans))
        if len(known) > MEMO:
            known.clear()
        groups, a, b = [], 0, 0
        for n_a, n_b in counts:
            if n_a == 1:
                groups.append(said_a[a] + "|" + (said_b[b] if n_b == 1 else ",".join(said_b[b : b + n_b])))
            else:
                groups.append(",".join(said_a[a : a + n_a]) + "|" + (said_b[b] if n_b == 1 else ",".join(said_b[b : b + n_b])))
            a, b = a + n_a, b + n_b
        to_a, to_b = np.cumsum(np.array(counts, np.int64), axis=0).T
        pairs = (ids_a[to_a - 1] << 32 | ids_b[to_b - 1]).tobytes()
        # a part's last byte has a both-label, so each part has whole groups
        last = np.searchsorted(np.cumsum([len(x) for x in spans]), np.cumsum([len(p.encode()) + 1 for p in parts]))
        n_a, n_b = (np.diff(to[last], prepend=0).tolist() for to in (to_a, to_b))
        ends = (last + 1).tolist()
        return [(x, y, ";".join(groups[i:j]), pairs[8 * i : 8 * j]) for x, y, i, j in zip(n_a, n_b, [0, *ends], ends)]

    def entries(self, parts: Iterable[str]) -> dict[str, tuple | None]:
        """What each distinct part becomes."""
        memo = self._memo
        out = dict.fromkeys(parts)
        for p in out:
            out[p] = memo.get(p)
        new = [p for p, e in out.items() if e is None]
        inner = [p for p in new if p and len(p) <= CALL_CHARS and not (p[0].isspace() or p[-1].isspace() or _MARK in p)] if self.in_parts else []
        i = 0
        while i < len(inner):
            j, n = i, 0
            while j < len(inner) and n < CALL_CHARS:
                n += len(inner[j])
                j += 1
            out.update(zip(inner[i:j], self._encode(inner[i:j]), strict=True))
            i = j
        for p in set(new).difference(inner):
            out[p] = self._encode([p])[0]
        if len(memo) < MEMO:
            memo.update((p, e) for p in new[: MEMO - len(memo)] if len(p) <= MEMO_CHARS and (e := out[p]) is not None)
        else:  # a full memo takes no more until it has missed several times its size
            self._missed += len(new)
            if self._missed > 8 * MEMO:
                memo.clear()
                self._missed = 0
        return out

    def batch(self, texts: list[str | None]) -> tuple[list[tuple[int, int, int, str, np.ndarray]], np.ndarray, np.ndarray]:
        """Per text (n_a, n_b, n_groups, digest of the groups, numbers of its parts); of each part of the batch how many links it has, and their pairs. Frequent parts have small numbers."""
        cut = [self.parts(t) if t else [] for t in texts]
        found = self.entries(chain.from_iterable(cut))
        if None in found.values():  # a part that isn't given back: its texts are encoded whole
            bad = {p for p, e in found.items() if e is None}
            again = [i for i, ps in enumerate(cut) if not bad.isdisjoint(ps)]
            for i in again:
                cut[i] = [texts[i]]
            found |= self.entries(texts[i] for i in again if texts[i] not in found)
            for i in again:
                if found[texts[i]] is None:
                    cut[i] = []
            used = set(chain.from_iterable(cut))
            found = {p: e for p, e in found.items() if p in used}
        number = dict(zip(found, range(len(found))))
        lengths = list(map(len, cut))
        used = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int32, sum(lengths))
        order = np.argsort(-np.bincount(used, minlength=len(found)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order), dtype=np.int32)
        values = list(found.values())
        sizes = np.array([(e[0], e[1], len(e[3]) >> 3) for e in values], np.int64).reshape(-1, 3)
        total = np.concatenate([np.zeros((1, 3), np.int64), np.cumsum(sizes[used], axis=0)])
        ends = np.cumsum(lengths)
        per_doc = (total[ends] - total[ends - lengths]).tolist() if lengths else []
        used = place[used]
        strings = {p: e[2] for p, e in found.items()}
        docs = []
        for ps, n, j in zip(cut, per_doc, ends.tolist()):
            digest = hashlib.sha256(";".join(map(strings.__getitem__, ps)).encode()).hexdigest() if ps else ""
            docs.append((*n, digest, used[j - len(ps) : j]))
        return docs, sizes[order, 2], np.frombuffer(b"".join([values[k][3] for k in order.tolist()]), np.int64)


@lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    """One for all tasks of a worker."""
    return Aligner(path_a, path_b)


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > BATCH_CHARS:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


#: Numbers of parts below _NEAR take two bytes in ``near``, the others four in ``far``.
_NEAR = 1 << 16
_ROW = "batch long, kind string, n_a long, n_b long, n_groups long, groups_sha256 string, near binary, far binary, links array<int>, linked array<int>, pairs array<long>, times array<long>"
_INTS, _LONGS = pa.list_(pa.int32()), pa.list_(pa.int64())


def encoded(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of documents (kind doc) and of batches (kind batch: the parts' numbers of links, these as places among the batch's distinct pairs, and how often each of them is linked)."""
    kind = docs.schema[id_col].dataType

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        for rb in batches:
            texts = rb.column(1).to_pylist()
            long = pa.int64()
            schema = pa.schema([("id", rb.column(0).type), ("batch", long), ("kind", pa.string()), ("n_a", long), ("n_b", long), ("n_groups", long), ("groups_sha256", pa.string()), ("near", pa.binary()), ("far", pa.binary()), ("links", _INTS), ("linked", _INTS), ("pairs", _LONGS), ("times", _LONGS)])
            none = lambda n, first, end: [pa.nulls(n, f.type) for f in list(schema)[first:end]]  # noqa: E731, B023
            for i, j in _slices([len(t or "") for t in texts]):
                found, links, linked = aligner.batch(texts[i:j])
                number += 1
                n, ids = j - i, rb.column(0).slice(i, j - i)
                own = [d[4] for d in found]
                near, far = ([x[x < _NEAR].astype("<u2").tobytes() for x in own], [x[x >= _NEAR].astype("<i4").tobytes() for x in own])
                yield pa.RecordBatch.from_arrays([ids, pa.array([number] * n), pa.array(["doc"] * n), *[pa.array([d[k] for d in found], long) for k in range(3)], pa.array([d[3] for d in found], pa.string()), pa.array(near, pa.binary()), pa.array(far, pa.binary()), *none(n, 9, 13)], schema=schema)
                if len(linked):
                    times = np.repeat(np.bincount(np.concatenate(own), minlength=len(links)), links)
                    pairs, at = np.unique(linked, return_inverse=True)
                    times = np.bincount(at, times, len(pairs)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([*none(1, 0, 1), pa.array([number]), pa.array(["batch"]), *none(1, 3, 9), *[pa.array([x.astype(np.int32)], _INTS) for x in (links, at)], *[pa.array([x], _LONGS) for x in (pairs, times)]], schema=schema)

    out = T.StructType([T.StructField("id", kind), *T._parse_datatype_string(_ROW).fields])
    return docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).mapInArrow(step, out)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, count, best): how many links of the corpus a pair has, and whether no pair of its B id has more."""
    each = rows.where("kind = 'batch'").select(F.explode(F.arrays_zip("pairs", "times")).alias("x"))
    counts = each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.times").alias("count"))
    most = F.max("count").over(Window.partitionBy(F.col("pair").bitwiseAND((1 << 32) - 1)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows = materialise(encoded(docs, path_a, path_b, id_col, text_col))
    asked = rows.where("kind = 'batch'").select(F.col("batch").alias("of"), F.explode("pairs").alias("pair"))
    answers = asked.join(pair_counts(rows), "pair").select("of", "pair", "count", "best")
    kind = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("id", kind), *T._parse_datatype_string("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string").fields])

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        """Counts of pairs to parts of the batch, and of parts to documents."""
        batch = left.filter(pa.compute.equal(left["kind"], "batch"))
        own = left.filter(pa.compute.equal(left["kind"], "doc"))
        sums = np.zeros((2, 0), np.int64)
        if batch.num_rows:
            links, linked, pairs = (batch[c].combine_chunks().flatten().to_numpy() for c in ("links", "linked", "pairs"))
            pair, count, best = (right[c].to_numpy() for c in ("pair", "count", "best"))
            order = np.argsort(pair)
            at = order[np.searchsorted(pair, pairs, sorter=order)][linked]
            ends = np.cumsum(links)
            sums = np.stack([np.diff(np.r_[0, np.cumsum(x[at].astype(np.int64))[ends - 1]]) for x in (best, count)])
        n_best, count_sum = np.zeros((2, own.num_rows), np.int64)
        for column, kind, width in (("near", "<u2", 2), ("far", "<i4", 4)):
            cells = own[column].to_pylist()
            used = np.frombuffer(b"".join(cells), kind)
            n = np.array([len(c) // width for c in cells], np.int64)
            ends = np.cumsum(n)
            for to, x in zip((n_best, count_sum), sums):
                total = np.r_[0, np.cumsum(x[used])]
                to += total[ends] - total[ends - n]
        columns = [own["id"], own["n_a"], own["n_b"], own["n_groups"], own["n_groups"], pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), own["groups_sha256"]]
        return pa.table(dict(zip(out.names, columns)))

    found = rows.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(add_up, out)
    return found.select(F.col("id").alias(id_col), *out.names[1:])
