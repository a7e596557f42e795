"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces.

The pieces and their log scores come from a model file and are not changed. Of all segmentations
of a text into pieces, the one with the largest sum of scores is found by Viterbi search; the
pieces that start at a place come from one walk through the trie. White space becomes the marker
U+2581, with one more in front of the text. A character that no piece holds costs the smallest
score less ten and is written as the pieces of its UTF-8 bytes. On ties the longest last piece
wins, as the first one found.

Where no piece has the marker after another character, as in usual models, the best segmentation
of a text is that of its words, so each distinct word is searched once while a bounded memo of
the worker holds it. Where besides no piece mixes letters, digits and signs, words end there too.

Decoding joins the pieces, turns markers to spaces and byte pieces to bytes, and drops the space
in front. A marker character that the text itself holds is written in bytes, so every text comes
back exactly.

Defined results: null and empty texts have no ids and decode to ''; very long texts are searched
whole, in time in proportion to their length; repeated rows each give a row; an empty table gives an empty result; columns other than the id and the text are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
UNKNOWN_COST = 10.0
MEMO, MEMO_CHARS = 250_000, 48
#: Blanks with what follows: letters and anything beyond ASCII, digits, or signs; or up to the next blank.
_FINE = re.compile(r" *[A-Za-z\x80-\U0010ffff]+| *[0-9]+| *[\x00-\x1f!-/:-@\[-`{-\x7f]+| +")
_COARSE = re.compile(" *[^ ]+| +")
#: A space is the marker; a marker in the text is a character that no piece holds.
_MARKED = {0x20: MARK, 0x2581: "￾"}


def _splitter(pieces: list[str]):
    """The finest way to split a text so that no piece crosses a cut; None if there is none."""
    kind = lambda c: 0 if c == MARK else 1 if c.isascii() and c.isdigit() else 2 if c.isascii() and not c.isalpha() else 3
    met = {(kind(a), kind(b)) for p in pieces for a, b in zip(p, p[1:])}
    if all(a in (0, b) for a, b in met):
        return _FINE.findall
    return _COARSE.findall if all(a == 0 or b != 0 for a, b in met) else None


class DoubleArray:
    """A trie in two arrays: the child of state s by code c is base[s] + c if check there is s."""

    def __init__(self, words: dict[str, int]):
        codes = {c: i for i, c in enumerate(sorted({c for w in words for c in w}), 1)}
        tree: dict = {}
        for word, value in words.items():
            node = tree
            for c in word:
                node = node.setdefault(codes[c], {})
            node[0] = value
        base, check, value = [0], [-1], [-1]
        check[0] = 0
        first_free, todo = 1, [(tree, 0)]
        while todo:
            node, state = todo.pop()
            value[state] = node.get(0, -1)
            kids = sorted(k for k in node if k)
            if not kids:
                continue
            while first_free < len(check) and check[first_free] >= 0:
                first_free += 1
            at = max(0, first_free - kids[0])
            while any(at + k < len(check) and check[at + k] >= 0 for k in kids) or at + kids[0] == 0:
                at += 1
            short = at + kids[-1] + 1 - len(check)
            if short > 0:
                base += [0] * short
                check += [-1] * short
                value += [-1] * short
            base[state] = at
            for k in kids:
                check[at + k] = state
                todo.append((node[k], at + k))
        self.codes, self.base, self.check, self.value = codes, base, check, value


class Unigram:
    def __init__(self, pieces: list[str], scores: list[float], byte_ids: list[int]):
        """``pieces`` that aren't for text (control, unknown, byte pieces) are None; byte_ids[b] is the piece of byte b."""
        self.scores, self.byte_ids = scores, byte_ids
        self.trie = DoubleArray({p: i for i, p in enumerate(pieces) if p})
        self.unknown = min(s for p, s in zip(pieces, scores) if p) - UNKNOWN_COST
        self.split = _splitter([p for p in pieces if p])
        self.raw = [p.replace(MARK, " ").encode() if p else b"" for p in pieces]
        for b, i in enumerate(byte_ids):
            self.raw[i] = bytes([b])
        self.fallback = frozenset(byte_ids)
        self._memo: dict[str, tuple[int, ...]] = {}
        self._missed = 0

    @classmethod
    def load(cls, path: str) -> Unigram:
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(n)]
        return cls([sp.id_to_piece(i) if plain[i] else None for i in range(n)], [sp.get_score(i) for i in range(n)], [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)])

    def viterbi(self, word: str) -> tuple[int, ...]:
        codes, scores = self.trie.codes, self.scores
        base, check, value, size = self.trie.base, self.trie.check, self.trie.value, len(self.trie.check)
        text = [codes.get(c, -1) for c in word.translate(_MARKED)]
        n, unseen = len(text), float("-inf")
        best, start, with_piece = [unseen] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            here, state, single, end = best[i], 0, False, i
            while end < n:
                c = text[end]
                to = base[state] + c
                if c < 0 or to >= size or check[to] != state:
                    break
                state, end = to, end + 1
                piece = value[state]
                if piece >= 0:
                    single |= end == i + 1
                    if here + scores[piece] > best[end]:
                        best[end], start[end], with_piece[end] = here + scores[piece], i, piece
            if not single and here + self.unknown > best[i + 1]:
                best[i + 1], start[i + 1], with_piece[i + 1] = here + self.unknown, i, -1
        out, at = [], n
        while at:
            piece, at = with_piece[at], start[at]
            out.extend([piece] if piece >= 0 else [self.byte_ids[b] for b in reversed(word[at].encode())])
        return tuple(reversed(out))

    def _fill(self, words: list[str], ids: list) -> None:
        """Searches the words that the memo lacks. A full memo takes no more until it has missed several times its size."""
        memo = self._memo
        for i, known in enumerate(ids):
            if known is None:
                ids[i] = memo.get(words[i]) or self.viterbi(words[i])
                if len(words[i]) <= MEMO_CHARS:
                    if len(memo) < MEMO:
                        memo[words[i]] = ids[i]
                    else:
                        self._missed += 1
                        if self._missed > 8 * MEMO:
                            memo.clear()
                            self._missed = 0

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        if self.split is None:
            return list(self.viterbi(" " + text))
        words = self.split(" " + text)
        ids = list(map(self._memo.get, words))
        if None in ids:
            self._fill(words, ids)
        return list(chain.from_iterable(ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")[1:]


@lru_cache(maxsize=2)
def model(path: str) -> Unigram:
    """One per worker process and file."""
    return Unigram.load(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, n_fallback (tokens that are bytes), round_trip (decoding gives the text back), ids.

    A narrow map: no shuffle, and memory of one batch of rows and a bounded memo of words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                texts = [t or "" for t in part.column(1).to_pylist()]
                coded = [m.encode(t) for t in texts]
                flat = np.fromiter(chain.from_iterable(coded), np.int32)
                ends = np.r_[0, np.cumsum([len(c) for c in coded])].astype(np.int32)
                is_byte = np.r_[0, np.cumsum(np.isin(flat, m.byte_ids))]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(np.diff(ends).astype(np.int64)),
                        pa.array(np.diff(is_byte[ends]).astype(np.int64)),
                        pa.array([m.decode(c) == t for c, t in zip(coded, texts)]),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    ["id", "n_tokens", "n_fallback", "round_trip", "ids"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text"))
    return out.mapInArrow(run, f"id {kind}, n_tokens long, n_fallback long, round_trip boolean, ids array<int>").withColumnRenamed("id", id_col)


def decode(coded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([m.decode(x or []) for x in part.column(1).to_pylist()], pa.string())], ["id", "text"])

    kind = coded.schema[id_col].dataType.simpleString()
    return coded.select(coded[id_col].alias("id"), coded[ids_col].alias("ids")).mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)
