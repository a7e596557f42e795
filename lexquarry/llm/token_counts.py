"""Token counts at every prefix of a text, by dynamic programming over byte-pair merges.

A byte-pair encoding of a piece of text is valid exactly when each adjacent pair of its tokens
is what the merges make of the two tokens' bytes. So the last token of a prefix is the one token
t that ends there and forms a valid pair with the last token of the prefix before t, and

    count[i] = count[i - len(t)] + 1

holds the exact token count of every prefix. Truncation and budget questions read this array;
nothing is encoded again.

The counts at the ends of a text's pieces are kept for the whole text, those inside a piece are made
where a question falls into it: the cuts of a text at several token budgets are places in one array.

Defined results: a null text counts as empty; an empty text has 0 bytes and 0 tokens; a very long
text is counted whole, in memory of a few numbers per piece; of several prefixes with as many tokens
as a budget the longest is its cut; repeated rows each give a row; an empty table gives an empty
result; columns other than the id and the text are ignored, whatever their names; the vocabulary's
special string inside a text is one token, as is the library's default.
"""

from __future__ import annotations

import json
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

#: Pieces that the merges never cross, for text within U+024F: there the classes are short enough to
#: be written out for the faster regular expression module. Other text is split by the library.
_LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ]+| ?[0-9\xb2\xb3\xb9\xbc-\xbe]+"
    r"| ?[^\t-\r \x85\xa0A-Za-z0-9\xaa\xb2\xb3\xb5\xb9\xba\xbc-\xbe\xc0-\xd6\xd8-\xf6\xf8-ɏ]+"
    r"|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+"
)
_BEYOND = re.compile("[^\x00-ɏ]")
_SPACE = re.compile(r"[\s\x85\xa0]+")
#: Token budgets at which texts are cut.
BUDGETS = (128, 512, 2048, 8192)
#: Distinct pieces remembered by a worker, and the length up to which they are.
MEMO, MEMO_CHARS = 1_000_000, 64


def _byte_alphabet() -> dict[str, int]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 characters stand for themselves, the others follow from U+0100 in order."""
    plain = {b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF}
    rest = iter(range(256, 512))
    return {chr(b) if b in plain else chr(next(rest)): b for b in range(256)}


class PrefixCounter:
    """Exact token counts of every prefix under one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of = _byte_alphabet()
        to_bytes = lambda s: bytes(of[c] for c in s)
        self.tokens = [to_bytes(k) for k in spec["model"]["vocab"] if all(c in of for c in k)]
        self.vocab = {t: i for i, t in enumerate(self.tokens)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        self.rank = {(to_bytes(a), to_bytes(b)): i for i, (a, b) in enumerate(merges)}
        self.specials = [t["content"] for t in spec.get("added_tokens", [])]
        self._special = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        self.longest: dict[int, int] = {}
        for t in self.tokens:
            self.longest[t[-1]] = max(self.longest.get(t[-1], 0), len(t))
        self._classes = _classes(path)
        self._pairs: dict[int, bool] = {}
        self._memo: dict[str, int] = {}
        self._missed = 0

    def merge(self, piece: bytes) -> list[bytes]:
        """The plain merge loop, for single tokens and pairs of tokens only."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            pair = (parts[best], parts[best + 1])
            if pair not in self.rank:
                break
            done, i = [], 0
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    done.append(parts[i] + parts[i + 1])
                    i += 2
                else:
                    done.append(parts[i])
                    i += 1
            parts = done
        return parts

    def _valid(self, before: int, token: int) -> bool:
        """Whether the merges make just these two tokens of their bytes; ``before`` is -1 at the start of a piece."""
        if len(self._pairs) > 1_000_000:
            self._pairs.clear()
        parts = [self.tokens[token]] if before < 0 else [self.tokens[before], self.tokens[token]]
        ok = self._pairs[before + 1 << 20 | token] = self.merge(b"".join(parts)) == parts
        return ok

    def piece(self, piece: bytes) -> list[int]:
        """count[i] for the first i bytes of one piece."""
        count, last = [0] * (len(piece) + 1), [-1] * (len(piece) + 1)
        token_of, known, longest = self.vocab.get, self._pairs.get, self.longest
        for i in range(1, len(piece) + 1):
            for start in range(max(0, i - longest[piece[i - 1]]), i):
                token = token_of(piece[start:i])
                if token is None:
                    continue
                before = last[start]
                ok = known(before + 1 << 20 | token)
                if ok or (ok is None and self._valid(before, token)):
                    count[i], last[i] = count[start] + 1, token
                    break
        return count

    def _pieces(self, text: str) -> list[str]:
        return (self._classes if _BEYOND.search(text) else _LATIN.findall)(text)

    def _total(self, piece: str) -> int:
        n = self._memo.get(piece)
        if n is None:
            n = self.piece(piece.encode())[-1]
            if len(piece) <= MEMO_CHARS:
                if len(self._memo) < MEMO:
                    self._memo[piece] = n
                else:  # a full memo takes no more until it has missed several times its size
                    self._missed += 1
                    if self._missed > 8 * MEMO:
                        self._memo.clear()
                        self._missed = 0
        return n

    def _counts(self, pieces: list[str]) -> list[int]:
        out = list(map(self._memo.get, pieces))
        if None in out:
            for i, n in enumerate(out):
                if n is None:
                    out[i] = self._total(pieces[i])
        return out

    def _segments(self, text: str) -> Iterator[tuple[int, int, bool]]:
        """(start, end, whether it is a special string)."""
        at = 0
        for m in self._special.finditer(text) if self._special else ():
            if m.start() > at:
                yield at, m.start(), False
            yield m.start(), m.end(), True
            at = m.end()
        if at < len(text):
            yield at, len(text), False

    def boundaries(self, text: str) -> tuple[list[int], list[int]]:
        """The ends of the pieces of a text, in code points, and the token counts up to there."""
        ends, counts = [0], [0]
        for start, end, special in self._segments(text):
            if special:
                ends.append(end)
                counts.append(counts[-1] + 1)
                continue
            pieces = self._pieces(text[start:end])
            ends.extend(accumulate(map(len, pieces[1:]), initial=start + len(pieces[0])))
            own = self._counts(pieces)
            counts.extend(accumulate(own[1:], initial=counts[-1] + own[0]))
        return ends, counts

    def count(self, text: str) -> int:
        return self.boundaries(text)[1][-1]

    def _char_counts(self, piece: str) -> list[int]:
        """Counts of the prefixes of one piece by code points, the empty one left out."""
        counts = self.piece(piece.encode())
        return [counts[i] for i in accumulate(len(c.encode()) for c in piece)]

    def prefixes(self, text: str) -> list[int]:
        """The token count of text[:p] for every p from 0 to len(text).

        A prefix that ends inside a run of white space has that run as its last piece, whatever
        follows in the full text; a contraction that is cut after its second character is a mark
        and a letter; a cut special string is ordinary text that may join the piece before it.
        """
        ends, sums = self.boundaries(text)
        at = dict(zip(ends, sums))
        out, joined = [0] * (len(text) + 1), False
        for start, end, special in self._segments(text):
            if special:
                back = start if joined else ends[max(0, bisect_left(ends, start) - 1)]
                joined = True
                while back < start and back > 0 and text[back - 1].isspace():
                    back -= 1
                for p in range(start + 1, end):
                    out[p] = at[back] + sum(map(self._total, self._pieces(text[back:p])))
                out[end] = at[end]
                continue
            here, joined = start, False
            for piece in self._pieces(text[start:end]):
                out[here + 1 : here + len(piece) + 1] = [at[here] + n for n in self._char_counts(piece)]
                if piece in ("'re", "'ve", "'ll"):
                    out[here + 2] = at[here] + 2
                here += len(piece)
            for run in _SPACE.finditer(text, start, end):
                out[run.start() + 1 : run.end() + 1] = [at[run.start()] + n for n in self._char_counts(run[0])]
        return out

    def cuts(self, text: str, limits: Iterable[int], known: tuple[list[int], list[int]] | None = None) -> list[int]:
        """For each limit the largest p for which text[:p] has at most so many tokens; ``known`` are the boundaries."""
        ends, sums = known or self.boundaries(text)
        windows: dict[tuple[int, int], list[int]] = {}
        out = []
        for limit in limits:
            k = bisect_right(sums, limit)
            if k == len(sums):
                out.append(len(text))
                continue
            back = k - 1
            while back > 0 and text[ends[back] - 1].isspace():
                back -= 1
            if (back, k) not in windows:
                windows[back, k] = self.prefixes(text[ends[back] : ends[k] + 16])
            out.append(ends[back] + max(p for p, n in enumerate(windows[back, k]) if sums[back] + n <= limit))
        return out

    def truncate(self, text: str, limit: int) -> int:
        return self.cuts(text, [limit])[0]


class _classes:
    """Splits any text as the library does; for scripts that the fast pattern leaves out."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self._of = {k: bytes([v]) for k, v in _byte_alphabet().items()}

    def __call__(self, text: str) -> list[str]:
        return [b"".join(map(self._of.__getitem__, piece)).decode() for piece, _ in self._split(text)]


@lru_cache(maxsize=2)
def counter(path: str) -> PrefixCounter:
    """One per worker process and file."""
    return PrefixCounter(path)


def token_counts(docs: DataFrame, path: str, limit: int = 1024, budgets: Sequence[int] = BUDGETS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_bytes, n_tokens, over_limit, limit_chars, the length in code points of
    the longest prefix within ``limit`` tokens, and budget_chars, the same for each of ``budgets``.
    ``path`` is the vocabulary file on the workers.

    A narrow map: no shuffle, and memory of one batch of rows and a bounded memo of pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [t or "" for t in part.column(1).to_pylist()]
                known = [c.boundaries(t) for t in texts]
                counts = [sums[-1] for _, sums in known]
                cuts = [c.cuts(t, [limit, *budgets], k) for t, k in zip(texts, known)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(t.encode()) for t in texts], pa.int64()),
                        pa.array(counts, pa.int64()),
                        pa.array([n > limit for n in counts], pa.bool_()),
                        pa.array([x[0] for x in cuts], pa.int64()),
                        pa.array([x[1:] for x in cuts], pa.list_(pa.int64())),
                    ],
                    ["id", "n_bytes", "n_tokens", "over_limit", "limit_chars", "budget_chars"],
                )

    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean, limit_chars long, budget_chars array<long>")
    return out.withColumnRenamed("id", id_col)


def prefix_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id and counts, an array with the token count of every prefix in code points, from 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([c.prefixes(t or "") for t in part.column(1).to_pylist()], pa.list_(pa.int32()))], ["id", "counts"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(docs[id_col].alias("id"), docs[text_col].cast("string").alias("text")).mapInArrow(run, f"id {kind}, counts array<int>").withColumnRenamed("id", id_col)
