"""All listed names in one pass over a text, whatever their number.

An Aho-Corasick automaton in flat arrays: a table of next states by (state, character class), a bit for
states at which a name ends, and for these states the names. The driver builds it once; workers get the
arrays by broadcast. Texts are cut into pieces of one width that overlap by the longest name, so a batch is
a matrix of character classes and all its pieces step through the automaton together, a column at a time.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Sequence
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters of a piece without its overlap, pieces that step together, and names that one automaton takes (its table is of names x length x classes).
WIDTH, TOGETHER, MOST_NAMES = 1_024, 4_096, 100_000


class Automaton:
    """The automaton of distinct lower-case names."""

    def __init__(self, names: Sequence[str]):
        self.names = list(dict.fromkeys(names))
        if len(self.names) > MOST_NAMES:
            raise ValueError(f"{len(self.names)} names; {MOST_NAMES} at most")
        words = [n.lower() for n in self.names]
        self.everywhere = [i for i, w in enumerate(words) if not w]
        self.longest = max(map(len, words), default=0)
        letters = sorted({c for w in words for c in w})
        self.letters = np.array([ord(c) for c in letters], np.uint32)
        number = {c: k + 1 for k, c in enumerate(letters)}  # class 0: any other character
        goto: list[dict[int, int]] = [{}]
        ends: list[list[int]] = [[]]
        for i, w in enumerate(words):
            at = 0
            for c in w:
                k = number[c]
                if k not in goto[at]:
                    goto[at][k] = len(goto)
                    goto.append({})
                    ends.append([])
                at = goto[at][k]
            if w:
                ends[at].append(i)
        self.next = np.zeros((len(goto), len(letters) + 1), np.int32)
        fail = [0] * len(goto)
        queue = deque([0])
        while queue:  # breadth first: a state's fallback is complete before it
            at = queue.popleft()
            if at:
                self.next[at] = self.next[fail[at]]
                ends[at] = ends[at] + ends[fail[at]]
            for k, to in goto[at].items():
                fail[to] = int(self.next[fail[at]][k]) if at else 0
                queue.append(to)
            for k, to in goto[at].items():
                self.next[at, k] = to
        self.hit = np.array([bool(e) for e in ends])
        self.ends = ends

    def find(self, texts: Sequence[str | None]) -> list[list[int]]:
        """Of each lower-cased text the numbers of the names in it, ascending."""
        found: list[set[int]] = [set(self.everywhere) if t is not None else set() for t in texts]
        if not self.longest:
            return [sorted(f) for f in found]
        overlap = self.longest - 1
        pieces = ((i, t[s : s + WIDTH + overlap]) for i, t in enumerate(texts) if t for s in range(0, max(1, len(t) - overlap), WIDTH))
        while some := list(islice(pieces, TOGETHER)):
            some.sort(key=lambda x: -len(x[1]))  # those that end first are the last rows
            for i, state in self._met(some):
                found[i].update(self.ends[state])
        return [sorted(f) for f in found]

    def _met(self, pieces: list[tuple[int, str]]) -> set[tuple[int, int]]:
        """(owner, state) of the states with names that the pieces come to; pieces are ordered by falling length."""
        codes = np.frombuffer("".join([p for _, p in pieces]).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.searchsorted(self.letters, codes)
        np.minimum(place, len(self.letters) - 1, out=place)
        classes = np.where(self.letters[place] == codes, place + 1, 0).astype(np.int32)
        owner, length = np.array([i for i, _ in pieces]), np.array([len(p) for _, p in pieces])
        begin = np.cumsum(length) - length
        state = np.zeros(len(pieces), np.int32)
        active = len(pieces) - np.searchsorted(length[::-1], np.arange(1, length[0] + 1))  # pieces that have a character in each column
        met: set[tuple[int, int]] = set()
        for col, n in enumerate(active.tolist()):
            state = self.next[state[:n], classes[begin[:n] + col]]
            ending = np.flatnonzero(self.hit[state])
            if len(ending):
                met.update(zip(owner[ending].tolist(), state[ending].tolist()))
        return met


def tag_names(docs: DataFrame, names: DataFrame | Sequence[str], id_col: str = "id", text_col: str = "content", out: str = "figures") -> DataFrame:
    """(id, out): the names that a text contains, whatever the case, in list order; null if none. As ``extract_entities``, in time that doesn't grow with the names.

    Names are a list, or a frame with a column ``name`` that has ``MOST_NAMES`` distinct ones at most, in
    their own order. Texts are lower-cased before by the engine, so cases agree with its own functions.
    """
    if isinstance(names, DataFrame):
        names = [r["name"] for r in names.where("name is not null").select("name").distinct().orderBy("name").limit(MOST_NAMES + 1).collect()]
    sent = docs.sparkSession.sparkContext.broadcast(Automaton(names))
    kind = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField(out, T.ArrayType(T.StringType()))])

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = sent.value
        for pdf in batches:
            found = own.find(pdf["low"].tolist())
            yield pd.DataFrame({id_col: pdf["id"], out: [[own.names[i] for i in f] or None for f in found]})

    return docs.select(F.col(id_col).alias("id"), F.lower(text_col).alias("low")).mapInPandas(step, kind)
