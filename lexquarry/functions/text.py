"""Text cleaning, readability and chunking as column expressions.

All regular expressions are read alike by Python and Java where the text is ASCII-spaced; Unicode
white space is covered by ``(?U)``. Arrays are bound once with ``let`` so that no lambda computes
an array again for each element.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_S = r"(?U)\s+"
# Fixed value: the characters that (?U)\s matches.
_WHITE = "\t\n\x0b\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Looks at the ends only; an expression would be tried at every blank inside."""
    return F.btrim(c, F.lit(_WHITE))


def words(c: Column) -> Column:
    """What splitting at runs of white space gives: no empty words."""
    return F.filter(F.split(c, _S), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c)).cast("long")


def nletters(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[^\p{L}]+", ""))


def alpha_ratio(c: Column) -> Column:
    """Letters per code point; 0 for an empty text."""
    return F.coalesce(F.try_divide(nletters(c).cast("double"), F.length(c).cast("double")), F.lit(0.0))


def is_readable(c: Column, threshold: float = 0.40) -> Column:
    """Strictly more letters than the threshold; false for an empty or null text."""
    return F.coalesce((F.length(c) > 0) & (alpha_ratio(c) > threshold), F.lit(False))


def normalize_whitespace(c: Column) -> Column:
    return strip(F.regexp_replace(F.regexp_replace(c, r"\n{3,}", "\n\n"), r"[ \t]{3,}", "  "))


def strip_html(c: Column) -> Column:
    return F.regexp_replace(c, "<[^>]+>", "")


def section(c: Column, start: int, end: int) -> Column:
    """Code points start to end, end exclusive."""
    return F.substring(c, start + 1, end - start)


def strip_gutenberg(c: Column) -> Column:
    """Drops what stands up to the line of the first start marker and from the end marker on.

    The first spelling that occurs counts. A start marker without a line end leaves the text
    as it is.
    """

    def head(t: Column) -> Column:
        at = F.when(F.instr(t, "*** START OF") > 0, F.instr(t, "*** START OF")).otherwise(F.instr(t, "***START OF"))
        line = F.instr(F.substr(t, F.greatest(at, F.lit(1))), "\n")
        return F.when((at > 0) & (line > 0), F.substr(t, at + line)).otherwise(t)

    def tail(t: Column) -> Column:
        at = F.when(F.instr(t, "*** END OF") > 0, F.instr(t, "*** END OF")).otherwise(F.instr(t, "***END OF"))
        return F.when(at > 0, F.left(t, at - 1)).otherwise(t)

    return strip(let(let(c, head), tail))


def is_noise_line(stripped: Column, repeated: Column | None = None, short: int = 15) -> Column:
    """A repeated header, a Roman page number, or too short a line."""
    noise = (F.length(stripped) < short) | ((F.length(stripped) < 10) & stripped.rlike("(?i)^[ivxlcdm]+$"))
    return noise if repeated is None else noise | F.array_contains(repeated, stripped)


def repeated_lines(lines: Column, least: int = 30, above: int = 5, below: int = 100) -> Column:
    """Stripped lines of a length between the bounds that occur ``least`` times or more in one text.

    In sorted order such a line equals the one ``least - 1`` places on: n log n, whatever the text. Fewer
    than ``least`` lines are not sorted.
    """
    short = F.filter(F.transform(lines, strip), lambda s: (F.length(s) > above) & (F.length(s) < below))
    found = lambda a: F.array_distinct(F.filter(a, lambda x, i: F.coalesce(F.get(a, i + least - 1) == x, F.lit(False))))
    return let(short, lambda s: F.when(F.size(s) >= least, let(F.sort_array(s), found)).when(s.isNotNull(), F.array().cast("array<string>")))


@dataclass(frozen=True)
class CleanProfile:
    """One family of line cleaners; the presets below differ in these figures only."""

    alpha: float | None = 0.40  # a line must have more letters than this share; None: no such rule
    alpha_exempt_len: int | None = None  # lines this long or longer escape the rule
    short_len: int = 15  # shorter lines go; 0: none
    short_keeps_period: bool = False  # a short line that ends in '.' stays
    page_regex: str | None = None  # lines that match go
    form_feeds: bool = False  # form feeds and lines that are a page number become line ends
    repeat_min: int | None = 30
    keep_indent: bool = True


DJVU = CleanProfile(form_feeds=True)
PDF = CleanProfile(alpha=None, page_regex=r"^\d+$", keep_indent=False)
LEGACY = {
    "strict": CleanProfile(alpha=0.50, repeat_min=None, short_len=0),
    "middle": CleanProfile(alpha=0.40, repeat_min=None, short_len=0),
    "loose": CleanProfile(alpha=0.35, repeat_min=None, short_len=0),
    "short_only": CleanProfile(alpha=0.50, alpha_exempt_len=80, repeat_min=30, short_len=15),
    "sentence": CleanProfile(alpha=None, page_regex=r"^\d+$", short_keeps_period=True, keep_indent=False),
    "plain": CleanProfile(alpha=None, page_regex=r"^\d+$", short_len=0, keep_indent=False),
}


def clean(c: Column, profile: CleanProfile = DJVU) -> Column:
    """The lines of a text that a profile keeps, runs of blank lines as one, white space normalised."""
    if profile.form_feeds:
        c = F.regexp_replace(F.regexp_replace(c, "\f", "\n"), r"(?dm)^\s*\d{1,4}\s*$", "")

    def keep(lines: Column, repeated: Column | None) -> Column:
        def good(line: Column) -> Column:
            def test(s: Column) -> Column:
                bad = F.lit(False)
                if profile.short_len:
                    noise = is_noise_line(s, short=profile.short_len)
                    bad = noise & ~F.endswith(s, F.lit(".")) if profile.short_keeps_period else noise
                if repeated is not None:
                    bad = bad | F.array_contains(repeated, s)
                if profile.page_regex:
                    bad = bad | s.rlike(profile.page_regex)
                if profile.alpha is not None:
                    weak = alpha_ratio(s) <= profile.alpha
                    bad = bad | (weak if profile.alpha_exempt_len is None else weak & (F.length(s) < profile.alpha_exempt_len))
                return (s == "") | ~bad

            return let(strip(line), test)

        shown = F.transform(F.filter(lines, good), lambda x: F.when(strip(x) == "", F.lit("")).otherwise(x) if profile.keep_indent else strip(x))
        once = let(shown, lambda a: F.filter(a, lambda x, i: (x != "") | ((i > 0) & (F.get(a, i - 1) != ""))))
        return F.array_join(once, "\n")

    lines = F.split(c, "\n")
    if profile.repeat_min is None:
        return normalize_whitespace(keep(lines, None))
    return normalize_whitespace(let(lines, lambda a: let(repeated_lines(a, profile.repeat_min), lambda r: keep(a, r))))


def clean_djvu(c: Column) -> Column:
    return clean(c, DJVU)


def clean_pdf(c: Column) -> Column:
    return clean(c, PDF)


def clean_section(c: Column, marker: str) -> Column:
    """Lines from the first one that matches ``marker`` on, without page numbers, numbered notes and lines of digits and signs."""
    lines = F.filter(
        F.transform(F.split(c, "\n"), strip),
        lambda s: (s != "") & ~(s.rlike(r"(?i)^(?:[ivxlcdm]+|\d+)$") & (F.length(s) < 10)) & ~s.rlike(r"^\(\d+\)") & ~s.rlike(r"^[\d\W]+$"),
    )

    def cut(a: Column) -> Column:
        first = F.array_position(F.transform(a, lambda s: s.rlike(marker)), True)
        return F.when(first > 0, F.slice(a, first.cast("int"), F.size(a))).otherwise(a)

    return F.array_join(let(lines, cut), "\n")


def sentences(c: Column) -> Column:
    return F.filter(F.transform(F.split(c, r"(?U)(?<=[.!?])\s+"), strip), lambda s: s != "")


def chunk_words(c: Column, target: int = 500, overlap: int = 50, min_words: int = 100, min_chars: int = 0) -> Column:
    """Windows of ``target`` words every ``target - overlap`` words, short ones left out."""

    def windows(w: Column) -> Column:
        starts = F.when(F.size(w) > 0, F.sequence(F.lit(0), F.size(w) - 1, F.lit(target - overlap))).otherwise(F.array().cast("array<int>"))
        cut = F.filter(F.transform(starts, lambda i: F.slice(w, i + 1, target)), lambda x: F.size(x) >= min_words)
        return F.filter(F.transform(cut, lambda x: F.array_join(x, " ")), lambda t: F.length(t) >= min_chars)

    return let(words(c), windows)


def split_chunks(text: str, target: int = 500, overlap: int = 50, min_words: int = 100) -> list[str]:
    """Greedy chunks of whole sentences.

    A chunk is complete when it holds ``target`` words; the next one starts with the longest run of
    its last sentences that has at most ``overlap`` words. Long texts of three sentences or fewer are
    cut into word windows.
    """
    import re

    parts = [s for s in (s.strip() for s in re.split(r"(?<=[.!?])\s+", text)) if s]
    sizes = [len(s.split()) for s in parts]
    if len(parts) <= 3:
        tokens = text.split()
        if len(tokens) > target:
            cut = (tokens[i : i + target] for i in range(0, len(tokens), target - overlap))
            return [" ".join(w) for w in cut if len(w) >= min_words]
    out, first, held = [], 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held < target:
            continue
        if held >= min_words:
            out.append(" ".join(parts[first : i + 1]))
        start, held = i + 1, 0
        while start > first and held + sizes[start - 1] <= overlap:
            start -= 1
            held += sizes[start]
        first = start
    if first < len(parts) and held >= min_words:
        out.append(" ".join(parts[first:]))
    return out


#: Texts that are chunked before their chunks are passed on.
SLICE = 64


def chunk_sentences(target: int = 500, overlap: int = 50, min_words: int = 100):
    """An Arrow-batched function of a text column that gives its chunks; the fold over sentences has no built-in form of linear cost.

    A batch's texts and chunks become Python's own ``SLICE`` at a time, so a worker holds little beside the batch.
    """

    @F.arrow_udf("array<string>")
    def chunks(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            for i in range(0, len(batch), SLICE):
                cut = [split_chunks(t or "", target, overlap, min_words) for t in batch.slice(i, SLICE).to_pylist()]
                yield pa.array(cut, pa.list_(pa.string()))

    return chunks
