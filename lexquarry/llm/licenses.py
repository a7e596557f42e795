"""License scans by a positional index of rare license words.

Templates are short passages of license notices. Of every template the words of highest inverse
document frequency, counted over all texts, are its anchors, at their positions. A file's anchors are
looked up in the postings (template, position): an anchor at word i that stands at j in a template asks
for that template at i - j, and places for which enough anchors of a template ask are candidates. A candidate counts if every mandatory phrase of its template stands at its place in
the file; its score is the share of the template's words that stand in theirs.

The base phrases are templates that are mandatory as a whole, with all their places reported. All other
templates add labels. One pass counts document frequencies of the templates' few hundred words, a
second finds candidates and checks them beside the text that they are in, so no text or word is
exchanged and what a file holds never meets in one place but its own row.

Defined results: null texts are empty and have no words; very long texts are scanned whole; of words as
rare as each other the smaller is an anchor first; overlapping places count each; repeated rows each
have a row; an empty table gives an empty result; other columns are ignored, whatever their names.
Words count from 0.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases that are always reported, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
# Fixed values: (label, passage, mandatory phrases in it). Passages are of the published notices.
NOTICES = (
    ("gpl-2.0", "gnu general public license version 2", ("general public license version 2",)),
    ("gpl-3.0", "gnu general public license version 3", ("general public license version 3",)),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", ("free software you can redistribute it", "general public license")),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    ("lgpl", "gnu lesser general public license", ("lesser general public license",)),
    ("agpl-3.0", "gnu affero general public license version 3", ("affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at", ("may not use this file except in compliance with the license",)),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ("permission is hereby granted free of charge", "deal in the software without restriction")),
    ("mit", "released under the mit license", ("under the mit license",)),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("with or without fee is hereby granted",)),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("source and binary forms", "following conditions are met")),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software", ("to endorse or promote products derived from this software",)),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("epl-2.0", "eclipse public license version 2 0", ("eclipse public license",)),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
    ("cc0-1.0", "cc0 1 0 universal", ("cc0 1 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    ("cc-by-nc-sa-4.0", "licensed under cc by nc sa 4 0", ("cc by nc sa 4 0",)),
    ("cc-by", "creative commons attribution 4 0 international license", ("creative commons attribution 4 0",)),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license", ("creative commons attribution sharealike",)),
    ("mit", "spdx license identifier mit", ("spdx license identifier mit",)),
    ("apache-2.0", "spdx license identifier apache 2 0", ("spdx license identifier apache 2 0",)),
    ("gpl-2.0", "spdx license identifier gpl 2 0", ("spdx license identifier gpl 2 0",)),
    ("gpl-3.0", "spdx license identifier gpl 3 0", ("spdx license identifier gpl 3 0",)),
    ("bsd-3-clause", "spdx license identifier bsd 3 clause", ("spdx license identifier bsd 3 clause",)),
)
#: Anchors are the rarer half of a template's words, as far as at most this share of all rows has them (else
#: the rarest word alone), and so many of them, if there are, must ask for a place.
RARE, AGREE = 0.1, 2
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A candidate is template x _WIDE + place + _AHEAD, in one long; places before the text's start are negative.
_WIDE, _AHEAD = 1 << 40, 1 << 16


def _let(value: Column, body) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_WORD), F.lit(0))


class Template:
    """A passage as words, with the positions of its mandatory phrases."""

    def __init__(self, label: str, passage: str, phrases: Sequence[str], base: bool):
        self.label, self.words, self.base = label, passage.split(), base
        self.phrases = []
        for p in (x.split() for x in phrases):
            at = next((i for i in range(len(self.words)) if self.words[i : i + len(p)] == p), None)
            if at is None:
                raise ValueError(f"{' '.join(p)} is not in {passage}")
            self.phrases.append((at, p))


def templates(base: dict[str, str] = BASE, notices: Sequence = NOTICES) -> list[Template]:
    return [Template(label, p, (p,), True) for p, label in base.items()] + [Template(label, p, must, False) for label, p, must in notices]


def document_frequencies(docs: DataFrame, vocabulary: Sequence[str], text_col: str = "text") -> tuple[int, dict[str, int]]:
    """The number of rows, and in how many of them each word of the vocabulary is; at most as many rows come back as there are words."""
    listed = F.array(*map(F.lit, vocabulary))
    met = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words(docs[text_col]), listed))).alias("w"))
    df = {r["w"]: r["n"] for r in met.groupBy("w").agg(F.count(F.lit(1)).alias("n")).collect()}
    return df.pop("", 0), df


class Index:
    """Postings of the anchors: word -> (template, position), with how many must agree.

    A template with a mandatory word that no text has is left out: it stands nowhere.
    """

    def __init__(self, found: Sequence[Template], rows: int, df: dict[str, int]):
        self.templates = [t for t in found if all(df.get(w) for _, p in t.phrases for w in p)]
        self.postings, self.agree = {}, []
        for t, x in enumerate(self.templates):
            known = sorted({w for w in x.words if df.get(w)}, key=lambda w: (-math.log(rows / df[w]), w))
            rare = [w for w in known if df[w] <= RARE * rows][: max(1, len(x.words) // 2)] or known[:1]
            self.agree.append(min(AGREE, len(rare)))
            for j, w in enumerate(x.words):
                if w in rare:
                    self.postings.setdefault(w, []).append((t, j))


def _literal(values, kind: str) -> Column:
    """A nested list as a constant."""
    if isinstance(values, list):
        return F.array(*[_literal(v, kind) for v in values]) if values else F.array().cast(f"array<{kind}>")
    return F.lit(values).cast(kind)


def _candidates(ws: Column, index: Index) -> Column:
    """Sorted distinct codes of the places for which enough anchors ask."""
    if not index.postings:
        return F.array().cast("array<bigint>")
    asked = F.create_map(*[x for w, ps in index.postings.items() for x in (F.lit(w), F.array(*[F.lit(t * _WIDE - j + _AHEAD).cast("long") for t, j in ps]))])
    at = F.filter(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: F.get(ws, i).isin(*index.postings))
    codes = F.when(F.size(ws) > 0, F.flatten(F.transform(at, lambda i: F.transform(F.element_at(asked, F.get(ws, i)), lambda c: c + i))))
    need = _literal(index.agree, "int")
    enough = lambda cs: F.filter(  # noqa: E731  equal codes stand together: the first of each that has enough after it
        cs, lambda c, i: ((i == 0) | (F.get(cs, i - 1) != c)) & F.coalesce(F.get(cs, i + F.get(need, (c / F.lit(_WIDE)).cast("int")) - 1) == c, F.lit(False))
    )
    return _let(F.sort_array(F.coalesce(codes, F.array().cast("array<bigint>"))), enough)


def _verified(ws: Column, codes: Column, index: Index) -> Column:
    """Of the candidates, those whose mandatory phrases stand, as (t, place, score)."""
    passages = _literal([t.words for t in index.templates], "string")
    phrases = F.array(*[F.array(*[F.struct(F.lit(at).alias("at"), _literal(p, "string").alias("words")) for at, p in t.phrases]) for t in index.templates])
    split = F.transform(codes, lambda c: F.struct((c / F.lit(_WIDE)).cast("int").alias("t"), (c % F.lit(_WIDE) - _AHEAD).cast("int").alias("place")))
    stands = lambda x: F.forall(F.get(phrases, x["t"]), lambda p: F.when(x["place"] + p["at"] >= 0, F.slice(ws, x["place"] + p["at"] + 1, F.size(p["words"])) == p["words"]).otherwise(False))
    share = lambda x, own: F.size(F.filter(own, lambda w, j: F.coalesce(F.when(x["place"] + j >= 0, F.get(ws, x["place"] + j) == w), F.lit(False)))) / F.size(own)
    return F.transform(F.filter(split, stands), lambda x: F.struct(x["t"].alias("t"), x["place"].alias("place"), share(x, F.get(passages, x["t"])).alias("score")))


def scan_licenses(docs: DataFrame, base: dict[str, str] = BASE, notices: Sequence = NOTICES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, places) of every row.

    ``places`` lists every verified one (label, base, word, score).
    """
    found = templates(base, notices)
    index = Index(found, *document_frequencies(docs, sorted({w for t in found for w in t.words}), text_col))
    rows = docs.select(docs[id_col].alias("id"), _let(words(docs[text_col]), lambda ws: F.struct(F.size(ws).cast("long").alias("n_words"), _let(_candidates(ws, index), lambda cs: F.when(F.size(cs) > 0, _verified(ws, cs, index)) if index.postings else F.lit(None).cast("array<struct<t:int,place:int,score:double>>")).alias("found"))).alias("r"))
    labels, is_base = _literal([t.label for t in index.templates], "string"), _literal([t.base for t in index.templates], "boolean")
    places = F.transform("r.found", lambda x: F.struct(F.get(labels, x["t"]).alias("label"), F.get(is_base, x["t"]).alias("base"), x["place"].cast("long").alias("word"), x["score"].alias("score")))
    rows = rows.select("id", "r.n_words", F.coalesce(places, F.array().cast("array<struct<label:string,base:boolean,word:bigint,score:double>>")).alias("places"))
    own = F.filter("places", lambda x: x["base"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(F.transform(a, lambda x: x["label"]))), ",")
    where = F.transform(own, lambda x: x["word"])
    return rows.select(
        F.col("id").alias(id_col), "n_words", F.size(own).cast("long").alias("n_base"), F.array_min(where).alias("first_word"), F.array_max(where).alias("last_word"),
        joined(own).alias("base_labels"), joined(F.col("places")).alias("labels"), F.coalesce(F.array_max(F.transform("places", lambda x: x["score"])), F.lit(0.0)).alias("score"), "places",
    )
