"""Personal data by weak supervision.

Candidates come from strict patterns (the base) and from looser ones. Labelers of three sorts -
format checks, gazetteers and context in four languages - vote for, against or abstain.
Expectation-maximisation over the counts of vote patterns estimates how reliable each labeler is, which
gives every candidate a probability. A logistic span classifier is trained on a bounded sample of
candidates with these as targets; it reads the span and its surroundings themselves (the shape of the
span, how many digits, the two words before it, what follows it) beside the votes, and decides on the
loose candidates. Base spans that pass their check always stay; those that fail it never return.

Spans are found by DataFrame expressions alone: a pattern's matches with the pieces between them
give positions as running sums. Vote patterns number at most kinds x 2 x 3 ** labelers, whatever
the corpus, and the sample ``SPANS`` at most, so the driver fits the two small models; the scores of
all candidates are expressions again.

Defined results: null texts count as empty; repeated rows are rows; very long texts are searched
whole; where spans start at one place, the order of the kinds decides; of loose spans that overlap
each other all stay, while one that overlaps a base span goes; an empty table gives an empty result;
other columns are ignored, whatever their names. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexquarry.llm._util import materialise

KINDS = ("email", "ip", "card", "phone")
#: Probability from which the classifier adds a loose candidate; candidates that it is fitted on, at most.
SURE, SPANS = 0.9, 20_000
#: Buckets of shapes and of words in its features.
SHAPES, WORDS = 64, 128
_LOCAL = r"[A-Za-z0-9._%+-]"
#: (kind, base?, cheap precondition, pattern). Possessive forms and look-behinds spare backtracking and
#: match what the plain patterns match; without repetition of groups by recursion.
PATTERNS = (
    ("email", True, "@", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, ".", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", True, None, r"[0-9](?:[\x20-]?[0-9]){11,}+"),
    ("phone", True, "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, None, rf"(?i)(?<!{_LOCAL}){_LOCAL}{{1,64}}+\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[a-z0-9-]{{1,63}}+\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[a-z]{{2,10}}+(?![a-z0-9])"),
    ("ip", False, "[.]", r"(?<![0-9])[0-9]{1,3}\[\.\][0-9]{1,3}\[\.\][0-9]{1,3}\[\.\][0-9]{1,3}(?![0-9])"),
    ("phone", False, None, r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"),
)
#: Gazetteers: usual endings of host names, and country codes of telephone numbers.
TLDS = ("com", "org", "net", "edu", "gov", "io", "info", "biz", "de", "fr", "es", "uk", "it", "nl", "eu", "us", "ca", "ch", "at", "be", "pl", "pt", "mx", "ar", "br", "jp", "cn", "in", "au")
COUNTRY_CODES = ("1", "7", "31", "32", "33", "34", "39", "41", "43", "44", "45", "46", "47", "48", "49", "52", "54", "55", "61", "81", "86", "91", "351", "353", "358")
#: Context: what before a span speaks for its kind, and what against any, in English, German, French and Spanish.
_NEAR = {
    "email": r"mail|contact|kontakt|contacto|write|schreib|[ée]cri[vstr]|escrib|reach|courriel|correo|adress|direcci",
    "ip": r"\bip\b|host|server|serveur|servidor|address|adress|direcci|login|anmeld|connexion|conexi",
    "card": r"card|karte|carte|tarjeta|visa|master|amex|cr[eé]dit|kredit|debit|pay|zahl|paie|pago|pagar",
    "phone": r"phone|telefon|t[ée]l[ée]|\btel\b|\btel\.|call|fax|mobil|m[óo]vil|portable|handy|anruf|rufen|appel|llam|contact|kontakt",
}
_AGAINST = r"(?i)(?:version|versi[óo]n|ausgabe|release|\bv|section|abschnitt|secci[óo]n|chapter|kapitel|chapitre|cap[íi]tulo|isbn|issn|order|bestell\w*|commande|pedido|invoice|rechnung\w*|facture|factura|serial|\bid|fig\.?|no\.|nr\.|n[º°])[\x20:#.]*$"
LABELERS = ("format", "names", "context", "edges", "shape")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = lambda i: F.substr(back, i, F.lit(1)).cast("int")
    one = lambda i: F.when(i % 2 == 0, value(i) * 2 - F.when(value(i) > 4, 9).otherwise(0)).otherwise(value(i))
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), one), F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: Column, m: Column) -> Column:
    """The check that a base match of a kind must pass."""
    d = _digits(m)
    parts = F.forall(F.split(m, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", parts)
        .when(kind == "card", F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
        .otherwise(F.length(d).between(9, 15))
    )


_CANDIDATE = "array<struct<kind:string,base:boolean,i:int,m:string,gap:int,before:string,after:string>>"


def _candidate(kind: str, base: bool, gaps: Column):
    """A match with the length of the gap before it and its surroundings."""
    fields = lambda m, i: {"kind": F.lit(kind), "base": F.lit(base), "i": i, "m": m, "gap": F.length(gaps[i]), "before": F.right(gaps[i], F.lit(24)), "after": F.left(gaps[i + 1], F.lit(2))}
    return lambda m, i: F.struct(*[c.alias(k) for k, c in fields(m, i).items()])


def _features(kind: Column, base: Column, m: Column, before: Column, after: Column, votes: list[Column]) -> Column:
    """The numbers of a candidate's features below ``N_FEATURES``: kind and strictness, shape, digits, the two words before, what follows, votes."""
    shape = F.regexp_replace(F.regexp_replace(m, "[0-9]+", "9"), "[A-Za-z]+", "a")
    words = F.regexp_extract_all(F.lower(before), F.lit(r"\p{L}+"), F.lit(0))
    bucket = lambda c, n: F.pmod(F.xxhash64(kind, c), F.lit(n)).cast("int")
    at = (F.array_position(F.array(*map(F.lit, KINDS)), kind) - 1).cast("int")
    follows = F.when(after == "", 0).when(after.rlike(r"^\p{L}"), 1).when(after.rlike("^[0-9]"), 2).when(after.rlike(r"^\s"), 3).otherwise(4)
    sized = [
        (F.lit(0), 1),
        (at * 2 + base.cast("int"), 2 * len(KINDS)),
        (bucket(shape, SHAPES), SHAPES),
        (F.least(F.length(_digits(m)), F.lit(20)), 21),
        *[(bucket(F.try_element_at(words, F.lit(-i)), WORDS), WORDS) for i in (1, 2)],
        (follows, 5),
        *[(v + 1, 3) for v in votes],
    ]
    firsts = [sum(n for _, n in sized[:i]) for i in range(len(sized))]
    return F.array(*[F.lit(f) + c for f, (c, _) in zip(firsts, sized)])


N_FEATURES = 1 + 2 * len(KINDS) + SHAPES + 21 + 2 * WORDS + 5 + 3 * len(LABELERS)


def candidates(rows: DataFrame, tlds: Sequence[str] = TLDS, country_codes: Sequence[str] = COUNTRY_CODES) -> DataFrame:
    """(uid, id, and per candidate kind, base, start, end, votes, features) from (uid, id, text); rows without any keep one row of nulls."""
    t, found = F.col("text"), []
    for kind, base, needs, pattern in PATTERNS:
        spot = F.when(F.contains(t, F.lit(needs)), t) if needs else t
        hits, gaps = F.regexp_extract_all(spot, F.lit(pattern), F.lit(0)), F.split(spot, pattern, -1)
        found.append(F.coalesce(F.transform(hits, _candidate(kind, base, gaps)), F.array().cast(_CANDIDATE)))
    out = rows.select("uid", "id", F.explode_outer(F.concat(*found)).alias("c")).select("uid", "id", "c.*").repartition("uid")
    w = Window.partitionBy("uid", "kind", "base").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("m")).over(w)
    kind, m = F.col("kind"), F.col("m")
    d = _digits(m)
    ok = valid(kind, m)
    tld = F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(*tlds)
    coded = reduce(lambda a, b: a | b, [F.startswith(d, F.lit(c)) for c in country_codes])
    vote = lambda yes, no: F.when(yes, 1).when(no, -1).otherwise(0)
    names = (
        F.when(kind == "email", vote(tld, ~tld))
        .when(kind == "phone", F.when(F.col("base"), vote(coded, F.lit(False))).otherwise(vote(d.rlike("^[2-9]"), ~d.rlike("^[2-9]"))))
        .when(kind == "card", vote(d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)"), ~d.rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6)")))
        .otherwise(vote(F.lit(False), F.coalesce(F.regexp_extract(m, "^([0-9]+)", 1).try_cast("int") >= 240, F.lit(True)) | m.startswith("0")))
    )
    near = reduce(lambda rest, k: F.when(kind == k, F.col("before").rlike(f"(?i)(?:{_NEAR[k]})")).otherwise(rest), KINDS, F.lit(False))
    glued = F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")
    dull = (kind != "email") & d.rlike(r"^([0-9])\1+$|^0?123456789")
    votes = {
        "format": F.when(F.col("base"), vote(ok, ~ok)).otherwise(0),
        "names": names,
        "context": vote(near, F.col("before").rlike(_AGAINST)),
        "edges": vote(~glued, glued),
        "shape": vote(F.lit(False), dull),
    }
    return out.select(
        "uid", "id", "kind", "base",
        (end - F.length("m")).cast("long").alias("start"), end.cast("long").alias("end"),
        F.when(kind.isNotNull(), ok).alias("ok"),
        *[votes[k].alias(k) for k in LABELERS],
        F.when(kind.isNotNull(), _features(kind, F.col("base"), m, F.col("before"), F.col("after"), [votes[k] for k in LABELERS])).alias("features"),
    )


def reliabilities(counts: list[tuple], rounds: int = 60) -> list[float]:
    """Probability of each (kind, base, votes, n) pattern, by EM for a two-class model whose labelers err independently."""
    p = [min(0.95, max(0.05, 0.5 + 0.2 * sum(votes))) for _, _, votes, _ in counts]
    for _ in range(rounds):
        prior, table = {}, {}
        for kind in KINDS:
            own = [(q, n) for q, (k, _, _, n) in zip(p, counts) if k == kind]
            prior[kind] = (sum(q * n for q, n in own) + 1) / (sum(n for _, n in own) + 2)
        for i in range(len(LABELERS)):
            for y in (0, 1):
                mass = {v: 1.0 for v in (-1, 0, 1)}
                for q, (_, _, votes, n) in zip(p, counts):
                    mass[votes[i]] += n * (q if y else 1 - q)
                for v in mass:
                    table[i, v, y] = mass[v] / sum(mass.values())
        for j, (kind, _, votes, _) in enumerate(counts):
            yes = math.log(prior[kind]) + sum(math.log(table[i, v, 1]) for i, v in enumerate(votes))
            no = math.log(1 - prior[kind]) + sum(math.log(table[i, v, 0]) for i, v in enumerate(votes))
            p[j] = 1 / (1 + math.exp(min(700, max(-700, no - yes))))
    return p


def span_classifier(spans: list[tuple[list[int], float, int]], rounds: int = 80, rate: float = 0.3, decay: float = 1e-3) -> list[float]:
    """Weights of a logistic model by feature number, fitted to (features, probability, times) by Adagrad."""
    total = sum(n for *_, n in spans) or 1
    w, seen = [0.0] * N_FEATURES, [1e-8] * N_FEATURES
    for _ in range(rounds):
        grad = [decay * a for a in w]
        for features, p, n in spans:
            z = sum(w[i] for i in features)
            miss = (1 / (1 + math.exp(-max(-30, min(30, z)))) - p) * n / total
            for i in features:
                grad[i] += miss
        for i, g in enumerate(grad):
            seen[i] += g * g
            w[i] -= rate * g / math.sqrt(seen[i])
    return w


def _sample(found: DataFrame) -> list[tuple]:
    """((kind, base, votes), features, times) of candidates, at most ``SPANS`` strict and loose ones each drawn by a hash of their places."""
    place = F.xxhash64("id", "kind", "start", "end")
    out = []
    for strict in (True, False):
        own = found.where(F.col("base") == strict)
        n = own.count()
        share = min(1 << 30, -(-2 * (SPANS // 2) * (1 << 30) // max(n, 1)))
        drawn = own.where(F.pmod(place, F.lit(1 << 30)) < share).orderBy(place, "id", "kind", "start").limit(SPANS // 2)
        out += drawn.groupBy("kind", "base", *LABELERS, "features").agg(F.count(F.lit(1)).alias("times")).collect()
    return sorted(((r["kind"], r["base"], tuple(r[v] for v in LABELERS)), r["features"], r["times"]) for r in out)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tlds: Sequence[str] = TLDS, country_codes: Sequence[str] = COUNTRY_CODES) -> DataFrame:
    """One row per document: id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    ``tlds`` and ``country_codes`` are the gazetteers, in lower case; larger ones may be given.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), docs[id_col].alias("id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    found = materialise(candidates(rows, tlds, country_codes))
    patterns = found.where("kind is not null").groupBy("kind", "base", *LABELERS).agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "base", *LABELERS).collect()
    counts = [(r["kind"], r["base"], tuple(r[v] for v in LABELERS), r["n"]) for r in patterns]
    p = {(k, b, v): q for (k, b, v, _), q in zip(counts, reliabilities(counts))}
    weights = span_classifier([(features, p[pattern], n) for pattern, features, n in _sample(found)])
    odds = F.aggregate("features", F.lit(0.0), lambda a, i: a + F.element_at(F.array(*map(F.lit, weights)), i + 1))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")) - 1
    span = F.struct("start", order.cast("int").alias("k"), F.col("end").alias("end"))
    base, loose = F.col("base") & F.col("ok"), ~F.col("base") & (odds >= math.log(SURE / (1 - SURE)))
    per = found.groupBy("uid").agg(
        F.first("id").alias("id"),
        F.array_sort(F.collect_list(F.when(base, span))).alias("sure"),
        F.array_sort(F.collect_list(F.when(loose, span))).alias("more"),
    )
    added = F.filter("more", lambda a: ~F.exists("sure", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"])))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.array(*map(F.lit, KINDS))[s["k"]], s["start"], s["end"])), ",")
    n = lambda i: F.size(F.filter("sure", lambda s: s["k"] == i)).cast("long")
    return per.select(
        F.col("id").alias(id_col),
        *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
        F.sha2(text(F.col("sure")), 256).alias("base_sha256"),
        text(F.array_sort(F.concat("sure", added))).alias("spans"),
    )
