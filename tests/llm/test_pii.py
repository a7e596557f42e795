import hashlib
import random
import re

from lexquarry.llm import pii

# The plain patterns that the operator's possessive ones stand for.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def good(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    return kind == "email" or (kind == "card" and 12 <= len(d) <= 19 and luhn(d)) or (kind == "phone" and 9 <= len(d) <= 15)


def base(text):
    kinds = list(PLAIN)
    found = [(m.start(), kinds.index(k), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text or "") if good(k, m[0])]
    return [f"{kinds[k]}:{s}:{e}" for s, k, e in sorted(found)]


def run(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in pii.find_pii(docs).collect()}


HARD = [
    "a@b.com_x@y.org and a@b@c.de .x@y..z q@r.s-", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.3.0255 1.2.3 9.9.9.9.",
    "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 1111 1111 0000000000000000 12345678901234567890123", "+1 (555) 010-2030. Then +44 20 7946 0958, +12 +123456789012345678 +1 2 3)",
    "é😀 mail ünder x.y+z@mail5.example.com, 10.0.0.1:80 5 -6", "9" * 5000 + "." + "8" * 5000, "a" * 20000 + "@", "1 " * 3000, "+1" + " " * 5000, "", None, "\n@\n",
]


def test_base_spans_are_those_of_the_plain_patterns(spark, documents):
    rows = [r["text"] for r in documents.select("text").collect()] + HARD
    for i, r in run(spark, rows).items():
        want = base(rows[i])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert set(want) <= set(r["spans"].split(",")) or not want
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(w.startswith(k + ":") for w in want) for k in PLAIN]


def test_classifier_adds_loose_spans_in_good_context_only(spark):
    sure = [f"Please call my phone +1 (555) 010-{i:04d} or mail a{i}@mail.example.com today" for i in range(60)]
    loose = ["Call my phone 555-010-2030 today"] * 20 + ["mail me: jo at mail dot com, thanks"] * 5
    junk = ["See section 155-010-2030x of the text"] * 10 + ["order no. 1555-010-20302"] * 10
    out = run(spark, [*sure, *loose, *junk])
    assert out[60]["spans"] == "phone:14:26" and out[60]["n_phone"] == 0
    assert all(out[i]["spans"] == "" for i in range(85, 105))


def test_reliabilities_favour_agreeing_labelers():
    counts = [("phone", True, (1, 1, 1, 1, 0), 90), ("phone", True, (-1, -1, 0, -1, -1), 60), ("phone", False, (0, 1, 1, 1, 0), 10), ("phone", False, (0, -1, -1, -1, -1), 10)]
    p = pii.reliabilities(counts)
    assert p[0] > 0.9 > 0.1 > p[1] and p[2] > 0.9 > 0.1 > p[3]


def test_the_classifier_reads_the_span(spark):
    """Held-out spans: the words before and the shape decide where the votes are the same."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    sure = [f"{word()} call my phone +1 (555) 01{i % 10}-{i:04d} {word()}" for i in range(300)]
    loose = [f"{word()} call my phone 555-01{i % 10}-{2030 + i} {word()}" for i in range(150)]
    other = [f"{word()} the order no. 155-01{i % 10}-{2030 + i} {word()}" for i in range(150)]
    held = [f"{word()} my phone 455-01{i % 10}-{5030 + i}" for i in range(50)] + [f"{word()} order no. 155-21{i % 10}-{5030 + i}" for i in range(50)]
    out = run(spark, [*sure, *loose, *other, *held])
    found = [bool(out[600 + i]["spans"]) for i in range(100)]
    assert sum(found[:50]) >= 45 and not any(found[50:])
    assert sum(bool(out[300 + i]["spans"]) for i in range(150)) >= 135


def test_cues_in_four_languages(spark):
    """Recall and precision of added spans where only the cue tells them from numbers of orders."""
    cues = ["call my phone", "rufen Sie mein Telefon", "appelez mon téléphone", "llame a mi teléfono"]
    against = ["order no.", "Rechnung Nr.", "facture", "pedido"]
    sure = [f"{cues[i % 4]} +49 (555) 01{i % 10}-{i:04d}, ok" for i in range(200)]
    loose = [f"{cues[i % 4]} 555-010-{2030 + i}, ok" for i in range(80)] + [f"{against[i % 4]} 155-010-{2030 + i}, ok" for i in range(80)]
    out = run(spark, [*sure, *loose])
    assert all(out[i]["spans"] for i in range(200, 280)) and not any(out[i]["spans"] for i in range(280, 360))


def test_odd_rows(odd_docs, no_docs):
    rows = pii.find_pii(odd_docs).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 10 and by[5]["spans"] == "email:5:13,phone:22:39,ip:43:51" and by[4]["spans"] == by[3]["spans"] == ""
    assert pii.find_pii(no_docs).count() == 0


def test_clashing_names(spark):
    docs = spark.createDataFrame([(1, "me@x.org", 1, 2, 3, 4)], "doc_id long, text string, kind int, uid int, spans int, features int")
    assert [r["spans"] for r in pii.find_pii(docs).collect()] == ["email:0:8"]


def test_no_python_on_the_executors(documents):
    plan = pii.find_pii(documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_a_sample_bounds_the_fit_but_not_the_spans(spark, monkeypatch):
    """With more candidates than the sample holds, every base span is still there and the sample keeps its bound."""
    from lexquarry.llm import pii as P

    rows = [(i, f"mail a{i}@site{i % 9}.org or phone (030) 555-{1000 + i} now, server 10.0.{i % 250}.7") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    drawn = []
    sample = P._sample
    monkeypatch.setattr(P, "SPANS", 100)
    monkeypatch.setattr(P, "_sample", lambda found: drawn.append(sample(found)) or drawn[-1])
    out = P.find_pii(docs).collect()
    assert len(out) == 600 and all((r["n_email"], r["n_ip"]) == (1, 1) for r in out)
    assert 50 <= sum(n for *_, n in drawn[0]) <= 100
    # drawn by places, so a second run takes the same candidates
    assert sorted(map(tuple, P.find_pii(docs.repartition(3)).collect())) == sorted(map(tuple, out)) and drawn[0] == drawn[1]
