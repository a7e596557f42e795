import random

import sentencepiece

from lexquarry.llm import unigram_sp as U


def as_unigram(path):
    """The library's processor for the same pieces and scores with the model type set to unigram."""
    raw = bytearray(open(path, "rb").read())

    def number(i):
        n = shift = 0
        while True:
            n |= (raw[i] & 127) << shift
            shift, i = shift + 7, i + 1
            if not raw[i - 1] & 128:
                return n, i

    i = 0
    while i < len(raw):
        key, i = number(i)
        size, i = number(i)
        if key >> 3 == 2:  # the trainer's settings
            at = i
            while at < i + size:
                field, at = number(at)
                if field & 7 == 0:
                    if field >> 3 == 3:
                        raw[at] = 1
                    _, at = number(at)
                elif field & 7 == 2:
                    n, at = number(at)
                    at += n
                else:
                    at += 4 if field & 7 == 5 else 8
        i += size
    return sentencepiece.SentencePieceProcessor(model_proto=bytes(raw))


def test_best_segmentation_is_the_librarys(documents, pieces):
    """The library's lattice search, on a few words without unknown characters: their huge cost would drown its single precision."""
    sp, m, seen = as_unigram(pieces), U.model(pieces), 0
    score = lambda ids: sum(m.scores[i] for i in ids)
    for t in (" ".join(r["text"].split()[:4]) for r in documents.collect() if r["text"]):
        if t and not set(m.encode(t)) & m.fallback:
            best = sp.nbest_encode(t, nbest_size=2)[0]
            assert m.encode(t) == best or score(m.encode(t)) == score(best)
            seen += 1
    assert seen > 100


def test_viterbi_against_all_segmentations():
    pieces, scores = ["a", "b", "ab", "ba", "aba", "▁", "▁a"], [-3.0, -4.0, -5.5, -6.0, -7.5, -2.0, -4.5]
    m = U.Unigram([*pieces, *[None] * 256], [*scores, *[0.0] * 256], list(range(7, 263)))

    def every(t):
        if not t:
            yield 0.0, []
        for i, p in enumerate(pieces):
            if t.startswith(p):
                for s, rest in every(t[len(p) :]):
                    yield scores[i] + s, [i, *rest]

    rng = random.Random(0)
    for _ in range(200):
        t = "".join(rng.choice("ab ") for _ in range(rng.randint(1, 9)))
        best = max(s for s, _ in every(("▁" + t.replace(" ", "▁"))))
        ids = m.encode(t)
        assert sum(scores[i] for i in ids) == best and m.decode(ids) == t


def test_double_array_holds_exactly_its_words():
    rng = random.Random(1)
    words = {"".join(rng.choice("abcdé") for _ in range(rng.randint(1, 7))): i for i in range(500)}
    t = U.DoubleArray(words)
    for w in list(words) + ["".join(rng.choice("abcdéx") for _ in range(5)) for _ in range(300)]:
        state, found = 0, True
        for c in w:
            to = t.base[state] + t.codes.get(c, 10**9)
            found = found and to < len(t.check) and t.check[to] == state
            state = to if found else 0
        assert (t.value[state] if found and t.value[state] >= 0 else None) == words.get(w)


def test_round_trip_of_anything(pieces):
    m, rng = U.model(pieces), random.Random(0)
    for _ in range(2000):
        t = "".join(rng.choice(["a", " ", "  ", "▁", "\n", "é", "中", "😀", "the", "￾", "\x00", "x", "9", "!?"]) for _ in range(rng.randint(0, 14)))
        assert m.decode(m.encode(t)) == t


def test_documents_and_odd_rows(spark, documents, odd_docs, no_docs, pieces):
    for docs in (documents, odd_docs):
        coded = U.encode(docs, pieces)
        rows = coded.collect()
        assert len(rows) == docs.count() and all(r["round_trip"] and len(r["ids"]) == r["n_tokens"] for r in rows)
        texts = sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())
        assert sorted((str(r["doc_id"]), r["text"]) for r in U.decode(coded, pieces).collect()) == texts
    assert U.encode(no_docs, pieces).count() == 0


def test_words_are_not_cut_inside_pieces():
    assert U._splitter(["a1"]) is U._COARSE.findall or U._splitter(["a1"])("x a1") == ["x", " a1"]
    assert U._splitter(["a▁b"]) is None
