import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import collocations as C
from quarry.llm.tables import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces(text):
    return [re.findall("[^\x20\x09]+", p) for p in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))]


def brute(docs, longest=3, least=10, inside=50, most=2000):
    f = {}
    for lang, text in docs:
        c = f.setdefault("und" if lang is None else lang, Counter())
        for w in pieces(text):
            for k in range(1, longest + 1):
                c.update(tuple(w[i: i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        often = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in often.items():
            held = [b for q, b in often.items() if len(q) > len(p) and any(q[i: i + len(p)] == p for i in range(len(q) - len(p) + 1))]
            if any(100 * b >= inside * a for b in held):
                continue
            score, _, l_, r = min((1_000_000 * a * a // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l_, r))
        out += [(lang, j + 1, p.decode(), -a, l_, r, n, -s) for j, (s, a, p, l_, r) in enumerate(sorted(rows)[:most])]
    return sorted(out)


def run(spark, docs, **more):
    df = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "lang string, text string, n int, score int")
    return sorted(tuple(r) for r in C.collocations(df, **more).collect())


def test_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "documents")
    assert sorted(tuple(r) for r in C.collocations(df).collect()) == brute([(r.lang, r.text) for r in df.collect()])


def made(seed, n=150):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "Ab", "cé", "x y", "longer-word", "ZZ", "q"]
    seps = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; ", "\r\n", "!?"]
    one = lambda: "".join(words[rng.integers(0, 8)] + seps[rng.integers(0, 11)] for _ in range(rng.integers(0, 40)))
    return [([None, "und", "en", "", "d e"][rng.integers(0, 5)], one()) for _ in range(n)]


def test_chunks_hashes_and_collisions(spark, monkeypatch):
    """Small chunks, several buckets, and a fingerprint under which many phrases collide."""
    docs = made(1)
    want = brute(docs, longest=4, least=5)
    assert len(want) > 50
    assert run(spark, docs, longest=4, least=5) == want
    monkeypatch.setattr(C, "CHUNK", 300)
    monkeypatch.setattr(C, "SALTED", 5)
    assert run(spark, docs, longest=4, least=5) == want


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**31), st.integers(1, 4), st.sampled_from([64, 6]))
def test_entries_are_texts(seed, length, bits):
    """Entries against a dictionary, also with fingerprints of few bits."""
    text = " ".join(t for _, t in made(seed, 4))
    raw = np.frombuffer(text.encode(), np.uint8)
    norm = C.normalised(raw, np.zeros(1, np.int64))
    assert norm.tobytes().decode() == "".join(" ".join(w) + "\n" for w in pieces(text) if w)
    want = Counter(" ".join(w[i: i + length]) for w in pieces(text) for i in range(len(w) - length + 1))
    whole = C.fingerprints
    C.fingerprints = lambda *a: whole(*a) & np.uint64((1 << bits) - 1) if bits < 64 else whole(*a)
    try:
        fp, n, place = C.phrases(norm, "en", length, np.full(1 << C.SLOT_BITS - 3, 255, np.uint8))
    finally:
        C.fingerprints = whole
    assert (np.diff(fp.astype(object)) >= 0).all()
    got = Counter()
    for p, k in zip(place.tolist(), n.tolist(), strict=True):
        got[" ".join(re.split("[ \n]", norm[p:].tobytes().decode())[:length])] += k
    assert got == want and len(n) == len(want)


def test_fingerprints_do_not_depend_on_place():
    text = np.frombuffer(b"one two " * 30_000, np.uint8)
    a = np.arange(0, len(text) - 8, 8)
    assert len(np.unique(C.fingerprints(text, a, a + 7, np.uint64(3)))) == 1
    assert C.fingerprints(text, a[:1], a[:1] + 7, np.uint64(4)) != C.fingerprints(text, a[:1], a[:1] + 7, np.uint64(3))


def test_long_texts_are_cut_at_pieces():
    raw = np.frombuffer(b"some words. " * 400 + b"w" * 3000 + b" end" + b"x, y " * 100, np.uint8)
    at = np.array([0, 100, 100, 4000, len(raw)])
    parts = list(C._spans(raw, at, most=500))
    assert len(parts) > 5 and sum(len(p) for p, _ in parts) == len(raw)
    assert b"".join(C.normalised(*p).tobytes() for p in parts) == C.normalised(raw, at[:-1]).tobytes()


def test_exact_scores_beyond_64_bits(spark):
    big = 10**14 + 7
    rows = [("en", "a b", 2, big), ("en", "a", 1, 3 * big + 1), ("en", "b", 1, 2 * big + 5)]
    df = spark.createDataFrame(rows, "lang string, phrase string, length int, f long")
    r = C.scored(df).collect()
    assert [x.score for x in r] == [1_000_000 * big * big // ((3 * big + 1) * (2 * big + 5))]


def test_defined_cases(spark):
    many = [("en", "Same same words. " * 6)] * 2 + [(None, "w " * 50_000), ("und", "w"), ("fr", None), ("fr", ""), (None, None), ("de", " \t.,"), ("en", "y" * 100_000 + " z")]
    assert run(spark, many) == brute(many)
    assert run(spark, many[4:8]) == [] and run(spark, []) == []
    assert run(spark, many, most=1) == brute(many, most=1)
    ties = [("en", "a b. c d. e f. g h. " * 12)]
    assert run(spark, ties, most=3) == brute(ties, most=3)


def test_counts_too_large_end_the_job(spark):
    df = spark.createDataFrame([("en", "a b", 2, 10**15), ("en", "a", 1, 10**15), ("en", "b", 1, 10**15)], "lang string, phrase string, length int, f long")
    with pytest.raises(Exception, match="(?i)overflow|out_of_range|cannot be represented"):
        C.scored(df).collect()
