import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import brown_lm as B
from quarry.llm.tables import table

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER)) + ["\0end"]


def base(docs):
    out = lambda i: i is None or zlib.crc32(str(i).encode()) % 10 == 0
    c = Counter(w for i, t in docs if not out(i) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return {(i, t): (out(i), len(tokens(t)), sum(c[w] > 0 for w in tokens(t)), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens(t))) for i, t in docs}


def check(rows, docs):
    want = base(docs)
    by_id = {i: want[(i, t)] for i, t in docs}
    assert len(rows) == len(docs)
    for r in rows:
        held, n, known, total, score = by_id[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
        assert r.base_score == pytest.approx(score, rel=1e-9) and math.isfinite(r.score) and r.score < 0


@pytest.fixture(scope="module")
def small(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").select("doc_id", "text")
    return docs, [tuple(r) for r in docs.collect()], sorted(B.lm_scores(docs).collect(), key=lambda r: r.doc_id)


def test_base_columns(small):
    _, docs, rows = small
    check(rows, docs)


def test_better_than_base_on_held_out_texts(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [r for r in B.lm_scores(docs).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) * 0.97
    assert np.mean([r.score > r.base_score for r in rows]) > 0.9


def lookup(model):
    """Class of a word: by its number, or by its form if the training texts do not have it."""
    number = {}
    for r in model.answers.where("chunk is null").collect():
        power, n = B.unpressed(r["powers"], np.uint8), B.unpressed(r["counts"], np.int64)
        place = B.unpressed(r["places"], np.uint32)
        for p, k, c in zip(power.tolist(), place.tolist(), n.tolist(), strict=True):
            at = int(model.numbers.start[p, r["bucket"]]) + k
            assert at not in number
            number[at] = c
    assert sorted(number) == list(range(1, model.numbers.words + 1))  # every place once
    return number


def numbers_of(model):
    """The numbers of each text's tokens, from the kept sequences."""
    out = {}
    for r in model.seqs.collect():
        row = B.cells(pa.Table.from_pylist([r.asDict()]), 0, ids=np.int64, sizes=np.uint32, codes=np.int32)
        for i, codes in zip(row["ids"].tolist(), np.split(row["codes"], np.cumsum(row["sizes"])[:-1]), strict=True):
            out[i] = codes.tolist()
    return out


def test_scores_against_brute_force(small):
    """Class pairs, emissions and scores counted anew from the texts, with the learned classes."""
    df, docs, rows = small
    model = B.learn(df)
    counts, codes = lookup(model), numbers_of(model)
    word_of = {}
    for i, t in docs:
        for w, c in zip(tokens(t), codes[i], strict=True):
            assert word_of.setdefault(w, c) == c  # one number for a word
    train = [(i, t) for i, t in docs if not (i is None or zlib.crc32(str(i).encode()) % 10 == 0)]
    n = Counter(w for _, t in train for w in tokens(t))
    assert all(counts[word_of[w]] == c for w, c in n.items() if w != "\0end") and word_of["\0end"] == 0
    assert len({c for w, c in word_of.items() if w in n}) == len(n)
    cls = {w: int(model.classes[c]) if c >= 0 else int(model.by_form[-1 - c]) for w, c in word_of.items()}
    pairs, of_class, kinds = Counter(), Counter(), Counter(cls[w] for w in n)
    for _, t in train:
        before = 0
        for w in tokens(t):
            pairs[before, cls[w]] += 1
            of_class[cls[w]] += 1
            before = cls[w]
    every, m = sum(of_class.values()), B.CLASSES
    row = Counter()
    for (a, _), k in pairs.items():
        row[a] += k
    by_id = {r.doc_id: r for r in rows}
    for i, t in docs:
        total, before = 0.0, 0
        for w in tokens(t):
            c = cls[w]
            share = (of_class[c] + 1) / (every + m)
            total += math.log10((pairs[before, c] + m * share) / (row[before] + m))
            total += math.log10((n[w] + 0.1) / (of_class[c] + 0.1 * (kinds[c] + 1)))
            before = c
        assert by_id[i].score == pytest.approx(total, rel=1e-9)


def test_chunks_blocks_and_parts_give_the_same(small, monkeypatch):
    """Many chunks and buckets, blocks of a few words, words in several parts."""
    df, _, rows = small
    monkeypatch.setattr(B, "CHUNK", 20_000)
    monkeypatch.setattr(B, "PAIRS", 1000)
    monkeypatch.setattr(B, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(B, "SLICE", 100)
    other = sorted(B.lm_scores(df).collect(), key=lambda r: r.doc_id)
    for a, b in zip(rows, other, strict=True):
        assert a[:5] == b[:5] and a.base_score == pytest.approx(b.base_score, rel=1e-9) and a.score == pytest.approx(b.score, rel=1e-9)


def test_words_in_parts(small, monkeypatch):
    monkeypatch.setattr(B, "BLOCK_TOKENS", 500)
    seen = []
    whole = B.sweep
    monkeypatch.setattr(B, "sweep", lambda lists, numbers, *a: seen.append(numbers) or whole(lists, numbers, *a))
    B.learn(small[0])
    assert (seen[0].parts > 1).any() and len(seen[0].edges) > 50 and (np.diff(seen[0].edges) > 0).all()


def test_too_many_words_are_an_error(small, monkeypatch):
    monkeypatch.setattr(B, "MOST_WORDS", 100)
    with pytest.raises(ValueError, match="distinct words"):
        B.learn(small[0])


def test_probabilities_sum_to_one():
    """Over the classes and the words of each, the unknown one included."""
    rng = np.random.default_rng(3)
    pairs = rng.integers(0, 50, (B.CLASSES, B.CLASSES))
    tokens_, kinds = pairs.sum(axis=0), rng.integers(1, 9, B.CLASSES)
    share = (tokens_ + 1) / (tokens_.sum() + B.CLASSES)
    step = (pairs + B.CLASSES * share[None, :]) / (pairs.sum(axis=1, keepdims=True) + B.CLASSES)
    assert np.allclose(step.sum(axis=1), 1)
    emitted = (tokens_ + 0.1 * kinds + 0.1) / (tokens_ + B.ADD * (kinds + 1))
    assert np.allclose(emitted, 1)


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(5)
    group = rng.integers(0, 4, B.UNITS)
    prev = rng.integers(1, 400, 20_000)
    nxt = np.where(group[prev] % 2 == 0, rng.integers(1, 200, 20_000), rng.integers(200, 400, 20_000))

    def counts(cls):
        t = np.zeros((B.UNITS, 2 * B.CLASSES + 1), np.int64)
        np.add.at(t, (nxt, cls[prev]), 1)
        np.add.at(t, (prev, B.CLASSES + cls[nxt]), 1)
        np.add.at(t[:, 2 * B.CLASSES], nxt[nxt == prev], 1)
        return t

    def likelihood(cls):
        g = B.class_pairs(counts(cls), cls).astype(float)
        return B._xlogx(g).sum() - B._xlogx(g.sum(axis=1)).sum() - B._xlogx(g.sum(axis=0)).sum()

    cls = np.concatenate([[0], 1 + np.arange(B.UNITS - 1) % (B.CLASSES - 1)])
    for u in (5, 77, 300):  # one move at a time: the gain is exact
        new, moves = B.exchange(counts(cls), cls, np.array([u]))
        assert likelihood(new) >= likelihood(cls) and moves <= 1
        others = [likelihood(np.where(np.arange(B.UNITS) == u, b, cls)) for b in range(1, B.CLASSES)]
        assert likelihood(new) == pytest.approx(max(others))
        cls = new


def test_defined_cases(spark):
    rows = [(1, None, 1.0), (2, "", 1.0), (3, "Same same WORDS", 1.0), (4, "w " * 60_000, 1.0), (None, "no id", 1.0), (10, "unseen thing", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    check(B.lm_scores(df).collect(), [(i, t) for i, t, _ in rows])
    assert B.lm_scores(df.where("false")).count() == 0
    only_held = B.lm_scores(df.where("doc_id is null")).collect()
    assert len(only_held) == 1 and only_held[0].train_tokens == 0 and math.isfinite(only_held[0].score)


def test_words_of_one_form_get_classes_of_their_own(spark, monkeypatch):
    """Words outside the first WORDS are exchanged one by one."""
    seen = []
    whole = B.form_classes
    monkeypatch.setattr(B, "form_classes", lambda *a: seen.append(a) or whole(*a))
    B.learn(table(spark, "/root/testdata/sf0.01", "documents").where("doc_id % 4 < 3"))
    form, classes = seen[0]
    rare = set(zip(form[1 + B.WORDS:].tolist(), classes[1 + B.WORDS:].tolist(), strict=True))
    assert len(rare) > 1.2 * len({f for f, _ in rare})


def test_best_classes_are_exact():
    """Against the likelihood of the class table counted anew for every class."""
    rng = np.random.default_rng(7)
    text = np.concatenate([[0], np.append(rng.integers(1, 60, (300, 9)), np.zeros((300, 1), int), axis=1).ravel()])
    text[40:44] = 5  # a word that follows itself
    cls = np.concatenate([[0], 1 + np.arange(59) % 6])
    v, w = text[:-1], text[1:]

    def table_of(c):
        g = np.zeros((B.CLASSES, B.CLASSES), np.int64)
        np.add.at(g, (c[v], c[w]), 1)
        return g

    word, slot = np.concatenate([w, v, v[v == w]]), np.concatenate([cls[v], B.CLASSES + cls[w], np.full((v == w).sum(), B.SELF)])
    key, n = np.unique(word * B.SLOTS + slot, return_counts=True)
    word, slot = key // B.SLOTS, key % B.SLOTS
    best = B.best_classes(table_of(cls), cls, word, slot, n)
    assert best[0] == 0
    for u in range(1, 60):
        of = [B.likelihood(table_of(np.where(np.arange(60) == u, b, cls))) for b in range(1, B.CLASSES)]
        assert of[best[u] - 1] == pytest.approx(max(of), rel=1e-12)
