import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import topk
from quarry.llm.tables import table


def brute(rows, k=5):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[(i, tuple(math.floor(256 * x) for x in v))] = True
    out = []
    for q, a in usable:
        if q % 50 == 0:
            scores = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    return sorted(tuple(r) for r in topk.top_k(df).collect())


def test_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    assert sorted(tuple(r) for r in topk.top_k(table(spark, "/root/testdata/sf0.01", "embeddings")).collect()) == brute(rows)


def test_grid_of_blocks_gives_the_same(spark, monkeypatch):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    monkeypatch.setattr(topk, "DATA_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 1)
    assert got(spark, rows) == brute(rows)


def test_ties_and_defined_cases(spark):
    one = [0.5, -0.25, 0.125]
    rows = [(i, one) for i in range(60)] + [(60, None), (61, [None, 1.0, 1.0]), (62, [float("nan"), 1.0, 1.0]), (63, [float("inf"), 0.0, 0.0]), (None, one), (7, one), (100, [1.0]), (101, [2.0]), (150, [])]
    assert got(spark, rows) == brute(rows)
    assert got(spark, rows[:1]) == [] and got(spark, []) == []


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 70), st.integers(1, 6), st.integers(1, 40), st.integers(0, 2**31), st.sampled_from([2, 300]))
def test_bounds_lose_nothing(dim, nq, nx, seed, width):
    rng = np.random.default_rng(seed)
    q, x = rng.integers(-width, width, (nq, dim)), rng.integers(-width, width, (nx, dim))
    x[: nx // 3] = x[0]
    i, j, s = topk.block_top(np.arange(nq), q, np.arange(nx), x)
    score = q @ x.T
    for a in range(nq):
        others = sorted((-score[a, b], b) for b in range(nx) if b != a)[:5]
        assert [(-t, b) for t, b in zip(s[i == a].tolist(), j[i == a].tolist(), strict=True)] == others


@pytest.mark.parametrize("far", [0, 1])
def test_scores_near_64_bits(spark, far):
    """With most pairs surviving, and with few."""
    rng = np.random.default_rng(3)
    v = rng.uniform(0.98e6, 1e6, (60, 64))
    if far:
        v[30:] *= rng.uniform(0, 1e-3, (30, 1))
    rows = [(i, np.float32(r).tolist()) for i, r in enumerate(v)]
    want = brute(rows)
    assert max(r[3] for r in want) > 1 << 61 and got(spark, rows) == want
    q = np.array([[1 << 31, 1 << 31]] * 2, np.int64)
    with pytest.raises(OverflowError):
        topk.block_top(np.arange(2), q, np.arange(2, 4), q)
    x = np.array([[1 << 31, -(1 << 31)], [1, 1]], np.int64)  # the sum fits, the bound does not
    assert topk.block_top(np.arange(1), q[:1], np.arange(2, 4), x)[2].tolist() == [1 << 32, 0]
    with pytest.raises(Exception, match="63 bits"):
        got(spark, [(50, [1e30]), (1, [1.0])])


def test_lower_bounds_grow_with_resolution():
    rng = np.random.default_rng(0)
    q, x = rng.normal(size=(20, 64)), rng.normal(size=(30, 64))
    exact = ((q[:, None] - x[None]) ** 2).sum(axis=2)
    last = np.zeros_like(exact)
    for s in topk.LEVELS:
        a, b = topk.segment_stats(q, s), topk.segment_stats(x, s)
        low = ((a[:, None] - b[None]) ** 2).sum(axis=2)
        assert (low >= last - 1e-9).all() and (low <= exact + 1e-9).all()
        last = low
