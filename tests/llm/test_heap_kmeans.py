import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import heap_kmeans as H
from quarry.llm.tables import table


def brute(rows, k=8, dim=64, rounds=10):
    kept = [(i, [math.floor(1024 * float(c)) for c in v], v) for i, v in rows if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) for c in v)]
    sha = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x, _ in sorted(kept, key=lambda r: (sha(r[0]), r[2]))[:k]]
    dist = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b, strict=True))
    nearest = lambda x: min((dist(x, c), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        of = [[] for _ in centroids]
        for _, x, _ in kept:
            of[nearest(x)[1]].append(x)
        centroids = [[sum(col) // len(xs) for col in zip(*xs, strict=True)] if xs else c for xs, c in zip(of, centroids, strict=True)]
    out = [(i, n, d) for i, x, _ in kept for d, n in [nearest(x)]]
    inertia = [sum(d for _, n, d in out if n == c) for c in range(len(centroids))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted(((i, n, d, inertia[n], sum(inertia), names[n]) for i, n, d in out), key=key)


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, 0, 7) for i, v in rows], "vec_id long, embedding array<float>, cluster int, x int")
    return sorted((tuple(r) for r in H.cluster_vectors(df, **more).collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def floats(v):
    return None if v is None else [None if c is None else float(np.float32(c)) for c in v]


def test_table(spark):
    df = table(spark, "/root/testdata/sf0.001", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(tuple(r) for r in H.cluster_vectors(df).collect()) == brute(rows)


def test_many_blocks_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, floats(rng.normal(rng.integers(0, 5), 0.4, 5))) for i in range(400)]
    monkeypatch.setattr(H, "BLOCK", 7)
    want = brute(rows, dim=5)
    assert run(spark, rows, dim=5) == want and len({r[1] for r in want}) > 3


def test_defined_cases(spark):
    one = [0.5] * 4
    rows = [(1, one), (1, one), (2, [0.5, 0.5, 0.5, -0.25]), (None, [1.0, 0.0, 0.0, 0.0]), (None, None), (3, [None, 1.0, 1.0, 1.0]), (4, [math.nan] * 4), (5, [math.inf] * 4), (6, [1.0]), (7, [])]
    rows += [(i, one) for i in range(10, 40)]  # ties and empty clusters
    assert run(spark, rows, dim=4) == brute(rows, dim=4)
    assert run(spark, rows[:3], dim=4) == brute(rows[:3], dim=4)  # fewer than clusters
    assert run(spark, rows[4:9], dim=4) == [] and run(spark, [], dim=4) == []
    with pytest.raises(Exception, match="64 bits"):
        run(spark, [(1, [1e6] * 4)], dim=4)


def test_large_components(spark):
    rng = np.random.default_rng(4)
    rows = [(i, floats(rng.uniform(-120_000, 120_000, 4))) for i in range(60)]
    assert run(spark, rows, dim=4) == brute(rows, dim=4)


@settings(max_examples=120, deadline=None)
@given(st.integers(1, 6), st.integers(1, 9), st.integers(1, 80), st.integers(0, 2**31), st.sampled_from([2, 60, 2**27]))
def test_bounds_lose_nothing(dim, k, n, seed, width):
    """Centroids that jump about: every assignment equals the full search, and sums follow."""
    rng = np.random.default_rng(seed)
    x = rng.integers(-width, width, (n, dim)).astype(np.int32)
    x[: n // 3] = x[0]
    centroids = rng.integers(-width, width, (k, dim))
    cluster, heaps = np.full(n, -1, np.int8), H.Heaps([[] for _ in range(k)])
    sums, counts, drift = np.zeros((k, dim), np.int64), np.zeros(k, np.int64), np.zeros(k)
    for turn in range(6):
        H.assign(x, cluster, heaps, sums, counts, centroids, drift)
        full = ((x[:, None].astype(object) - centroids[None].astype(object)) ** 2).sum(axis=2)
        assert cluster.tolist() == [min(range(k), key=lambda c: (r[c], c)) for r in full]
        assert all((sums[c] == x[cluster == c].astype(np.int64).sum(axis=0)).all() and counts[c] == (cluster == c).sum() for c in range(k))
        heaps = H.Heaps.read(*heaps.flat())
        step = rng.integers(-2, 3, (k, dim)) * rng.integers(0, 1 + width // 8, (k, 1)) * (rng.random((k, 1)) < 0.6)
        moved = np.clip(centroids + step, -width, width)
        _, more = H.moved(centroids, moved.tolist(), [1] * k)
        centroids, drift = moved, drift + more


def test_only_expired_vectors_are_scanned(spark):
    """Far-apart groups: after the first assignment no gap expires."""
    rng = np.random.default_rng(1)
    x = (rng.integers(0, 8, 2000)[:, None] * 100_000 + rng.integers(0, 50, (2000, 3))).astype(np.int32)
    centroids = np.arange(8)[:, None] * 100_000 + np.full((1, 3), 10)
    cluster, heaps, drift = np.full(2000, -1, np.int8), H.Heaps([[] for _ in range(8)]), np.zeros(8)
    sums, counts = np.zeros((8, 3), np.int64), np.zeros(8, np.int64)
    assert H.assign(x, cluster, heaps, sums, counts, centroids, drift) == 2000
    new, more = H.moved(centroids, sums.tolist(), counts.tolist())
    assert (new != centroids).any() and H.assign(x, cluster, heaps, sums, counts, new, drift + more) == 0
