"""Exact top-k search with multi-resolution segment statistics.

Vectors are cut into equal segments; of each segment the mean and the
deviation (the norm of what is left after the mean) are kept, for 4, 8, 16
and 32 segments. For any query q and vector x

    |q - x|^2  >=  sum over segments of  length * (mean_q - mean_x)^2 + (dev_q - dev_x)^2

and the bound only grows with finer segments. With the norms it gives an
upper bound of the inner product. Bounds are taken coarse to fine; a pair
whose bound is below the query's k-th best score so far goes; the exact
inner product is computed for the survivors. Components are integers
(floor(256 * x)), so scores are exact and ties are ties.

Rows are dealt to a grid: blocks of the vectors times blocks of the
queries, of bounded size, one task each; the best k of every block meet in
a final ranking by query.

Defined cases: vectors that are null or hold null or non-finite components,
and rows without a vec_id, take no part; repeated rows count once; vectors
are compared with those of the same length only; fewer than k others give
fewer rows. Scores are exact up to 64 bits; a returned score beyond that, or a
component (as an integer) of 2**62 and more, ends the job with an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.tables import written

K = 5
QUERY_EVERY = 50
LEVELS = (4, 8, 16, 32)
DATA_BLOCK, QUERY_BLOCK = 4096, 1024
DENSE = 0.2  # share of surviving pairs from which a level is computed for all pairs at once


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """sqrt(length) * mean and deviation of each segment, side by side: the
    squared distance of two such rows is the lower bound."""
    edges = np.linspace(0, x.shape[1], segments + 1).round().astype(int)
    out = np.empty((len(x), 2 * segments))
    for k, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
        part = x[:, a:b]
        mean = part.mean(axis=1) if b > a else np.zeros(len(x))
        out[:, 2 * k] = np.sqrt(b - a) * mean
        out[:, 2 * k + 1] = np.sqrt(((part - mean[:, None]) ** 2).sum(axis=1))
    return out


def block_top(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query place, vector place, score) of each query's k best vectors of a
    block, its own id aside; ties to the smaller id."""
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    q2, x2 = (qf**2).sum(axis=1), (xf**2).sum(axis=1)
    own = query_ids[:, None] == ids[None, :]
    levels = [s for s in LEVELS if s <= x.shape[1]] or [1]
    slack = 1e-6 * (q2[:, None] + x2[None, :] + 1)  # more than rounding can amount to

    floor = np.full(len(q), -np.inf)  # k-th best score so far
    alive = ~own
    for n, segments in enumerate(levels):
        a, b = segment_stats(qf, segments), segment_stats(xf, segments)
        a2, b2 = (a**2).sum(axis=1), (b**2).sum(axis=1)
        if n == 0 or alive.mean() > DENSE:
            low = a2[:, None] + b2[None, :] - 2 * (a @ b.T)
            upper = np.where(alive, (q2[:, None] + x2[None, :] + slack - low) / 2, -np.inf)
            if n == 0 and len(x) > k:  # the most promising vectors set a first threshold
                best = np.argpartition(-upper, min(4 * k, len(x) - 1), axis=1)[:, : 4 * k]
                exact = np.einsum("ikd,id->ik", xf[best], qf)
                exact[np.take_along_axis(own, best, axis=1)] = -np.inf
                if exact.shape[1] >= k:
                    floor = -np.sort(-exact, axis=1)[:, k - 1]
            alive &= upper >= floor[:, None]
        else:
            i, j = np.nonzero(alive)
            low = ((a[i] - b[j]) ** 2).sum(axis=1)
            gone = (q2[i] + x2[j] + slack[i, j] - low) / 2 < floor[i]
            alive[i[gone], j[gone]] = False
    i, j = np.nonzero(alive)
    s = inner(q, x, i, j, alive.mean() > DENSE)
    order = np.lexsort((ids[j], -s, i))
    i, j, s = i[order], j[order], s[order]
    place = np.arange(len(i)) - np.searchsorted(i, i)
    keep = place < k
    i, j, s = i[keep], j[keep], s[keep]
    if s.dtype == object:
        if any(abs(v) >= 1 << 63 for v in s):
            raise OverflowError("an inner product does not fit 64 bits")
        s = s.astype(np.int64)
    return i, j, s


def inner(q: np.ndarray, x: np.ndarray, i: np.ndarray, j: np.ndarray, dense: bool) -> np.ndarray:
    """Exact inner products of the rows q[i] and x[j]; ``dense``: most pairs are
    asked for. int64, or Python integers where 64 bits may not do."""
    bound = q.shape[1] * int(np.abs(q).max(initial=0)) * int(np.abs(x).max(initial=0))
    if bound < 1 << 53 and dense:  # every partial sum is a whole double
        return (q.astype(np.float64) @ x.astype(np.float64).T)[i, j].astype(np.int64)
    if bound < 1 << 63:
        return (q @ x.T)[i, j] if dense else np.einsum("nd,nd->n", q[i], x[j])
    a, b = q.astype(object), x.astype(object)
    return np.array([sum((a[m] * b[n]).tolist()) for m, n in zip(i.tolist(), j.tolist(), strict=True)] or [0], object)[: len(i)]


def top_k(vectors: DataFrame, k: int = K, every: int = QUERY_EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score): the k vectors with the largest inner
    product for every row whose vec_id is divisible by ``every``."""
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    scaled = lambda v: v.cast("double") * 256
    too_large = F.raise_error(F.lit("a component does not fit 63 bits")).cast("long")
    whole = F.transform("embedding", lambda v: F.when(F.abs(scaled(v)) < float(1 << 62), F.floor(scaled(v)).cast("long")).otherwise(too_large))
    rows = written(usable.select("vec_id", whole.alias("v")).distinct().select("vec_id", "v", F.size("v").alias("dim")), "vectors")
    n = rows.count()
    g, h = max(1, -(-n // DATA_BLOCK)), max(1, -(-n // (every * QUERY_BLOCK)))
    salt = lambda seed, m: F.pmod(F.xxhash64(F.lit(seed), "vec_id", "v"), F.lit(m))
    span = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    data = rows.select("dim", salt(1, g).cast("int").alias("g"), span(h).alias("h"), F.lit(False).alias("is_query"), "vec_id", "v")
    queries = rows.where(F.col("vec_id") % every == 0).select("dim", span(g).alias("g"), salt(2, h).cast("int").alias("h"), F.lit(True).alias("is_query"), "vec_id", "v")

    def cell(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy(zero_copy_only=False)
        ids = table.column("vec_id").to_numpy()
        dim = table.column("dim")[0].as_py()
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        v = flat.reshape(len(ids), dim)
        q, x = np.flatnonzero(is_query), np.flatnonzero(~is_query)
        if not len(q) or not len(x):
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        i, j, s = block_top(ids[q], v[q], ids[x], v[x], k)
        return pa.table({"query_id": ids[q][i], "vec_id": ids[x][j], "score": s})

    best = data.unionAll(queries).groupBy("dim", "g", "h").applyInArrow(cell, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
