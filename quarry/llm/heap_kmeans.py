"""Centroid clustering with heap-ordered bounds, in whole numbers.

Vectors become integers, floor(1024 * x). Centroids 0, 1, ... start as the
``CLUSTERS`` vectors whose sha256 of ``3:<vec_id>`` is smallest. A round assigns
every vector to the nearest centroid (squared distance, ties to the smaller
number), then replaces each centroid that has vectors by their componentwise
floor(sum / count). After ``ROUNDS`` rounds vectors are assigned once more.

Vectors stand in blocks of at most ``BLOCK``; a block keeps, for each cluster, a
heap of its vectors. A vector's gap is the distance to the next best centroid
less that to its own; when centroids move, a cluster's gaps shrink by its own
centroid's move and the largest other one at most. These moves add up to the
cluster's drift, and the heap's key is the gap plus the drift when it was
taken: a vector needs no look until its cluster's drift reaches its key. So a
round pops what has expired from the tops of the heaps, takes those vectors'
exact distances to all centroids, and pushes them into the heap of their
cluster; others are not touched. Bounds are floating point with a margin above
its error; every decision between centroids is made on integers.

A round is one pass over the blocks (heaps travel with them in a table written
to the shared folder; the one before is dropped). Blocks keep their clusters'
sums by adding and taking away what moved; tasks add up those of their blocks
before the shuffle. The driver sees the ``CLUSTERS`` sums, never a vector.

Defined cases: vectors that are null, have null or non-finite components or
another length than ``DIM`` take no part; repeated rows count as often as they
are there; a null vec_id counts as an empty one for the start. Equal hashes are
told apart by the vectors. With fewer vectors than clusters there are as many
centroids as vectors, without any no rows come back. Components beyond +-131,072
(2**27 as integers) end the job with an error, as distances could pass 64 bits.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.tables import ROW_GROUPS, arrow_map, blobs, dropped_table, written
from quarry.llm.words import text_bytes

CLUSTERS, DIM, ROUNDS = 8, 64, 10
SCALE = 1024
LARGEST = 1 << 27
BLOCK = 4096
MARGIN = 1e-9  # of a distance; rounding amounts to much less

STATE = "ids binary, known binary, x binary, cluster binary, keys binary, places binary, sizes binary, sums array<long>, counts array<long>, scanned long"


def usable(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    fine = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(F.col("embedding").isNotNull() & (F.size("embedding") == dim) & fine).select("vec_id", "embedding")


def whole(flat: np.ndarray) -> np.ndarray:
    """floor(1024 * x), checked."""
    x = np.floor(flat.astype(np.float64) * SCALE)
    if len(x) and np.abs(x).max() > LARGEST:
        raise ValueError(f"a component is beyond +-{LARGEST // SCALE}: squared distances could pass 64 bits")
    return x.astype(np.int32)


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Exact squared distances, int64."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(centroids).max(initial=0)), 1)
    kind = np.float64 if 4 * x.shape[1] * top * top < 1 << 53 else np.int64  # both exact
    a, c = x.astype(kind), centroids.astype(kind)
    d = (a * a).sum(axis=1)[:, None] - 2 * (a @ c.T) + (c * c).sum(axis=1)[None, :]
    return d.astype(np.int64)


def gaps(d: np.ndarray, best: np.ndarray) -> np.ndarray:
    """Lower bound of (next best distance - own distance)."""
    root = np.sqrt(d.astype(np.float64))
    at = np.arange(len(d))
    own = root[at, best]
    if d.shape[1] == 1:
        return np.full(len(d), np.inf)
    root[at, best] = np.inf
    other = root.min(axis=1)
    return other - own - MARGIN * (other + own + 1)


class Heaps:
    """One heap of (key, place) for each cluster of a block."""

    def __init__(self, heaps: list[list[tuple[float, int]]]):
        self.heaps = heaps

    @classmethod
    def read(cls, keys: np.ndarray, places: np.ndarray, sizes: np.ndarray) -> Heaps:
        ends = np.cumsum(sizes).tolist()
        pairs = list(zip(keys.tolist(), places.tolist(), strict=True))
        return cls([pairs[b - n: b] for b, n in zip(ends, sizes.tolist(), strict=True)])  # stored in heap order

    def expired(self, drift: np.ndarray) -> np.ndarray:
        """Pops the vectors whose gap their cluster's drift has used up."""
        out = []
        for heap, d in zip(self.heaps, drift.tolist(), strict=True):
            while heap and heap[0][0] <= d:
                out.append(heapq.heappop(heap)[1])
        return np.array(out, np.int64)

    def push(self, cluster: np.ndarray, keys: np.ndarray, places: np.ndarray) -> None:
        for c, heap in enumerate(self.heaps):
            of = cluster == c
            new = list(zip(keys[of].tolist(), places[of].tolist(), strict=True))
            if len(new) > len(heap) // 8:
                heap += new
                heapq.heapify(heap)
            else:
                for pair in new:
                    heapq.heappush(heap, pair)

    def flat(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        pairs = [p for heap in self.heaps for p in heap]
        return np.array([p[0] for p in pairs], np.float64), np.array([p[1] for p in pairs], np.int32), np.array([len(h) for h in self.heaps], np.int32)


def assign(x: np.ndarray, cluster: np.ndarray, heaps: Heaps, sums: np.ndarray, counts: np.ndarray, centroids: np.ndarray, drift: np.ndarray) -> int:
    """Rescans the vectors of a block that expired; keeps cluster, heaps, sums
    and counts up to date. A vector without a cluster (-1) is in no heap yet."""
    at = np.concatenate([np.flatnonzero(cluster < 0), heaps.expired(drift)])
    if not len(at):
        return 0
    d = distances(x[at], centroids)
    best = d.argmin(axis=1)  # the first of equals
    heaps.push(best, gaps(d, best) + drift[best], at)
    old = cluster[at]
    move = np.flatnonzero(old != best)
    wide = x[at[move]].astype(np.int64)
    np.add.at(sums, best[move], wide)
    np.add.at(counts, best[move], 1)
    was = np.flatnonzero(old[move] >= 0)
    np.subtract.at(sums, old[move][was], wide[was])
    np.subtract.at(counts, old[move][was], 1)
    cluster[at] = best
    return len(at)


def _packed(batch: pa.RecordBatch, block: int, k: int, dim: int) -> Iterator[dict]:
    ids, vectors = batch.column(0), batch.column(1)
    for a in range(0, batch.num_rows, block):
        part = ids.slice(a, block)
        x = whole(vectors.slice(a, block).flatten().to_numpy(zero_copy_only=False))
        n = len(part)
        yield {
            "ids": part.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), "known": part.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), "x": x,
            "cluster": np.full(n, -1, np.int8), "keys": np.zeros(0), "places": np.zeros(0, np.int32), "sizes": np.zeros(k, np.int32),
            "sums": np.zeros(k * dim, np.int64), "counts": np.zeros(k, np.int64), "scanned": n,
        }


def _record(row: dict) -> pa.RecordBatch:
    cells = [blobs(v, np.array([len(v)])) for v in (row[c] for c in ("ids", "known", "x", "cluster", "keys", "places", "sizes"))]
    return pa.RecordBatch.from_arrays(
        [*cells, *(pa.array([row[c]], pa.list_(pa.int64())) for c in ("sums", "counts")), pa.array([row["scanned"]], pa.int64())],
        names=["ids", "known", "x", "cluster", "keys", "places", "sizes", "sums", "counts", "scanned"],
    )


_KINDS = {"ids": np.int64, "known": np.uint8, "x": np.int32, "cluster": np.int8, "keys": np.float64, "places": np.int32, "sizes": np.int32}


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """The blocks of a batch, one at a time; cells as arrays that may be written."""
    for i in range(batch.num_rows):
        row = {c: text_bytes(batch.column(c).slice(i, 1))[0].view(kind).copy() for c, kind in _KINDS.items() if c in batch.schema.names}
        for c in ("sums", "counts"):
            if c in batch.schema.names:
                row[c] = np.array(batch.column(c)[i].as_py(), np.int64)
        yield row


def step(state: DataFrame, centroids: np.ndarray, drift: np.ndarray) -> DataFrame:
    """The state after an assignment, written."""
    k, dim = centroids.shape

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in _rows(batch):
            heaps = Heaps.read(row["keys"], row["places"], row["sizes"])
            sums, counts = row["sums"].reshape(k, dim), row["counts"]
            row["scanned"] = assign(row["x"].reshape(-1, dim), row["cluster"], heaps, sums, counts, centroids, drift)
            row["keys"], row["places"], row["sizes"] = heaps.flat()
            row["sums"] = sums.ravel()
            yield _record(row)

    return written(arrow_map(state, run, STATE), "clusters", ROW_GROUPS)


def totals(state: DataFrame, k: int, dim: int) -> tuple[list[list[int]], list[int]]:
    """Exact sums of the vectors and their number, by cluster."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                both = np.concatenate([batch.column(0).flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0), batch.column(1).flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)])
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(both))), pa.array(both)], names=["slot", "n"])

    rows = state.select("sums", "counts").mapInArrow(add, "slot long, n long").groupBy("slot").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n")).collect()
    flat = [0] * (k * dim + k)
    for r in rows:  # a row for each component of a centroid
        flat[r["slot"]] = int(r["n"])
    return [flat[c * dim: (c + 1) * dim] for c in range(k)], flat[k * dim:]


def moved(centroids: np.ndarray, sums: list[list[int]], counts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(new centroids, what each cluster's drift grows by)."""
    new = np.array([[s // n for s in of] if n else old.tolist() for of, n, old in zip(sums, counts, centroids, strict=True)], np.int64).reshape(centroids.shape)
    far = np.sqrt(((new - centroids).astype(np.float64) ** 2).sum(axis=1)) * (1 + MARGIN)
    if len(far) == 1:
        return new, far
    top, second = np.sort(far)[::-1][:2]
    other = np.where(np.arange(len(far)) == far.argmax(), second, top)
    return new, (far + other) * (1 + MARGIN)


def starts(vectors: DataFrame, k: int) -> np.ndarray:
    order = F.sha2(F.concat(F.lit("3:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = vectors.orderBy(order, "embedding").limit(k).collect()
    return np.array([whole(np.array(r["embedding"])) for r in first], np.int64)


RESULT = "vec_id long, cluster int, distance long"


def cluster_vectors(vectors: DataFrame, k: int = CLUSTERS, dim: int = DIM, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of
    each usable row of ``vectors`` (vec_id, embedding)."""
    rows = usable(vectors, dim)
    centroids = starts(rows, k)
    k = len(centroids)
    if not k:
        return rows.select("vec_id", F.lit(0).alias("cluster"), *(F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")), F.lit("").alias("centroid_sha256")).where("false")
    block = BLOCK  # read here: tasks import the module anew
    state = written(arrow_map(rows, lambda batch: (_record(r) for r in _packed(batch, block, k, dim)), STATE), "vectors", ROW_GROUPS)
    drift = np.zeros(k)
    for _ in range(rounds):
        old, state = state, step(state, centroids, drift)
        dropped_table(old)
        new, more = moved(centroids, *totals(state, k, dim))
        if (new == centroids).all():  # nothing moves any more
            break
        centroids, drift = new, drift + more
    old, state = state, step(state, centroids, drift)
    dropped_table(old)

    def measured(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for row in _rows(batch):
            x = row["x"].reshape(-1, dim).astype(np.int64)
            off = x - centroids[row["cluster"]]
            ids = pa.array(row["ids"], mask=row["known"] == 0)
            yield pa.RecordBatch.from_arrays([ids, pa.array(row["cluster"].astype(np.int32)), pa.array((off * off).sum(axis=1))], names=["vec_id", "cluster", "distance"])

    out = written(arrow_map(state.select("ids", "known", "x", "cluster"), measured, RESULT), "clustered")
    dropped_table(state)
    inertia = [0] * k
    for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("d")).collect():
        inertia[r["cluster"]] = int(r["d"])
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values, kind: F.get(F.array(*(F.lit(v).cast(kind) for v in values)), F.col("cluster"))
    return out.select(
        "vec_id", "cluster", "distance", of(inertia, "long").alias("cluster_inertia"), F.lit(sum(inertia)).cast("long").alias("inertia"), of(names, "string").alias("centroid_sha256")
    )
