"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE`` words; the last may be
shorter). Every passage is encoded: shape and repetition measures and a
hashed word histogram go through a small hidden layer. Gated attention
gives each passage a weight, the weighted sum of encodings is the document,
and a logistic unit scores it. Only document labels are needed to learn the
weights.

Training runs on the driver over a bounded sample: ``TRAIN_DOCS`` labelled
documents (those with the smallest hashes of doc_id) with at most
``TRAIN_PASSAGES`` evenly spaced passages each. Scoring covers every
passage of every document, on the executors.

Held out from learning are rows whose crc32(doc_id as text) mod 5 is 0.

Defined cases: null, empty and wordless texts are one empty passage; a null
doc_id is held out; rows without a label, or with one that is not 0 or 1,
are not learnt from; if no labels are there, or all are equal, the score
is their (smoothed) mean for every document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import words as W
from quarry.llm.near_dedup import distinct_sets
from quarry.llm.tables import arrow_map, blobs, text_blocks

PASSAGE = 64  # words
BAG = 64  # buckets of the hashed word histogram
TRAIN_DOCS = 8192
TRAIN_PASSAGES = 512
HIDDEN, ATTENTION = 24, 12
EPOCHS, BATCH, RATE, DECAY = 24, 128, 5e-3, 1e-4
THRESHOLD = 0.3

_KINDS = [
    [*range(0x41, 0x5B)],  # capitals
    [*range(0x30, 0x3A)],  # digits
    [*range(0x80, 0x100)],  # beyond ASCII
    [ord(c) for c in ".,"],
    [ord(c) for c in "!?"],
    [ord(c) for c in "|/\\<>{}[]()=_:;-"],
    [ord(c) for c in "#$%&*@^~+`'\""],
]
MEASURES = 2 * len(_KINDS) + 8
FEATURES = MEASURES + BAG


def passage_features(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one row of FEATURES for each passage, passages of each text)."""
    w = W.scan(raw, at)
    counts = w.counts()
    n_rows = len(counts)
    passages = np.maximum(1, -(-counts // PASSAGE))
    row = np.repeat(np.arange(n_rows), passages)
    within = np.arange(len(row)) - np.repeat(np.cumsum(passages) - passages, passages)
    a = w.first[:-1][row] + within * PASSAGE
    b = np.minimum(a + PASSAGE, w.first[1:][row])
    size = np.maximum(b - a, 1).astype(np.float32)
    out = np.zeros((len(row), FEATURES), np.float32)
    length = w.end - w.start
    col = 0

    def total(values: np.ndarray) -> np.ndarray:
        run = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return run[b] - run[a]

    n_bytes = np.maximum(total(length), 1).astype(np.float32)
    for kind in _KINDS:
        table = np.zeros(256, np.uint8)
        table[kind] = 1
        run = np.concatenate([[0], np.cumsum(table[raw], dtype=np.int32)])
        in_word = run[w.end] - run[w.start]
        out[:, col] = total(in_word) / n_bytes
        out[:, col + 1] = total(in_word > 0) / size
        col += 2
    run = np.concatenate([[0], np.cumsum(raw == 0x0A, dtype=np.int32)])
    first_byte = w.start[np.minimum(a, max(len(w.start) - 1, 0))] if len(w.start) else np.zeros(len(row), np.int64)
    last_byte = w.end[np.maximum(b - 1, 0)] if len(w.start) else first_byte
    out[:, col] = np.where(b > a, run[last_byte] - run[first_byte], 0) / size  # lines
    out[:, col + 1] = n_bytes / size / 8
    out[:, col + 2] = total(length <= 3) / size
    out[:, col + 3] = np.log1p(b - a) / 4
    # Repetition: within the passage, next to each other, and in the whole text.
    grid = np.arange(PASSAGE)[None, :]
    filled = grid < (b - a)[:, None]
    cells = np.where(filled, w.hash[np.minimum(a[:, None] + grid, max(len(w.hash) - 1, 0))], np.uint64(0)) if len(w.hash) else np.zeros((len(row), PASSAGE), np.uint64)
    cells.sort(axis=1)
    distinct = 1 + (cells[:, 1:] != cells[:, :-1]).sum(axis=1) - (~filled).any(axis=1)
    out[:, col + 4] = distinct / size
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    out[:, col + 5] = total(same) / size
    three, three_row = W.run_hashes(w, 3)
    _, kinds = distinct_sets(three, three_row, n_rows)
    runs = np.maximum(np.where(counts >= 3, counts - 2, np.minimum(counts, 1)), 1)
    out[:, col + 6] = (kinds / runs)[row]
    out[:, col + 7] = (np.log1p(counts) / 10)[row]
    of = np.repeat(np.arange(len(row)), b - a)
    bucket = (w.hash >> np.uint64(64 - 6)).astype(np.int64)
    out[:, MEASURES:] = np.bincount(of * BAG + bucket, minlength=len(row) * BAG).reshape(len(row), BAG) / size[:, None]
    return out, passages


class Model:
    """Parameters; ``score`` gives one number from 0 to 1 for each bag."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, p: dict[str, np.ndarray] | None, base: float):
        self.mean, self.scale, self.p, self.base = mean, scale, p, base

    def score(self, x: np.ndarray, passages: np.ndarray) -> np.ndarray:
        if self.p is None:
            return np.full(len(passages), self.base)
        return _forward(self.p, (x - self.mean) / self.scale, passages)["y"]


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -40, 40)))


def _forward(p: dict[str, np.ndarray], x: np.ndarray, passages: np.ndarray) -> dict[str, np.ndarray]:
    start = np.cumsum(passages) - passages
    h = np.tanh(x @ p["w"] + p["wb"])
    t, g = np.tanh(h @ p["v"]), _sigmoid(h @ p["u"])
    e = (t * g) @ p["a"]
    e = np.exp(e - np.repeat(np.maximum.reduceat(e, start), passages))
    att = e / np.repeat(np.add.reduceat(e, start), passages)
    z = np.add.reduceat(h * att[:, None], start, axis=0)
    return {"h": h, "t": t, "g": g, "att": att, "z": z, "y": _sigmoid(z @ p["c"] + p["cb"])}


def _gradient(p: dict[str, np.ndarray], x: np.ndarray, passages: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
    f = _forward(p, x, passages)
    start = np.cumsum(passages) - passages
    dy = (f["y"] - label) / len(label)
    dz = np.repeat(dy[:, None] * p["c"][None, :], passages, axis=0)
    datt = (f["h"] * dz).sum(axis=1)
    de = f["att"] * (datt - np.repeat(np.add.reduceat(datt * f["att"], start), passages))
    dt = de[:, None] * p["a"] * f["g"] * (1 - f["t"] ** 2)
    dg = de[:, None] * p["a"] * f["t"] * f["g"] * (1 - f["g"])
    dh = (f["att"][:, None] * dz + dt @ p["v"].T + dg @ p["u"].T) * (1 - f["h"] ** 2)
    grad = {"w": x.T @ dh, "wb": dh.sum(axis=0), "v": f["h"].T @ dt, "u": f["h"].T @ dg, "a": (f["t"] * f["g"]).T @ de, "c": f["z"].T @ dy, "cb": dy.sum()}
    return {k: grad[k] + DECAY * p[k] for k in p}


def train(x: np.ndarray, passages: np.ndarray, label: np.ndarray) -> Model:
    """Adam over mini-batches of bags; the same input gives the same model."""
    base = float((label.sum() + 1) / (len(label) + 2))
    if not len(label) or label.min() == label.max():
        return Model(np.zeros(FEATURES), np.ones(FEATURES), None, base)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    x = (x - mean) / scale
    rng = np.random.default_rng(7)
    init = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
    p = {"w": init(FEATURES, HIDDEN), "wb": np.zeros(HIDDEN), "v": init(HIDDEN, ATTENTION), "u": init(HIDDEN, ATTENTION), "a": init(ATTENTION),
         "c": init(HIDDEN), "cb": np.array(np.log(base / (1 - base)))}
    m = {k: np.zeros_like(v) for k, v in p.items()}
    s = {k: np.zeros_like(v) for k, v in p.items()}
    start = np.cumsum(passages) - passages
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(label))
        for k in range(0, len(order), BATCH):
            bags = np.sort(order[k: k + BATCH])
            n = passages[bags]
            rows = np.repeat(start[bags] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            grad = _gradient(p, x[rows], n, label[bags])
            step += 1
            for name, g in grad.items():
                m[name] = 0.9 * m[name] + 0.1 * g
                s[name] = 0.999 * s[name] + 0.001 * g * g
                p[name] = p[name] - RATE * (m[name] / (1 - 0.9**step)) / (np.sqrt(s[name] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, p, base)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(True))


def _bags(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Features of the training documents, evenly thinned to TRAIN_PASSAGES."""
    for rows, raw, at in text_blocks(batch):
        x, n = passage_features(raw, at)
        starts = np.cumsum(n) - n
        picks = [s + (np.arange(min(k, TRAIN_PASSAGES)) * k // min(k, TRAIN_PASSAGES)) for s, k in zip(starts, n, strict=True)]
        kept = np.array([len(q) for q in picks])
        size = rows.stop - rows.start
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).slice(rows.start, size), batch.column(1).slice(rows.start, size), blobs(x[np.concatenate(picks)].ravel(), kept * FEATURES)],
            names=["doc_id", "quality", "x"],
        )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model for (doc_id, text) and (doc_id, quality)."""
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(F.col("quality").isin(0, 1) & ~held_out())
    sample = usable.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(TRAIN_DOCS)
    labelled = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "quality", "text")
    rows = arrow_map(labelled, _bags, "doc_id long, quality int, x binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["quality"], bytes(r["x"])))
    bags = [np.frombuffer(r["x"], np.float32).reshape(-1, FEATURES) for r in rows]
    x = np.concatenate(bags).astype(np.float64) if bags else np.zeros((0, FEATURES))
    return train(x, np.array([len(b) for b in bags], np.int64), np.array([r["quality"] for r in rows], np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs``."""
    model = model or fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for rows, raw, at in text_blocks(batch):
            s = sent.value.score(*passage_features(raw, at))
            yield pa.RecordBatch.from_arrays([ids.slice(rows.start, rows.stop - rows.start), pa.array(s, pa.float64())], names=["doc_id", "score"])

    scored = arrow_map(docs.select("doc_id", "text"), score, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, whatever its other columns, that are not rejected."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        scores = [sent.value.score(*passage_features(raw, at)) for _, raw, at in text_blocks(batch)]
        yield batch.filter(pa.array(np.concatenate(scores) >= THRESHOLD))

    return arrow_map(docs, run, docs.schema)
