"""Benchmark decontamination with a distributed positional inverted index.

Documents are cut into segments of a few megabytes. Each segment gets an
index of all its words: the sorted distinct terms and, for every term, the
sorted positions at which it stands (a posting list). The index is written
to the shared folder, one row a segment, and searched from there.

A phrase is found in a segment by intersection: the posting lists of its
terms, from the rarest on, are shifted by the term's place in the phrase,
and only starts that are in all of them survive. A phrase never crosses
the end of a document. ``near`` finds the looser case: all distinct terms of the
phrase, in any order, within a run of words of one document that is at most
``slack`` words longer than the phrase. Places of the rarest term are kept
only while each further term stands close to them; runs are tried for what
is left.

The benchmark is searched in blocks of a bounded number of words, so that
what the driver holds and sends to the executors does not grow with it. With
several blocks, each one's matches are written before the next is sent, and
then united for each document.

Words are runs of digits, ASCII letters (lower-cased) and non-ASCII bytes.
A window is ``WINDOW`` consecutive words of an item; an item with fewer
words, but not none, is one window.

Defined cases: null and wordless documents have no words and no hits; null
and wordless items have no windows; an item without item_id marks words as
hit but is not listed; repeated items count once; a null or repeated doc_id
is just carried along, row by row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import words as W
from quarry.llm.tables import ROW_GROUPS, arrow_map, blobs, lists, text_blocks, written

WINDOW = 13
SEGMENT = 2 << 20  # bytes of text in a segment
ITEM_WORDS = 1_000_000  # benchmark words searched at once
SLACK = 7  # a proximity match may be so many words longer than its phrase
ANCHORS = 1 << 14  # places whose runs are tried at once

INDEX = "doc_ids array<long>, first binary, terms binary, counts binary, postings binary"


class Segment:
    """Positional index of some documents: postings of terms[i] are
    ``postings[heads[i]:heads[i + 1]]``; document r has the word positions
    ``first[r] .. first[r + 1]``."""

    def __init__(self, first: np.ndarray, terms: np.ndarray, heads: np.ndarray, postings: np.ndarray):
        self.first, self.terms, self.heads, self.postings = first, terms, heads, postings

    @classmethod
    def of(cls, words: W.Words) -> Segment:
        order = np.argsort(words.hash, kind="stable")
        sorted_ = words.hash[order]
        new = np.ones(len(order), bool)
        new[1:] = sorted_[1:] != sorted_[:-1]
        heads = np.append(np.flatnonzero(new), len(order))
        return cls(words.first, sorted_[new], heads, order)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Term number and document frequency (in words) of each hash; 0 if absent."""
        if not len(self.terms):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        there = self.terms[at] == hashes
        return at, np.where(there, self.heads[at + 1] - self.heads[at], 0)

    def positions(self, term: int) -> np.ndarray:
        return self.postings[self.heads[term]: self.heads[term + 1]].astype(np.int64)

    def phrase(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Starts of a phrase whose term numbers and frequencies are given."""
        order = np.argsort(counts, kind="stable")
        starts = self.positions(terms[order[0]]) - order[0]
        starts = starts[starts >= 0]
        for k in order[1:]:
            if not len(starts):
                return starts
            other = self.positions(terms[k])
            at = np.minimum(np.searchsorted(other, starts + k), len(other) - 1)
            starts = starts[other[at] == starts + k]
        if len(starts):  # inside one document
            doc = np.searchsorted(self.first, starts, side="right")
            starts = starts[starts + len(terms) <= self.first[doc]]
        return starts

    def near(self, terms: np.ndarray, counts: np.ndarray, span: int) -> np.ndarray:
        """Positions of the rarest term that lie in a run of ``span`` words of
        one document that holds all the terms."""
        rarest = terms[np.argsort(counts, kind="stable")]
        _, at = np.unique(rarest, return_index=True)
        others = [self.positions(t) for t in rarest[np.sort(at)[1:]]]
        anchors = self.positions(rarest[0])
        doc = np.searchsorted(self.first, anchors, side="right")
        start, end = self.first[doc - 1], self.first[doc]
        for other in others:
            lo, hi = np.maximum(anchors - span + 1, start), np.minimum(anchors + span, end)
            ok = np.searchsorted(other, hi) > np.searchsorted(other, lo)
            if not ok.any():
                return anchors[:0]
            anchors, start, end = anchors[ok], start[ok], end[ok]
        found = [self._runs(anchors[k: k + ANCHORS], start[k: k + ANCHORS], end[k: k + ANCHORS], others, span) for k in range(0, len(anchors), ANCHORS)]
        return np.concatenate(found)

    @staticmethod
    def _runs(anchors: np.ndarray, start: np.ndarray, end: np.ndarray, others: list[np.ndarray], span: int) -> np.ndarray:
        runs = anchors[:, None] - np.arange(span)[None, :]
        lo, hi = np.maximum(runs, start[:, None]), np.minimum(runs + span, end[:, None])
        ok = np.ones(runs.shape, bool)
        for other in others:
            ok &= np.searchsorted(other, hi) > np.searchsorted(other, lo)
        return anchors[ok.any(axis=1)]


def _segments(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    for rows, raw, at in text_blocks(batch, most=SEGMENT):
        s = Segment.of(W.scan(raw, at, W.ALNUM))
        n = rows.stop - rows.start
        counts = np.diff(s.heads)  # small numbers: they compress well
        one = [np.array([len(x)]) for x in (s.first, s.terms, counts, s.postings)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids.slice(rows.start, n)),
                blobs(s.first.astype(np.uint32), one[0]),
                blobs(s.terms, one[1]),
                blobs(counts.astype(np.uint32), one[2]),
                blobs(s.postings.astype(np.uint32), one[3]),
            ],
            names=["doc_ids", "first", "terms", "counts", "postings"],
        )


def build_index(docs: DataFrame) -> DataFrame:
    """Positional index of (doc_id, text), a row a segment, in the shared folder."""
    rows = arrow_map(docs.select("doc_id", "text"), _segments, INDEX)
    return written(rows.select(F.monotonically_increasing_id().alias("segment"), "*"), "index", ROW_GROUPS)


def _item_words(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = batch.column(batch.schema.get_field_index("item_id"))
    for rows, raw, at in text_blocks(batch):
        w = W.scan(raw, at, W.ALNUM)
        yield pa.RecordBatch.from_arrays(
            [ids.slice(rows.start, rows.stop - rows.start), lists(w.hash.view(np.int64), w.counts(), pa.int64())], names=["item_id", "words"]
        )


def item_table(benchmark: DataFrame, most: int = ITEM_WORDS) -> tuple[DataFrame, int]:
    """The items with words, written, and the number of blocks of about ``most`` words."""
    items = written(arrow_map(benchmark.select("item_id", "text"), _item_words, "item_id long, words array<long>").where("size(words) > 0"), "items")
    total = items.agg(F.sum(F.size("words")).alias("n")).first()["n"] or 0
    return items, -(-total // most)


def item_block(items: DataFrame, k: int, n: int) -> tuple[list, np.ndarray, np.ndarray]:
    """(item ids, word hashes, first word of each) of block ``k`` of ``n``."""
    part = items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(n)) == k)
    rows = part.collect()
    counts = [len(r["words"]) for r in rows]
    hashes = np.array([h for r in rows for h in r["words"]], np.int64).view(np.uint64)
    return [r["item_id"] for r in rows], hashes, np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


def _alive(seg: Segment, hashes: np.ndarray, first: np.ndarray, width: int):
    """(item row, term numbers, frequencies) of windows with all terms in the segment."""
    term, count = seg.find(hashes)
    at, row = W.windows(W.Words(hashes, None, None, first), width)
    size = np.minimum(np.diff(first), width)[row]
    none = np.concatenate([[0], np.cumsum(count == 0)])
    for k in np.flatnonzero(none[at + size] == none[at]):
        a, b = at[k], at[k] + size[k]
        yield int(row[k]), term[a:b], count[a:b]


def _search(batch: pa.RecordBatch, items: tuple, width: int, slack: int | None) -> Iterator[pa.RecordBatch]:
    names, hashes, item_first = items
    for r in range(batch.num_rows):
        cell = {c: batch.column(i)[r] for i, c in enumerate(batch.schema.names)}
        first, counts, postings = (np.frombuffer(cell[c].as_buffer(), np.uint32) for c in ("first", "counts", "postings"))
        first, heads = first.astype(np.int64), np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        seg = Segment(first, np.frombuffer(cell["terms"].as_buffer(), np.uint64), heads, postings)
        n = len(first) - 1
        mark = np.zeros(first[-1] + 1, np.int64)
        found: list[set] = [set() for _ in range(n)]
        close: list[set] = [set() for _ in range(n)]
        for item, terms, counts in _alive(seg, hashes, item_first, width):
            starts = seg.phrase(terms, counts)
            np.add.at(mark, starts, 1)
            np.add.at(mark, starts + len(terms), -1)
            for d in np.unique(np.searchsorted(first, starts, side="right") - 1):
                found[d].add(item)
            if slack is not None:
                for d in np.unique(np.searchsorted(first, seg.near(terms, counts, len(terms) + slack), side="right") - 1):
                    close[d].add(item)
        hit = np.cumsum(mark[:-1]) > 0
        edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
        run = edge.reshape(-1, 2)  # hit runs; cut where a document ends
        inner = first[1:-1]
        cut = np.unique(np.concatenate([run.ravel(), inner[(inner < first[-1]) & (inner > 0)]]))
        a, b = cut[:-1], cut[1:]
        keep = hit[a] if len(a) else np.zeros(0, bool)
        a, b = a[keep], b[keep]
        doc = np.searchsorted(first, a, side="right") - 1
        runs = np.bincount(doc, minlength=n)[:n] if len(doc) else np.zeros(n, np.int64)
        ids = lambda sets: pa.array([[names[i] for i in sorted(s)] for s in sets], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n, cell["segment"].as_py()), pa.int64()),
                pa.array(np.arange(n), pa.int64()),
                cell["doc_ids"].values.cast(pa.int64()),
                pa.array(np.diff(first), pa.int64()),
                lists((a - first[doc]).astype(np.int64), runs, pa.int64()),
                lists((b - first[doc]).astype(np.int64), runs, pa.int64()),
                ids(found),
                ids(close),
            ],
            names=["segment", "row", "doc_id", "n_words", "starts", "ends", "items", "near_items"],
        )


def _united(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Hit runs of several blocks made disjoint."""
    out = batch.to_pandas()
    new = []
    for starts, ends in zip(out["starts"], out["ends"], strict=True):
        merged: list[list[int]] = []
        for a, b in sorted(zip(starts, ends, strict=True)):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        new.append(merged)
    out["starts"], out["ends"] = [[a for a, _ in m] for m in new], [[b for _, b in m] for m in new]
    yield pa.RecordBatch.from_pandas(out, schema=batch.schema, preserve_index=False)


FOUND = "segment long, row long, doc_id long, n_words long, starts array<long>, ends array<long>, items array<long>, near_items array<long>"


def search(index: DataFrame, benchmark: DataFrame, width: int = WINDOW, slack: int | None = None, block_words: int = ITEM_WORDS) -> DataFrame:
    """One row per document: its number of words, its hit runs of words
    (``starts`` .. ``ends``), the items with occurring windows and, with
    ``slack``, those with a proximity match of a window."""
    context = index.sparkSession.sparkContext
    items, n = item_table(benchmark, block_words)
    if n <= 1:
        sent = context.broadcast(item_block(items, 0, 1))
        return arrow_map(index, lambda b: _search(b, sent.value, width, slack), FOUND)
    parts = []
    for k in range(n):
        sent = context.broadcast(item_block(items, k, n))
        parts.append(written(arrow_map(index, lambda b, sent=sent: _search(b, sent.value, width, slack), FOUND), "found", ROW_GROUPS))
        sent.destroy()
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionAll(p)
    flat = lambda c: F.flatten(F.collect_list(c)).alias(c)  # noqa: E731  one row a block
    grouped = rows.groupBy("segment", "row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), flat("starts"), flat("ends"), flat("items"), flat("near_items")
    )
    return arrow_map(grouped, _united, FOUND)


def _names(items: str) -> Column:
    return F.array_sort(F.array_distinct(F.transform(F.filter(items, lambda x: x.isNotNull()), lambda x: x.cast("string"))))


def contamination(docs: DataFrame, benchmark: DataFrame, slack: int | None = None) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) for each
    document; with ``slack`` also n_near and near_sha256, the items with a
    proximity match. The verdict goes by exact matches alone."""
    found = search(build_index(docs), benchmark, slack=slack)
    n_hit = F.aggregate(F.zip_with("starts", "ends", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    listed = lambda c, count, digest: [F.size(c).cast("long").alias(count), F.sha2(F.array_join(c, ","), 256).alias(digest)]
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), _names("items").alias("items"), _names("near_items").alias("near")).select(
        "doc_id",
        "n_words",
        "n_hit",
        *listed("items", "n_items", "items_sha256"),
        ((F.col("n_hit") > 0) & (F.col("n_hit") * 20 >= F.col("n_words"))).alias("contaminated"),
        *(listed("near", "n_near", "near_sha256") if slack is not None else []),
    )
