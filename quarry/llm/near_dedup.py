"""MinHash near-dedup: one permutation, densified, with star-shaped candidates.

A document's set is its distinct 5-word shingles (all words as one, if there
are fewer). Sets are hashed once: the hash space is cut into ``BINS`` bins
and each bin keeps its smallest shingle hash. Empty bins are filled by
optimal densification: bin i asks the bins h(i, 1), h(i, 2), ... until one
was not empty from the start, so two sets agree in a filled bin with the
probability of their Jaccard similarity. ``ROWS`` consecutive bins form a
band; equal bands put two sets into one bucket.

Equal sets are one class from the start and are never expanded into pairs;
a class is named by its fingerprint, whatever the ids of its rows.
Of a bucket's classes, the one that is met most often in buckets is the
centre; the candidates are the star of the others around it. Candidates are
confirmed on the full sets. What a star cannot decide - two classes of one
bucket that are still in different components - is compared afterwards, by
an exact prefix filter on their differences from the centre. So no link
between two classes of a bucket is lost, and a large group of copies that
were edited differently is not expanded into all pairs.

At similarity 0.85 a pair misses all 32 bands of 7 bins with probability
4e-6.

Defined cases: null or wordless texts have an empty set, link with nothing
and are their own component; a null doc_id gets a null component and kept
flag and takes no part; repeated rows are copies like others; rows that
share a doc_id have one verdict each, by their own text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm import words as W
from quarry.llm.components import components
from quarry.llm.tables import arrow_map, checked_broadcast, lists, text_blocks, written

SHINGLE = 5
BINS = 224
ROWS = 7
BANDS = BINS // ROWS
PERCENT = 85  # 100 * intersection >= PERCENT * union


def distinct_sets(h: np.ndarray, row: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each row, concatenated, and their number."""
    cut = np.searchsorted(row, np.arange(n_rows + 1))
    parts = [np.unique(h[a:b]) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    counts = np.fromiter((len(p) for p in parts), np.int64, n_rows)
    return (np.concatenate(parts) if parts else h[:0]), counts


def shingle_sets(raw: np.ndarray, at: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text: concatenated and counted."""
    h, row = W.run_hashes(W.scan(raw, at), width)
    return distinct_sets(h, row, len(at) - 1)


def fingerprints(sets: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over the hashes of each set: 128 bits that name it."""
    ends = np.concatenate([[0], np.cumsum(counts)])
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (sets, W.mix(sets))]
    s1, s2 = ((x[ends[1:]] - x[ends[:-1]]).view(np.int64) for x in sums)
    return s1, s2


def sketch(sets: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Densified one-permutation sketch, one row of BINS hashes for each
    non-empty set (``sets`` sorted within each)."""
    row = np.repeat(np.arange(len(counts)), counts)
    bin_ = ((sets >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    cell = row * BINS + bin_
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # sorted: the first of a bin is its smallest
    out = np.zeros(len(counts) * BINS, np.uint64)
    full = np.zeros(len(counts) * BINS, bool)
    out[cell[first]] = sets[first]
    full[cell[first]] = True
    empty = np.flatnonzero(~full)
    attempt = 0
    while len(empty):
        attempt += 1
        ask = W.mix(np.arange(BINS, dtype=np.uint64) + np.uint64(attempt << 16)) % np.uint64(BINS)
        source = empty - empty % BINS + ask[empty % BINS].astype(np.int64)
        hit = full[source]
        out[empty[hit]] = out[source[hit]]
        empty = empty[~hit]
    return out.reshape(len(counts), BINS)


def band_keys(sk: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band; the band's number is part of it."""
    h = np.zeros((len(sk), BANDS), np.uint64)
    parts = sk.reshape(len(sk), BANDS, ROWS)
    for k in range(ROWS):
        h = W.mix(h ^ parts[:, :, k])
    return W.mix(h + np.arange(1, BANDS + 1, dtype=np.uint64)[None, :])


def _sketches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    for rows, raw, at in text_blocks(batch):
        sets, counts = shingle_sets(raw, at)
        some = counts > 0
        s1, s2 = fingerprints(sets, counts)
        keys = band_keys(sketch(sets, counts[some])) if some.any() else np.zeros((0, BANDS), np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                ids.slice(rows.start, rows.stop - rows.start),
                pa.array(counts, pa.int64()),
                pa.array(s1),
                pa.array(s2),
                lists(keys.ravel().view(np.int64), np.where(some, BANDS, 0), pa.int64()),
            ],
            names=["doc_id", "n_shingles", "s1", "s2", "keys"],
        )


def _set_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    ids = batch.column(batch.schema.get_field_index("doc_id"))
    for rows, raw, at in text_blocks(batch, most=1 << 20):
        sets, counts = shingle_sets(raw, at)
        s1, s2 = fingerprints(sets, counts)
        yield pa.RecordBatch.from_arrays(
            [
                ids.slice(rows.start, rows.stop - rows.start),
                pa.array(counts, pa.int64()),
                pa.array(s1),
                pa.array(s2),
                lists(sets.view(np.int64), counts, pa.int64()),
            ],
            names=["doc_id", "n_shingles", "s1", "s2", "shingles"],
        )


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, inter, na, nb) of candidate pairs, from the full sets."""
    sa = sets.select(F.col("cid").alias("a"), F.col("shingles").alias("sa"))
    sb = sets.select(F.col("cid").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.select("a", "b").join(sa, "a").join(sb, "b")
    return both.select("a", "b", F.size(F.array_intersect("sa", "sb")).alias("inter"), F.size("sa").alias("na"), F.size("sb").alias("nb"))


def _links(confirmed: DataFrame) -> DataFrame:
    return confirmed.where(F.col("inter") * 100 >= F.lit(PERCENT) * (F.col("na") + F.col("nb") - F.col("inter"))).select("a", "b")


def _sizes_allow(na: str, nb: str):
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * F.lit(PERCENT)


def _around_centres(open_: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of classes of one centre in different components that may
    still be linked.

    For sets x, y and their centre R let D be the symmetric difference with
    R. Then |x ^ y| = |D(x) ^ D(y)|, and a link needs |x ^ y| to be at most
    15 / 185 of |x| + |y|. Two sets with too little in common in D are no
    link; if they need nothing in common there, both are linked to R. So a
    pair that is left shares one of the rarest elements of D: of x's, the
    first 15 / 85 * |x| + 1 (a prefix filter, exact). The first element that
    they share, rarest first, also tells how many more they can share: what
    stands behind it in both (a positional filter, exact).

    That filter comes apart into a number for each side: with p elements up to
    and with the shared one, the pair needs v(x) + v(y) <= 0 for
    v = p - 1 - 15 / 185 * n. So only rows with v <= 0 are one side of the
    join, and the other side keeps the rows that the lowest v of their
    (centre, element) can make up for. Pages that share most of their text
    but are no near copies have their own elements first, hence v > 0, and
    are not joined on what all of them share."""
    sr = sets.select(F.col("cid").alias("centre"), F.col("shingles").alias("sr"))
    diff = (
        open_.join(sets, "cid")
        .join(sr, "centre")
        .select("centre", "cid", "comp", "n", F.concat(F.array_except("shingles", "sr"), F.array_except("sr", "shingles")).alias("d"))
    )
    elements = written(diff.select("centre", "cid", "comp", "n", F.size("d").alias("size"), F.explode("d").alias("e")), "differences")
    often = elements.groupBy("centre", "e").agg(F.count("*").alias("f")).where("f > 1")
    one = Window.partitionBy("centre", "cid")
    place = F.col("size") - F.count("*").over(one) + F.row_number().over(one.orderBy("f", "e"))
    allowed = F.floor(F.col("n") * (100 - PERCENT) / PERCENT) + 1
    excess = (F.col("place") - 1) * (100 + PERCENT) - F.col("n") * (100 - PERCENT)  # v, in whole numbers
    prefix = written(
        elements.join(often, ["centre", "e"])
        .withColumn("place", place)
        .where(F.col("place") <= allowed)
        .select("centre", "e", "cid", "comp", "n", "size", "place", excess.alias("v")),
        "prefixes",
    )
    lowest = prefix.where("v <= 0").groupBy("centre", "e").agg(F.min("v").alias("low"))
    able = written(prefix.join(lowest, ["centre", "e"]).where("v + low <= 0").drop("low"), "able")
    x, y = able.where("v <= 0").alias("x"), able.alias("y")
    same = (F.col("x.centre") == F.col("y.centre")) & (F.col("x.e") == F.col("y.e"))
    once = (F.col("y.v") > 0) | (F.col("x.cid") < F.col("y.cid"))  # of two rows that both stand as x
    behind = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    apart = (F.col("x.size") + F.col("y.size") - 2 * (1 + behind)) * (100 + PERCENT)  # |x ^ y| at least
    return (
        x.join(y, same & once & (F.col("x.comp") != F.col("y.comp")) & (F.col("x.v") + F.col("y.v") <= 0))
        .where(_sizes_allow("x.n", "y.n") & (apart <= (F.col("x.n") + F.col("y.n")) * (100 - PERCENT)))
        .select(F.least("x.cid", "y.cid").alias("a"), F.greatest("x.cid", "y.cid").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``
    (doc_id, text)."""
    docs = docs.select("doc_id", "text")
    sketched = written(
        arrow_map(docs, _sketches, "doc_id long, n_shingles long, s1 long, s2 long, keys array<long>"), "sketches"
    )
    named = sketched.where("doc_id is not null and n_shingles > 0")
    groups = named.groupBy("s1", "s2", "n_shingles").agg(F.min("doc_id").alias("doc_id"), F.any_value("keys").alias("keys"))
    classes = written(groups.withColumn("cid", F.monotonically_increasing_id()), "classes")  # numbers stand once they are written
    bands = classes.select("cid", F.col("n_shingles").alias("n"), F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("m")).where("m > 1")
    members = written(bands.join(shared, "key"), "members")
    met = members.groupBy("cid").agg(F.sum("m").alias("met"))
    centres = (
        members.join(met, "cid")
        .groupBy("key")
        .agg(F.max(F.struct("met", (-F.col("cid")).alias("neg"), "n")).alias("c"))
        .select("key", (-F.col("c.neg")).alias("centre"), F.col("c.n").alias("nc"))
    )
    spokes = written(members.join(centres, "key").where("cid <> centre"), "spokes")
    stars = spokes.where(_sizes_allow("n", "nc")).select(F.col("cid").alias("a"), F.col("centre").alias("b")).distinct()

    met_once = members.select("cid").distinct()
    needed = checked_broadcast(written(classes.drop("keys").join(met_once, "cid", "left_semi"), "needed"))
    one_each = docs.join(needed.select("doc_id").distinct(), "doc_id", "left_semi")
    scanned = arrow_map(one_each, _set_rows, "doc_id long, n_shingles long, s1 long, s2 long, shingles array<long>")
    by_class = scanned.join(needed, ["doc_id", "n_shingles", "s1", "s2"]).select("cid", "shingles")
    sets = written(by_class.dropDuplicates(["cid"]), "sets")

    confirmed = written(_confirm(stars, sets), "confirmed")
    links = written(_links(confirmed), "links")
    first = components(links)

    label = first.select(F.col("node").alias("cid"), "label")
    placed = spokes.join(label, "cid", "left").select("key", "cid", "centre", "n", F.coalesce("label", "cid").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi").select("key")
    open_ = written(placed.join(mixed, "key", "left_semi").select("cid", "centre", "n", "comp").distinct(), "open")
    pairs = _around_centres(open_, sets)
    more = written(_links(_confirm(pairs, sets)), "links")
    found = first if more.isEmpty() else components(links.unionAll(more))

    grouped = classes.drop("keys").join(found.select(F.col("node").alias("cid"), "label"), "cid", "left").withColumn("label", F.coalesce("label", "cid"))
    smallest = grouped.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    verdicts = grouped.join(smallest, "label").select("s1", "s2", "n_shingles", "component_id")
    full = named.select("doc_id", "s1", "s2", "n_shingles").join(verdicts, ["s1", "s2", "n_shingles"]).select("doc_id", "n_shingles", "component_id")
    rest = sketched.where("doc_id is null or n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return full.unionAll(rest).withColumn("kept", F.col("doc_id") == F.col("component_id"))
