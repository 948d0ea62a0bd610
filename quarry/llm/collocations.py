"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z) and cut into pieces at ``.,;:!?`` and line breaks,
pieces into words at spaces and tabs. Everything is counted per lang.

* Texts are written once as chunks of some megabytes and one lang: words with
  one space between them, pieces with a line break.
* For phrases of 1, 2, ... words: prefix sums of a polynomial over a chunk's
  bytes give the fingerprint of every phrase by one subtraction and one product.
  Equal fingerprints of a chunk are compared byte by byte, so an entry
  (fingerprint, count, place of its first occurrence in the chunk) is one text.
  Entries are shuffled in blobs by the first bits of the fingerprint, and summed.
* A phrase cannot occur more often than the phrases within it. So fingerprints
  of the frequent phrases go into a bitmap of fixed size, made on the executors,
  and the next length only takes phrases whose two parts are in it. (A slot
  shared by two phrases only costs an entry.)
* Only the occurrence pointers of frequent fingerprints go back to the chunks,
  where their phrases are read from the text. Counts are summed by the text
  itself: a collision between chunks is undone here.
* Scores are decimal arithmetic on exact counts.

The score of a cut after k words is floor(1000000 * a * a / (l * r)); the lowest
counts. A candidate is dropped if a longer one that holds it has at least half
its count. The first ``most`` of each lang are ranked in two steps, first in
salted parts of the lang, so that no task holds a lang.

Defined cases: a null lang is ``und``; null texts and texts without words give
nothing; repeated rows count each; words may be of any length; a text is cut at
piece ends, and only a single piece must fit in a task. Counts from 10**15 on end
the job with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.tables import ROW_GROUPS, blobs, checked_broadcast, release, text_blocks, written
from quarry.llm.words import LOWER, mix, text_bytes

LONGEST, LEAST, MOST = 3, 10, 2000
INSIDE = 50  # per cent of a phrase's occurrences that lie in a longer one
CHUNK = 8 << 20
PIECE = 1 << 17  # bytes hashed at once
SLOT_BITS = 26  # of the bitmap of frequent fingerprints
BUCKET_BITS = 9  # at least
ENTRIES = 1 << 20  # words for which a bucket is made
SALTED = 1 << 20  # candidates for which a part of a lang is made

_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?"]] = True
_CUT[0x0A:0x0E] = True
_WORD = ~_CUT
_WORD[[0x20, 0x09]] = False
SPACE, BREAK = 0x20, 0x0A
_BASE = np.uint64(0xD1342543DE82EF95)


def normalised(raw: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Words of some rows (``rows``: where they start), each with a space after
    it, or a line break if its piece ends there."""
    folded = LOWER[raw]
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _WORD[folded]
    new = inside[1:-1] & ~inside[:-2]
    at = rows[rows < len(raw)]
    new[at] = inside[1 + at]
    start = np.flatnonzero(new)
    over = inside[1:-1] & ~inside[2:]
    before = at[at > 0] - 1
    over[before] = inside[1 + before]
    end = np.flatnonzero(over) + 1
    size = end - start + 1
    to = np.cumsum(size) - size
    ends = to + size - 1
    cuts = np.zeros(len(raw) + 1, np.int64)
    np.cumsum(_CUT[folded], out=cuts[1:])
    piece = cuts[start] + np.searchsorted(at, start, side="right")
    take = np.repeat(start - to, size)
    take += np.arange(len(take))
    out = np.append(folded, np.uint8(0))[take]
    out[ends] = SPACE
    out[ends[:-1][piece[1:] != piece[:-1]]] = BREAK
    out[ends[-1:]] = BREAK
    return out


def _spans(raw: np.ndarray, at: np.ndarray, most: int = 2 << 20) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bytes, row starts) of parts that end with a row or a piece."""
    if len(raw) <= 2 * most:
        yield raw, at[:-1]
        return
    ends = np.union1d(at[1:], np.flatnonzero(_CUT[raw]) + 1)
    a = 0
    while a < len(raw):
        b = int(ends[min(np.searchsorted(ends, a + most), len(ends) - 1)])
        yield raw[a:b], np.append(0, at[np.searchsorted(at, a, side="right"): np.searchsorted(at, b)] - a)
        a = b


CHUNKS = "chunk long, lang string, words long, text binary"


def chunks(docs: DataFrame) -> DataFrame:
    """(chunk, lang, words, text) of ``docs`` (lang, text), written."""
    chunk = CHUNK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            lang = batch.column(0)
            for name in lang.unique().to_pylist():
                mine, parts, size = batch.filter(pc.equal(lang, name)), [], 0
                for _, raw, at in text_blocks(mine):
                    for part in _spans(raw, at):
                        parts.append(normalised(*part))
                        size += len(parts[-1])
                        if size >= chunk:
                            yield _chunk(number, name, parts)
                            number, parts, size = number + 1, [], 0
                if size:
                    yield _chunk(number, name, parts)
                    number += 1
                del mine, parts
            del batch, lang
            release()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return written(rows.mapInArrow(run, CHUNKS), "chunks", ROW_GROUPS | {"compression": "zstd"})


def _chunk(number: int, lang: str, parts: list[np.ndarray]) -> pa.RecordBatch:
    text = np.concatenate(parts)
    words = int(np.count_nonzero((text == SPACE) | (text == BREAK)))
    return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([lang]), pa.array([words]), blobs(text, np.array([len(text)]))], names=["chunk", "lang", "words", "text"])


_powers: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for places below n."""
    if _powers and len(_powers[0][0]) > n:
        return _powers[0]
    n = max(n, 2 * PIECE)
    inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
    both = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, b)]), dtype=np.uint64) for b in (_BASE, inverse))
    if n <= 8 * PIECE:  # an extraordinary phrase: its tables are not kept
        _powers[:] = [both]
    return both


def fingerprints(text: np.ndarray, a: np.ndarray, b: np.ndarray, seed: np.uint64) -> np.ndarray:
    """Fingerprint of the bytes [a, b) for each pair (a rising), from prefix polynomials."""
    out = np.empty(len(a), np.uint64)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(a, a[i] + PIECE)))
        lo, hi = a[i], int(b[i:j].max())
        up, down = powers(hi - lo + 1)
        prefix = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((text[lo:hi].astype(np.uint64) + np.uint64(1)) * up[: hi - lo], out=prefix[1:])
        out[i:j] = (prefix[b[i:j] - lo] - prefix[a[i:j] - lo]) * down[a[i:j] - lo]
        i = j
    return mix(out + seed)


def seed_of(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]


def ragged(text: np.ndarray, a: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after the other."""
    take = np.repeat(a - (np.cumsum(size) - size), size)
    take += np.arange(len(take))
    return text[take]


def unequal(text: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places where the bytes [a, a + size) are not those of [b, b + size)."""
    bad = []
    ends = np.cumsum(size)
    i = 0
    while i < len(a):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + (1 << 20))))
        s = size[i:j]
        differ = ragged(text, a[i:j], s) != ragged(text, b[i:j], s)
        if differ.any():
            bad.append(i + np.unique(np.repeat(np.arange(len(s)), s)[differ]))
        i = j
    return np.concatenate(bad) if bad else np.zeros(0, np.int64)


def entries(text: np.ndarray, a: np.ndarray, b: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(fingerprint, count, first place) of the phrases [a, b), one for each text, by fingerprint."""
    u, first, back, n = np.unique(fp, return_index=True, return_inverse=True, return_counts=True)
    rep = first[back]
    other = np.flatnonzero(rep != np.arange(len(a)))
    size = b - a
    odd = size[other] != size[rep[other]]
    wrong = [other[odd]]
    other = other[~odd]
    wrong.append(other[unequal(text, a[other], a[rep[other]], size[other])])
    wrong = np.concatenate(wrong)
    place = a[first]
    if len(wrong):  # another text under the same fingerprint: an entry of its own
        np.subtract.at(n, back[wrong], 1)
        own: dict[bytes, list[int]] = {}
        for i in np.sort(wrong).tolist():
            own.setdefault(text[a[i]: b[i]].tobytes(), [i, 0])[1] += 1
        more = np.array(list(own.values()), np.int64)
        u, n, place = np.append(u, fp[more[:, 0]]), np.append(n, more[:, 1]), np.append(place, a[more[:, 0]])
        order = np.argsort(u, kind="stable")
        u, n, place = u[order], n[order], place[order]
    return u, n, place


def slots(fp: np.ndarray) -> np.ndarray:
    return (fp >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def phrases(text: np.ndarray, lang: str, length: int, frequent: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the phrases of ``length`` words whose two parts of one word
    less are in the bitmap ``frequent``."""
    ends = np.flatnonzero((text == SPACE) | (text == BREAK))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(ends)]
    seed = seed_of(lang)

    def inside(k: int) -> np.ndarray:
        """Word places at which k words of one piece start."""
        ok = np.ones(max(len(ends) - k + 1, 0), bool)
        for j in range(k - 1):
            ok &= text[ends[j: j + len(ok)]] == SPACE
        return ok

    at = np.flatnonzero(inside(length))
    if length > 1:
        part = np.flatnonzero(inside(length - 1))
        known = np.zeros(len(ends) + 1, bool)
        slot = slots(fingerprints(text, starts[part], ends[part + length - 2], seed))
        known[part] = (frequent[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1
        at = at[known[at] & known[at + 1]]
    a, b = starts[at], ends[at + length - 1]
    return entries(text, a, b, fingerprints(text, a, b, seed))


ENTRY = "bucket int, chunk long, fps binary, ns binary, places binary"
POINTERS = "bucket int, chunk long, length int, ns binary, places binary, bits binary"


def counted(chunked: DataFrame, length: int, bucket_bits: int, sent) -> DataFrame:
    """Entries of every chunk, as blobs by bucket (the fingerprint's first bits)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value if sent is not None else None
        for batch in batches:
            for i in range(batch.num_rows):
                text = text_bytes(batch.column(2).slice(i, 1))[0]
                fp, n, place = phrases(text, batch.column(1)[i].as_py(), length, frequent)
                if len(fp):
                    some, first = np.unique((fp >> np.uint64(64 - bucket_bits)).astype(np.int32), return_index=True)
                    sizes = np.diff(np.append(first, len(fp)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some), pa.array(np.full(len(some), batch.column(0)[i].as_py(), np.int64)), blobs(fp, sizes), blobs(n.astype(np.uint32), sizes), blobs(place.astype(np.uint32), sizes)],
                        names=["bucket", "chunk", "fps", "ns", "places"],
                    )
                del text, fp, n, place
                release()
            del batch

    return chunked.select("chunk", "lang", "text").mapInArrow(run, ENTRY)


def summed(parts: DataFrame, length: int, bucket_bits: int, least: int) -> DataFrame:
    """Pointers of the fingerprints with ``least`` occurrences or more, a row
    for each bucket and chunk, and the bucket's part of the bitmap (a row
    without a chunk); written."""

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        fp, ns, places = (text_bytes(table.column(c))[0].view(kind) for c, kind in (("fps", np.uint64), ("ns", np.uint32), ("places", np.uint32)))
        sizes = np.diff(text_bytes(table.column("fps"))[1]) // 8
        u, back = np.unique(fp, return_inverse=True)
        total = np.zeros(len(u), np.int64)
        np.add.at(total, back, ns.astype(np.int64))
        often = total >= least
        keep = np.flatnonzero(often[back])
        row = np.repeat(np.arange(len(sizes)), sizes)[keep]
        some, first = np.unique(row, return_index=True)
        n = np.diff(np.append(first, len(row)))
        width = 1 << (SLOT_BITS - bucket_bits) >> 3
        bits = np.zeros(width, np.uint8)
        slot = slots(u[often]) - (bucket << (SLOT_BITS - bucket_bits))
        np.bitwise_or.at(bits, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))
        chunk = table.column("chunk").to_numpy()[some]
        none = np.zeros(len(some), np.int64)
        out = pa.table({
            "bucket": pa.array(np.append(np.full(len(some), bucket, np.int32), np.int32(bucket))), "chunk": pa.array(np.append(chunk, 0), mask=np.append(none, 1).astype(bool)),
            "length": pa.array(np.full(len(some) + 1, length, np.int32)), "ns": blobs(ns[keep], np.append(n, 0)), "places": blobs(places[keep], np.append(n, 0)), "bits": blobs(bits, np.append(none, width)),
        })
        release()
        return out

    return written(parts.groupBy("bucket").applyInArrow(run, POINTERS), "pointers")


def bitmap(pointers: DataFrame, bucket_bits: int) -> np.ndarray:
    """The bitmap of frequent fingerprints: 2**SLOT_BITS bits whatever the data are."""
    out = np.zeros((1 << bucket_bits, 1 << (SLOT_BITS - bucket_bits) >> 3), np.uint8)
    for r in pointers.where("chunk is null").select("bucket", "bits").toLocalIterator():
        out[r["bucket"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def read_phrases(chunked: DataFrame, pointers: DataFrame) -> DataFrame:
    """(lang, phrase, length, n) of every pointer, from the chunks' texts."""

    def run(chunk: pa.Table, found: pa.Table) -> pa.Table:
        if not found.num_rows:
            return pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("length", pa.int32()), ("n", pa.int64())]).empty_table()
        text = text_bytes(chunk.column("text"))[0]
        ends = np.flatnonzero((text == SPACE) | (text == BREAK))
        places, at = text_bytes(found.column("places"))
        places = places.view(np.uint32).astype(np.int64)
        n = text_bytes(found.column("ns"))[0].view(np.uint32).astype(np.int64)
        length = np.repeat(found.column("length").to_numpy(), np.diff(at) // 4)
        size = ends[np.searchsorted(ends, places) + length - 1] - places
        out = pa.table({"lang": pa.repeat(chunk.column("lang")[0], len(n)), "phrase": blobs(ragged(text, places, size), size).cast(pa.string()), "length": pa.array(length, pa.int32()), "n": pa.array(n)})
        release()
        return out

    left = chunked.select("chunk", "lang", "text").groupBy("chunk")
    return left.cogroup(pointers.where("chunk is not null").select("chunk", "length", "ns", "places").groupBy("chunk")).applyInArrow(run, "lang string, phrase string, length int, n long")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, length, f) of the phrases of up to ``longest`` words with
    ``least`` occurrences or more; and (lang, n), all words of a lang."""
    chunked = chunks(docs)
    words = chunked.groupBy("lang").agg(F.sum("words").alias("n"))
    total = words.agg(F.sum("n").alias("n")).first()["n"] or 0
    bits = min(SLOT_BITS - 3, max(BUCKET_BITS, int(np.ceil(np.log2(max(total, 1) / ENTRIES)))))
    sent, found = None, None
    for length in range(1, longest + 1):
        part = summed(counted(chunked, length, bits, sent), length, bits, least)
        found = part if found is None else found.unionAll(part)
        if length < longest:
            sent = chunked.sparkSession.sparkContext.broadcast(bitmap(part, bits))
    texts = read_phrases(chunked, found).groupBy("lang", "phrase", "length").agg(F.sum("n").alias("f"))
    return written(texts.where(F.col("f") >= least), "phrases"), words


def scored(phrases_: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, length, a, k, l, r, score) of each phrase of two words or
    more, at its cut with the lowest score (of equal ones the first)."""
    words = F.split("phrase", " ")
    some = phrases_.where("length >= 2").select("lang", "phrase", "length", F.col("f").alias("a"), words.alias("w"))
    cuts = some.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("length") - 1)))
    part = lambda a, n: F.array_join(F.slice("w", a, n), " ")
    cuts = cuts.select("lang", "phrase", "length", "a", "k", part(F.lit(1), F.col("k")).alias("first"), part(F.col("k") + 1, F.col("length") - F.col("k")).alias("rest"))
    of = lambda name, count: phrases_.select("lang", F.col("phrase").alias(name), F.col("f").alias(count))
    both = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    whole = "cast({} as decimal(15,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * {whole.format('a')} * {whole.format('a')}) div ({whole.format('l')} * {whole.format('r')})")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return both.groupBy("lang", "phrase", "length", "a").agg(lowest).select("lang", "phrase", "length", "a", "cut.k", "cut.l", "cut.r", "cut.score")


def outermost(candidates: DataFrame, longest: int = LONGEST, inside: int = INSIDE) -> DataFrame:
    """Candidates without those that mostly lie in a longer candidate."""
    w = candidates.where("length >= 3").select("lang", "length", "a", F.split("phrase", " ").alias("w"))
    spans = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(k).alias("k")) for k in range(2, longest) for i in range(1, longest - k + 2)))
    held = w.withColumn("span", F.explode(spans)).where("span.i + span.k - 1 <= length and span.k < length")
    held = held.groupBy("lang", F.array_join(F.slice("w", F.col("span.i"), F.col("span.k")), " ").alias("phrase")).agg(F.max("a").alias("longer"))
    whole = "cast({} as decimal(19,0))"
    return candidates.join(held, ["lang", "phrase"], "left").where(f"longer is null or 100 * {whole.format('longer')} < {inside} * {whole.format('a')}").drop("longer")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, inside: int = INSIDE, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each lang of
    ``docs`` (lang, text) with the highest scores."""
    found, words = frequent_phrases(docs, longest, least)
    candidates = outermost(scored(found, longest), longest, inside) if longest > 2 else scored(found, longest)
    candidates = written(candidates, "candidates")
    parts = max(64, -(-candidates.count() // SALTED))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    salted = candidates.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= most)
    best = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most)
    out = best.join(checked_broadcast(written(words, "lang-words")), "lang")
    return out.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *(F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")))
