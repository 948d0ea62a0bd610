"""Language-model scoring with Brown class-based n-grams.

The model: log10 P(text) is the sum over tokens of log10 P(class | class
before) + log10 P(word | class). Tokens are words (A-Z lower-cased, cut at
spaces, tabs and line breaks) and one end for each text; the class before
the first word is that of the end.

    P(c2 | c1)    = (n(c1, c2) + m * P(c2)) / (n(c1) + m), m = classes
    P(word | c)   = (n(word) + 0.1) / (n(c) + 0.1 * (words of c + 1))

1. Texts are read in chunks. The distinct words of a chunk go, with their
   counts, to the bucket of their hash, which sums them and answers each chunk
   with the words' places. Words get 32-bit numbers by falling count (in powers
   of two; within one by bucket) from the totals of the buckets. Texts are kept
   as numbers, with what the base score needs already added up.
2. Pairs of neighbouring tokens of the training texts are counted and shuffled
   once, to a list for each word of its neighbours before and after it, cut
   into blocks of about ``BLOCK_TOKENS`` tokens. A word with more is in several
   parts, by neighbour.
3. A sweep of exchange clustering reads these lists where they are, with one
   class byte a word sent to the tasks: each word's counts by class before and
   after it, and from these the class with the largest gain in likelihood.
   Nothing is shuffled but the counts of words in several parts; a task returns
   one byte for each of its words.

Sweeps over a coarser partition come first: the ``WORDS`` most frequent words
each for itself, all others by the hash of their last bytes (``FORMS`` of them),
of which every second unit in turn moves. From there every word of the training
texts is exchanged for itself, every second one in a sweep, where a class other
than the one it started from costs ``LEAVE``: the few places of a rare word could
else be fitted by chance, which held-out texts pay for. As many words move at
once, the likelihood is counted anew after each sweep: a sweep that lowers it
(less what was paid) is dropped, and sweeps end when two of them together gain
less than ``SETTLED``. Words that the training texts do not have take the class
that most words of their form (last bytes) have.

The driver holds three bytes a word (class and form), and sends one of them to
the tasks in a sweep; more than ``MOST_WORDS`` words are an error.

Held out from learning are rows whose crc32(doc_id as text) mod 10 is 0.

Defined cases: null and empty texts are one end token; a null doc_id is held
out; repeated rows count as often as they are there; without training rows all
words are unknown and every class has the same share.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm import words as W
from quarry.llm.tables import ROW_GROUPS, blobs, dropped_table, release, text_blocks, written

CLASSES = 32
WORDS, FORMS = 3071, 1024
UNITS = 1 + WORDS + FORMS  # unit 0 is the end
SWEEPS = 8
BLOCK_UNITS = 256
FAN = 64  # partial count tables summed in one task
ADD = 0.1
CHUNK = 4 << 20  # bytes of text
BUCKET_BITS, ENTRIES = 8, 1 << 20  # buckets of word hashes: at least, and words of text for one
POWERS = 48  # of two, of a word's count
BLOCK_TOKENS = 1 << 19
PAIRS = 3 << 19  # distinct pairs of neighbours counted before they are sent
SLICE = 1 << 14  # words clustered at once
MOST_WORDS = 1 << 30
SETTLED = 1e-3  # gain of two sweeps, of the likelihood, under which they end
LEAVE = float(np.log(9 * (CLASSES - 2)))  # nats: one word in ten leaves its first class, for any other
SELF = 2 * CLASSES  # a word's slot after those of classes before and after: follows itself
SLOTS = SELF + 1


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 10 == 0, F.lit(True))


def forms(raw: np.ndarray, words: W.Words, which: np.ndarray) -> np.ndarray:
    """Form (hash of the last three bytes) of the words at the places ``which``."""
    end, start = words.end[which], words.start[which]
    h = np.zeros(len(which), np.uint64)
    for k in (1, 2, 3):
        byte = W.LOWER[raw[np.maximum(end - k, start)]].astype(np.uint64)
        h = W.mix(h * np.uint64(257) + np.where(end - k >= start, byte, np.uint64(0)))
    return (h % np.uint64(FORMS)).astype(np.int64)


def pressed(values: np.ndarray) -> bytes:
    """Little-endian values behind their number of bytes, compressed."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpressed(cell, kind) -> np.ndarray:
    raw = memoryview(cell.as_buffer() if isinstance(cell, pa.Scalar) else cell)
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(pa.py_buffer(raw[8:]), decompressed_size=size, codec="zstd") if size else b"", kind)


def cells(batch: pa.RecordBatch | pa.Table, i: int, **kinds) -> dict[str, np.ndarray]:
    """Pressed columns of row i, by name and kind."""
    return {c: unpressed(batch.column(c)[i], kind) for c, kind in kinds.items()}


def record(schema: str, *rows: tuple) -> pa.RecordBatch:
    """Rows in the order of ``schema`` ("name kind, ..."); arrays are pressed."""
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = [pa.array([pressed(v) if isinstance(v, np.ndarray) else v for v in column], types[k]) for column, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=list(names))


LOCAL = "chunk long, ids binary, known binary, held binary, sizes binary, codes binary, hashes binary, counts binary, forms binary"


def _local(most: int):
    """Chunks with their own word numbers (1 + place among the chunk's hashes; 0: an end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            if not batch.num_rows:
                continue
            for rows, raw, at in text_blocks(batch, most=most):
                w = W.scan(raw, at)
                u, first, back = np.unique(w.hash, return_index=True, return_inverse=True)
                some = slice(rows.start, rows.stop)
                ids = batch.column(0).slice(some.start, some.stop - some.start)
                held = batch.column(1).slice(some.start, some.stop - some.start).to_numpy(zero_copy_only=False)
                counts = np.bincount(back[~np.repeat(held, w.counts())], minlength=len(u)).astype(np.uint32)
                codes = np.insert((back + 1).astype(np.uint32), w.first[1:], 0)
                yield record(LOCAL, (
                    number, ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), ids.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8),
                    held.astype(np.uint8), (w.counts() + 1).astype(np.uint32), codes, u, counts, forms(raw, w, first).astype(np.uint16),
                ))
                number += 1
                del w, u, first, back, counts, codes, raw, at
                release()
            del batch
            release()

    return run


ASKED = "bucket int, chunk long, hashes binary, counts binary, forms binary"
ANSWERS = "bucket int, chunk long, powers binary, places binary, counts binary, forms binary"


def _asked(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                h, n, f = cells(batch, i, hashes=np.uint64, counts=np.uint32, forms=np.uint16).values()
                if len(h):
                    edges = np.searchsorted(h >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
                    chunk = batch.column("chunk")[i].as_py()
                    yield record(ASKED, *((b, chunk, h[x:y], n[x:y], f[x:y]) for b, (x, y) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)) if y > x))
            del batch
            release()

    return run


def power_of(n: np.ndarray) -> np.ndarray:
    """floor(log2(n)) of whole numbers from 1."""
    out = np.zeros(len(n), np.uint8)
    for k in range(1, POWERS):
        out += n >= (1 << k)
    return out


def _answered(table: pa.Table) -> pa.Table:
    """Sums of a bucket's words; to each chunk the power of two and the place
    within it of what it asked for (power 255: no training text has it)."""
    bucket, rows = table.column("bucket")[0].as_py(), [cells(table, i, hashes=np.uint64, counts=np.uint32, forms=np.uint16) for i in range(table.num_rows)]
    h, counts, form = (np.concatenate([r[c] for r in rows]) for c in ("hashes", "counts", "forms"))
    u, first, back = np.unique(h, return_index=True, return_inverse=True)
    n = np.zeros(len(u), np.int64)
    np.add.at(n, back, counts.astype(np.int64))
    power = np.where(n > 0, power_of(n), 255).astype(np.uint8)
    order = np.lexsort((u, -n, np.where(n > 0, -power.astype(np.int64), 1)))[: int((n > 0).sum())]
    starts = np.searchsorted(-power[order].astype(np.int64), -power[order].astype(np.int64))
    place = np.zeros(len(u), np.uint32)
    place[order] = np.arange(len(order)) - starts
    none, out, a = np.zeros(0, np.uint16), [], 0
    for i, r in enumerate(rows):
        at = back[a: a + len(r["hashes"])]
        a += len(at)
        out.append((bucket, table.column("chunk")[i].as_py(), power[at], place[at], n[at], none))
    out.append((bucket, None, power[order], place[order], n[order], form[first][order]))
    release()
    return pa.Table.from_batches([record(ANSWERS, *out)])


class Numbers(NamedTuple):
    """``start[power, bucket]``: the number of the first such word (0 is the
    end); ``edges``: where blocks of words start; ``parts`` of each block."""

    start: np.ndarray
    edges: np.ndarray
    parts: np.ndarray
    words: int
    tokens: int


def numbered(answers: DataFrame, bits: int) -> tuple[Numbers, np.ndarray]:
    """The numbering from the buckets' totals, and the form of each word."""
    totals = np.zeros((2, POWERS, 1 << bits), np.int64)
    words = answers.where("chunk is null").select("bucket", "powers", "counts", "forms")
    for r in words.toLocalIterator(prefetchPartitions=False):
        power, n = unpressed(r["powers"], np.uint8), unpressed(r["counts"], np.int64)
        totals[0, :, r["bucket"]] = np.bincount(power, minlength=POWERS)
        np.add.at(totals[1, :, r["bucket"]], power, n)
    size, tokens = (t[::-1].ravel() for t in totals)  # by falling power
    starts = 1 + np.cumsum(size) - size
    total = int(size.sum())
    if total > MOST_WORDS:
        raise ValueError(f"{total} distinct words; at most {MOST_WORDS} are clustered")
    start = starts.reshape(POWERS, -1)[::-1].copy()
    form = np.zeros(1 + total, np.uint16)
    for r in words.toLocalIterator(prefetchPartitions=False):
        power, f, a = unpressed(r["powers"], np.uint8), unpressed(r["forms"], np.uint16), 0
        for p in np.unique(power)[::-1]:
            n = int((power == p).sum())
            form[start[p, r["bucket"]]: start[p, r["bucket"]] + n] = f[a: a + n]
            a += n
    edges, parts, held = [0], [1], 0
    for a, n, t in zip(starts.tolist(), size.tolist(), tokens.tolist(), strict=True):
        if not n:
            continue
        pieces = min(n, max(1, -(-t // BLOCK_TOKENS)))
        if held + t > BLOCK_TOKENS or pieces > 1:
            edges += [a + n * k // pieces for k in range(pieces)]
            parts += [max(1, t // pieces // BLOCK_TOKENS)] * pieces
            held = t // pieces
        else:
            held += t
    return Numbers(start, np.array(edges), np.array(parts), total, int(tokens.sum())), form


SEQUENCES = "chunk long, ids binary, known binary, held binary, sizes binary, codes binary, base binary, known_tokens binary"


def sequences(local: DataFrame, answers: DataFrame, numbers: Numbers, ends: int) -> DataFrame:
    """Chunks with the words' numbers (0: an end; -1 - form: a word that no
    training text has), and each text's base score and known tokens."""
    sent = local.sparkSession.sparkContext.broadcast(numbers.start)
    every = numbers.tokens + ends + ADD * (numbers.words + (ends > 0) + 1)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        row = cells(left, 0, ids=np.int64, known=np.uint8, held=np.uint8, sizes=np.uint32, codes=np.uint32, forms=np.uint16)
        number, n = [], []
        for i in np.argsort(right.column("bucket").to_numpy()) if right.num_rows else ():
            power, place, count = cells(right, int(i), powers=np.uint8, places=np.uint32, counts=np.int64).values()
            start = sent.value[:, right.column("bucket")[int(i)].as_py()]
            number.append(np.where(power < 255, start[np.minimum(power, POWERS - 1)] + place, 0))
            n.append(count)
        n = np.concatenate([[ends], *n])
        number = np.concatenate([[0], *number]).astype(np.int64)
        number[1:] = np.where(n[1:] > 0, number[1:], -1 - row["forms"].astype(np.int64))
        first = np.cumsum(row["sizes"], dtype=np.int64) - row["sizes"]
        codes = row["codes"]
        base = np.add.reduceat(np.log10((n + ADD) / every)[codes], first)
        known = np.add.reduceat((n > 0)[codes].astype(np.int64), first)
        out = record(SEQUENCES, (left.column("chunk")[0].as_py(), row["ids"], row["known"], row["held"], row["sizes"], number[codes].astype(np.int32), base, known))
        release()
        return pa.Table.from_batches([out])

    chunks = local.select("chunk", "ids", "known", "held", "sizes", "codes", "forms").groupBy("chunk")
    asked = answers.where("chunk is not null").select("chunk", "bucket", "powers", "places", "counts").groupBy("chunk")
    return written(chunks.cogroup(asked).applyInArrow(run, SEQUENCES), "sequences", ROW_GROUPS)


SENT = "block int, part int, after int, owners binary, others binary, counts binary"
LISTS = "block int, part int, owners binary, others binary, counts binary, after_owners binary, after_others binary, after_counts binary"


def _sums(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))[: len(key)]
    return key[first], np.add.reduceat(n, first) if len(first) else n


def neighbours(seqs: DataFrame, numbers: Numbers) -> DataFrame:
    """For each block of words (and part of it) the neighbours before and after
    its words in the training texts, with counts; sorted by word."""
    sent = seqs.sparkSession.sparkContext.broadcast((numbers.edges, numbers.parts))

    def deal(keys: list, counts: list) -> Iterator[pa.RecordBatch]:
        edges, parts = sent.value
        pair, n = _sums(keys, counts)
        v, w = pair >> np.uint64(32), pair & np.uint64(0xFFFFFFFF)
        by_w = np.argsort(w, kind="stable")
        keep = v > 0  # the end has a class of its own and is not exchanged
        for after, owner, other, m in ((0, w[by_w], v[by_w], n[by_w]), (1, v[keep], w[keep], n[keep])):
            block = np.searchsorted(edges, owner.astype(np.int64), side="right") - 1
            part = (W.mix(other) % parts[block].astype(np.uint64)).astype(np.int64)
            if part.any():
                order = np.lexsort((np.arange(len(block)), part, block))
                block, part, owner, other, m = block[order], part[order], owner[order], other[order], m[order]
            first = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (part[1:] != part[:-1])]))[: len(block)]
            for a in range(0, len(first), 256):
                ends = [*first[a + 1: a + 257].tolist(), *([len(block)] if a + 257 > len(first) else [])]
                yield record(SENT, *((int(block[x]), int(part[x]), after, owner[x:y].astype(np.uint32), other[x:y].astype(np.uint32), m[x:y].astype(np.uint32)) for x, y in zip(first[a: a + 256].tolist(), ends, strict=False)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, size = [], [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                row = cells(batch, i, held=np.uint8, sizes=np.uint32, codes=np.int32)
                w = row["codes"][np.repeat(row["held"] == 0, row["sizes"])].astype(np.uint64)
                if len(w):
                    v = np.concatenate([[np.uint64(0)], w[:-1]])  # a text follows an end
                    key, n = np.unique((v << np.uint64(32)) | w, return_counts=True)
                    keys.append(key)
                    counts.append(n)
                    size += len(key)
                if size >= PAIRS:
                    yield from deal(keys, counts)
                    keys, counts, size = [], [], 0
                    release()
            del batch
        if size:
            yield from deal(keys, counts)
        release()

    def merge(table: pa.Table) -> pa.Table:
        out = []
        for after in (0, 1):
            keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i in np.flatnonzero(table.column("after").to_numpy() == after):
                owner, other, n = cells(table, int(i), owners=np.uint32, others=np.uint32, counts=np.uint32).values()
                keys.append((owner.astype(np.uint64) << np.uint64(32)) | other)
                counts.append(n.astype(np.int64))
            key, n = _sums(keys, counts)
            out += [(key >> np.uint64(32)).astype(np.uint32), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32), n]
        release()
        return pa.Table.from_batches([record(LISTS, (table.column("block")[0].as_py(), table.column("part")[0].as_py(), *out))])

    pairs = seqs.select("held", "sizes", "codes").mapInArrow(run, SENT)
    return written(pairs.groupBy("block", "part").applyInArrow(merge, LISTS), "neighbours", ROW_GROUPS)


def _lists(batch: pa.RecordBatch | pa.Table, i: int) -> tuple[tuple[np.ndarray, ...], tuple[np.ndarray, ...]]:
    """(owners, others, counts) before and after the owners."""
    both = cells(batch, i, owners=np.uint32, others=np.uint32, counts=np.int64, after_owners=np.uint32, after_others=np.uint32, after_counts=np.int64)
    values = list(both.values())
    return tuple(values[:3]), tuple(values[3:])


def context_counts(lists: DataFrame, unit_of: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """For each unit: how often it follows each class, precedes each class,
    and follows itself. Summed over all blocks in rounds of FAN tables."""
    k = CLASSES
    sent = lists.sparkSession.sparkContext.broadcast((unit_of, classes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, cls = sent.value
        total, some = np.zeros((UNITS, SLOTS), np.int64), False
        for batch in batches:
            for i in range(batch.num_rows):
                some = True
                owner, other, n = _lists(batch, i)[0]  # each pair is in the list of its second word
                u, p = unit[owner].astype(np.int64), unit[other].astype(np.int64)
                total[:, :k] += np.bincount(u * k + cls[p], n, UNITS * k).astype(np.int64).reshape(UNITS, k)
                total[:, k: 2 * k] += np.bincount(p * k + cls[u], n, UNITS * k).astype(np.int64).reshape(UNITS, k)
                total[:, SELF] += np.bincount(u[u == p], n[u == p], UNITS).astype(np.int64)
            del batch
        release()
        if some:
            part = TaskContext.get().partitionId()
            for b in range(0, UNITS, BLOCK_UNITS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b // BLOCK_UNITS]), pa.array([part]), pa.array([total[b: b + BLOCK_UNITS].tobytes()], pa.binary())], names=["block", "part", "counts"]
                )

    def add(table: pa.Table) -> pa.Table:
        total = np.sum([np.frombuffer(x.as_buffer(), np.int64) for x in table.column("counts")], axis=0)
        return pa.table({"block": table.column("block")[:1], "part": pa.array([table.column("part")[0].as_py() // FAN]), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "block long, part long, counts binary"
    parts, left = lists.mapInArrow(count, schema), lists.rdd.getNumPartitions()
    while left > 1:
        parts = parts.groupBy("block", F.floor(F.col("part") / FAN)).applyInArrow(add, schema)
        left = -(-left // FAN)
    out = np.zeros((UNITS, SLOTS), np.int64)
    for r in parts.collect():  # a table of fixed size
        b = r["block"] * BLOCK_UNITS
        out[b: b + BLOCK_UNITS] += np.frombuffer(r["counts"], np.int64).reshape(-1, SLOTS)
    sent.destroy()
    return out


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0).astype(np.float64)
    return x * np.log(np.maximum(x, 1))


def class_pairs(counts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """n(class before, class) from the units' successor counts."""
    pairs = np.zeros((CLASSES, CLASSES), np.int64)
    np.add.at(pairs, classes, counts[:, CLASSES: 2 * CLASSES])
    return pairs


def exchange(counts: np.ndarray, classes: np.ndarray, active: np.ndarray) -> tuple[np.ndarray, int]:
    """Moves each active unit, in turn, to the class with the largest gain in
    likelihood; returns the classes and the number of moves."""
    classes = classes.copy()
    g = class_pairs(counts, classes).astype(np.float64)
    before, after, own = counts[:, :CLASSES], counts[:, CLASSES: 2 * CLASSES], counts[:, 2 * CLASSES]
    moves = 0
    for u in active:
        a, s = classes[u], float(own[u])
        into, out = before[u].astype(np.float64), after[u].astype(np.float64)
        into[a] -= s
        out[a] -= s
        if into.sum() + out.sum() + s <= 0:
            continue
        g2 = g.copy()
        g2[a] -= out
        g2[:, a] -= into
        g2[a, a] -= s
        f2 = _xlogx(g2)
        diag = np.arange(CLASSES)
        row = _xlogx(g2 + out[None, :]) - f2
        col = _xlogx(g2 + into[:, None]) - f2
        gain = row.sum(axis=1) - row[diag, diag] + col.sum(axis=0) - col[diag, diag]
        gain += _xlogx(g2[diag, diag] + into + out + s) - f2[diag, diag]
        r, c = np.maximum(g2.sum(axis=1), 0), np.maximum(g2.sum(axis=0), 0)
        gain -= _xlogx(r + out.sum() + s) - _xlogx(r) + _xlogx(c + into.sum() + s) - _xlogx(c)
        gain[0] = -np.inf  # the end keeps a class of its own
        b = int(np.argmax(gain))
        if b != a and gain[b] > gain[a] + 1e-9:
            g = g2
            g[b] += out
            g[:, b] += into
            g[b, b] += s
            classes[u] = b
            moves += 1
    return classes, moves


def cluster_units(lists: DataFrame, unit_of: np.ndarray, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit, from which the words start."""
    classes = np.concatenate([[0], 1 + np.arange(UNITS - 1) % (CLASSES - 1)]).astype(np.int64)
    counts = context_counts(lists, unit_of, classes)
    for k in range(sweeps):
        total = counts[:, :CLASSES].sum(axis=1)
        units = np.arange(1, UNITS)
        units = units[(units % 2 == k % 2) & (total[1:] > 0)]
        classes, moves = exchange(counts, classes, units[np.argsort(-total[units], kind="stable")])
        if k + 1 < sweeps and (moves or k == 0):
            counts = context_counts(lists, unit_of, classes)
    return classes


def class_table(lists: DataFrame, classes: np.ndarray) -> np.ndarray:
    """n(class before, class)."""
    sent = lists.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                owner, other, n = cells(batch, i, owners=np.uint32, others=np.uint32, counts=np.int64).values()
                total += np.bincount(sent.value[other].astype(np.int64) * CLASSES + sent.value[owner], n, len(total)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total > 0])], names=["pair", "n"])
        release()

    out = np.zeros(CLASSES * CLASSES, np.int64)
    for r in lists.select("owners", "others", "counts").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).collect():
        out[r["pair"]] = r["n"]
    sent.destroy()
    return out.reshape(CLASSES, CLASSES)


def likelihood(g: np.ndarray) -> float:
    return float(_xlogx(g).sum() - _xlogx(g.sum(axis=1)).sum() - _xlogx(g.sum(axis=0)).sum())


def best_classes(g: np.ndarray, cls: np.ndarray, word: np.ndarray, slot: np.ndarray, n: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
    """For each word the class with the largest likelihood if that word alone
    moved; with ``start``, any other class than that costs LEAVE. ``word``,
    ``slot``, ``n``: its contexts, with words in order."""
    dense = np.zeros((len(cls), SLOTS))
    dense[word, slot] = n
    return _best(g, cls, dense, start)


def _best(g: np.ndarray, cls: np.ndarray, dense: np.ndarray, start: np.ndarray | None) -> np.ndarray:
    k, size = CLASSES, len(cls)
    g = g.astype(np.float64)
    at = np.arange(size)
    into, out, s = dense[:, :k], dense[:, k: 2 * k], dense[:, 2 * k]
    into[at, cls] -= s
    out[at, cls] -= s
    gain = np.zeros((size, k))
    for table, mine, other in ((g, out, into), (g.T, into, out)):  # rows of the class table, then its columns
        i, c = np.nonzero(mine)
        o, a = mine[i, c], cls[i]
        rest = table.T[c]  # without the word: count of each class b with c
        rest -= np.where((c == a)[:, None], other[i], 0.0)
        e = np.arange(len(i))
        rest[e, a] -= o + np.where(c == a, s[i], 0.0)
        part = _xlogx(rest + o[:, None]) - _xlogx(rest)
        part[e, c] = 0.0  # the diagonal comes below
        some, first = np.unique(i, return_index=True)
        if len(some):
            gain[some] += np.add.reduceat(part, first)
        total = np.repeat(table.sum(axis=1)[None, :], size, axis=0)
        tokens = mine.sum(axis=1) + s
        total[at, cls] -= tokens
        gain -= _xlogx(total + tokens[:, None]) - _xlogx(total)
    diag = np.repeat(np.diag(g)[None, :], size, axis=0)
    diag[at, cls] -= into[at, cls] + out[at, cls] + s
    gain += _xlogx(diag + into + out + s[:, None]) - _xlogx(diag)
    if start is not None:
        gain[at, start] += LEAVE
    gain[:, 0] = -np.inf  # the end keeps a class of its own
    best = gain.argmax(axis=1)
    return np.where((cls > 0) & (gain[at, best] > gain[at, cls] + 1e-9), best, cls)


def _contexts(lists: tuple, classes: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Counts by slot of the words lo .. hi - 1, from their neighbours."""
    (owner, other, n), (after, behind, m) = lists
    x, y = np.searchsorted(owner, [lo, hi])
    s, t = np.searchsorted(after, [lo, hi])
    word = owner[x:y].astype(np.int64) - lo
    out = np.bincount(word * SLOTS + classes[other[x:y]], n[x:y], (hi - lo) * SLOTS)
    out += np.bincount((after[s:t].astype(np.int64) - lo) * SLOTS + CLASSES + classes[behind[s:t]], m[s:t], (hi - lo) * SLOTS)
    same = owner[x:y] == other[x:y]
    out += np.bincount(word[same] * SLOTS + SELF, n[x:y][same], (hi - lo) * SLOTS)
    return out.reshape(hi - lo, SLOTS)


def _moved(dense: np.ndarray, classes: np.ndarray, start: np.ndarray, lo: int, g: np.ndarray, turn: int) -> np.ndarray:
    """Classes of the words from ``lo`` on after a sweep over those whose turn
    it is. Words with the same counts, class and start are worked out once."""
    cls = classes[lo: lo + len(dense)].astype(np.int64)
    at = np.flatnonzero((W.mix(np.arange(lo, lo + len(dense)).astype(np.uint64)) % np.uint64(2) == turn % 2) & (cls > 0))
    first_class = start[lo: lo + len(dense)][at].astype(np.int64)
    weights = W.mix(np.arange(1, SLOTS + 3, dtype=np.uint64))
    with np.errstate(over="ignore"):
        key = W.mix((dense[at].astype(np.uint64) * weights[:SLOTS]).sum(axis=1, dtype=np.uint64) + cls[at].astype(np.uint64) * weights[SLOTS] + first_class.astype(np.uint64) * weights[SLOTS + 1])
    _, one, back = np.unique(key, return_index=True, return_inverse=True)
    out = cls.copy()
    if len(at):
        out[at] = _best(g, cls[at][one], dense[at[one]], first_class[one])[back]
    return out.astype(np.uint8)


def sweep(lists: DataFrame, numbers: Numbers, classes: np.ndarray, start: np.ndarray, g: np.ndarray, turn: int) -> np.ndarray:
    """Every word's class after a sweep."""
    sent = lists.sparkSession.sparkContext.broadcast((classes, start, g, np.append(numbers.edges, len(classes))))
    schema = "block int, classes binary"

    def slices(block: int) -> Iterator[tuple[int, int]]:
        edges = sent.value[3]
        for lo in range(int(edges[block]), int(edges[block + 1]), SLICE):
            yield lo, min(lo + SLICE, int(edges[block + 1]))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, first, table, _ = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                own, block = _lists(batch, i), batch.column("block")[i].as_py()
                yield record(schema, (block, np.concatenate([_moved(_contexts(own, cls, lo, hi), cls, first, lo, table, turn) for lo, hi in slices(block)])))
                release()

    def partly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                own, block = _lists(batch, i), batch.column("block")[i].as_py()
                for lo, hi in slices(block):
                    yield record("block int, lo long, counts binary", (block, lo, _contexts(own, sent.value[0], lo, hi).astype(np.int64)))
                release()

    def added(table: pa.Table) -> pa.Table:
        cls, first, g_, _ = sent.value
        total, out = {}, []
        for i in range(table.num_rows):
            lo, n = table.column("lo")[i].as_py(), unpressed(table.column("counts")[i], np.int64).reshape(-1, SLOTS)
            total[lo] = total[lo] + n if lo in total else n
        out = [_moved(n.astype(np.float64), cls, first, lo, g_, turn) for lo, n in sorted(total.items())]
        return pa.Table.from_batches([record(schema, (table.column("block")[0].as_py(), np.concatenate(out)))])

    many = [int(b) for b in np.flatnonzero(numbers.parts > 1)]  # a block for each word that is in several parts
    one = lists.where(~F.col("block").isin(many)) if many else lists
    new = one.mapInArrow(whole, schema)
    if many:
        new = new.unionAll(lists.where(F.col("block").isin(many)).mapInArrow(partly, "block int, lo long, counts binary").groupBy("block").applyInArrow(added, schema))
    out = classes.copy()
    for r in new.toLocalIterator(prefetchPartitions=True):
        got = unpressed(r["classes"], np.uint8)
        out[numbers.edges[r["block"]]: numbers.edges[r["block"]] + len(got)] = got
    sent.destroy()
    return out


def cluster(lists: DataFrame, numbers: Numbers, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(class of each word by number, n(class before, class))."""
    place = np.arange(len(form))
    unit_of = np.where(place <= WORDS, place, 1 + WORDS + form.astype(np.int64)).astype(np.uint16)
    start = cluster_units(lists, unit_of)[unit_of].astype(np.uint8)
    classes, g = start, class_table(lists, start)
    now, gained, turn = likelihood(g), [np.inf], 0
    while g.any():
        new = sweep(lists, numbers, classes, start, g, turn)
        new_g = class_table(lists, new)
        value = likelihood(new_g) - LEAVE * int((new != start).sum())
        gained.append((value - now) / abs(now))
        if gained[-1] > 0:
            classes, g, now = new, new_g, value
        if gained[-1] <= 0 and gained[-2] <= 0 or max(gained[-1], 0) + max(gained[-2], 0) < SETTLED:
            break
        turn += 1
    return classes, g


def form_classes(form: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Class of an unseen word of each form: that of most training words of the
    form; without any, of most training words."""
    kinds = np.bincount(form[1:].astype(np.int64) * CLASSES + classes[1:], minlength=FORMS * CLASSES).reshape(FORMS, CLASSES)
    every = kinds.sum(axis=0)
    every[0] = -1
    return np.where(kinds.any(axis=1), kinds.argmax(axis=1), every.argmax())


class Model(NamedTuple):
    """Texts as numbers, and what the corpus has taught."""

    seqs: DataFrame
    answers: DataFrame
    numbers: Numbers
    train_tokens: int
    every: float  # denominator of the base score
    classes: np.ndarray  # of each word by number
    by_form: np.ndarray  # of an unseen word
    table: np.ndarray  # log10 of P(class | class before) over the class's emission denominator


def learn(docs: DataFrame) -> Model:
    """The model of the training rows of ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", held_out().alias("held"), "text")
    local = written(rows.mapInArrow(_local(CHUNK), LOCAL), "chunks", ROW_GROUPS)
    ends, tokens = 0, 0
    for r in local.select("held", "sizes").mapInArrow(_sizes, "ends long, tokens long").groupBy().agg(F.sum("ends").alias("ends"), F.sum("tokens").alias("tokens")).collect():
        ends, tokens = int(r["ends"] or 0), int(r["tokens"] or 0)
    bits = min(16, max(BUCKET_BITS, int(np.ceil(np.log2(max(tokens, 1) / ENTRIES)))))
    asked = local.select("chunk", "hashes", "counts", "forms").mapInArrow(_asked(bits), ASKED)
    answers = written(asked.groupBy("bucket").applyInArrow(_answered, ANSWERS), "answers")
    numbers, form = numbered(answers, bits)
    seqs = sequences(local, answers, numbers, ends)
    dropped_table(local)
    lists = neighbours(seqs, numbers)
    classes, pairs = cluster(lists, numbers, form)
    dropped_table(lists)
    kinds = np.bincount(classes, minlength=CLASSES)  # the end is in it
    totals = pairs.sum(axis=0)
    share = (totals + 1) / (totals.sum() + CLASSES)
    step = np.log10((pairs + CLASSES * share[None, :]) / (pairs.sum(axis=1, keepdims=True) + CLASSES))
    norm = np.log10(totals + ADD * (kinds + 1))
    every = numbers.tokens + ends + ADD * (numbers.words + (ends > 0) + 1)
    return Model(seqs, answers, numbers, numbers.tokens + ends, every, classes, form_classes(form, classes), step - norm[None, :])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ends = tokens = 0
    for batch in batches:
        for i in range(batch.num_rows):
            held, sizes = cells(batch, i, held=np.uint8, sizes=np.uint32).values()
            ends, tokens = ends + int((held == 0).sum()), tokens + int(sizes.sum(dtype=np.int64))
    yield pa.RecordBatch.from_arrays([pa.array([ends]), pa.array([tokens])], names=["ends", "tokens"])


def lm_scores(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    perplexity) for each row of ``docs`` (doc_id, text)."""
    model = learn(docs)
    # beside the base score's log10((n + 0.1) / every)
    sent = docs.sparkSession.sparkContext.broadcast((model.classes, model.by_form.astype(np.uint8), model.table + np.log10(model.every)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, by_form, table = sent.value
        for batch in batches:
            for i in range(batch.num_rows):
                row = cells(batch, i, ids=np.int64, known=np.uint8, held=np.uint8, sizes=np.uint32, codes=np.int32, base=np.float64, known_tokens=np.int64)
                codes = row["codes"]
                cls = np.where(codes >= 0, classes[np.maximum(codes, 0)], by_form[np.maximum(-1 - codes, 0)])
                logs = table[np.concatenate([[0], cls[:-1]]), cls]
                total = np.add.reduceat(logs, np.cumsum(row["sizes"], dtype=np.int64) - row["sizes"]) + row["base"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["ids"], mask=row["known"] == 0), pa.array(row["held"] == 1), pa.array(row["sizes"].astype(np.int64)), pa.array(row["known_tokens"]), pa.array(row["base"]), pa.array(total)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
                )
                release()
            del batch

    scored = model.seqs.mapInArrow(score, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.train_tokens).cast("long").alias("train_tokens"), "base_score", "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
