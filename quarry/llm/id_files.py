"""Token-id files: a concatenated id array with Elias-Fano document ends.

A file holds one shard of documents in doc_id order:

    magic "QIDS", then six little-endian 64-bit numbers: documents, ids,
    bytes per id, low bits, upper bytes, null doc_ids
    doc_ids   int64 each (null ones first)
    low       the low bits of every document end, packed
    upper     bitmap: bit (end >> low bits) + i is set for document i
    ids       the ids of all documents, one after another
    trailer   "\\nEND\\n"

Document i's ids end at select(i): the position of the i-th set bit of the
upper bitmap gives the high part, the packed low bits the rest. That takes
about 2 + log2(ids / documents) bits a document instead of 64. When a file is
read, the position of every 512th set bit is noted in 32 bits; a select reads
the bitmap from there to the next one noted.

Files are written by Spark's own text writer (a row is a shard, the line
separator is the trailer) below the shared folder, under ``shard=`` and
``n_ids=`` folders; so the numbers of ids of all shards, and from them the
global offsets, come from a listing alone. Task retries go through the
usual commit protocol.

Encoding: ``word_bpe`` drops white space, lower-cases, and cuts a text into
runs of letters, single digits and runs of other signs before it merges;
none of these cross a border between such units. So each distinct unit is
encoded once, by the tokenizers library, and texts are put together from
the results. Where the cut is not plain to see from the bytes (apostrophes,
special-token brackets, control bytes, non-Latin-1 characters) the whole
run between white space is the unit.

Defined cases: null and empty texts have only the end id; a null doc_id
comes before all others; rows that share a doc_id are ordered by a hash of
their text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.memo import Memo
from quarry.llm.tables import arrow_map, binary_files, checked_broadcast, release, scratch, text_blocks
from quarry.llm.words import LOWER, NOT_SPACE, Words, units
from quarry.operators.joins import estimated_bytes

END_ID = 2
SHARD_BYTES = 8 << 20  # of the stored table, a shard
MAGIC, TRAILER = b"QIDS", "\nEND\n"
STEP = 512  # of this many set bits one has its position noted
CHUNK = 4096  # bytes of a bitmap looked through at once for them


class EliasFano:
    """Non-decreasing numbers in about 2 + log2(largest / count) bits each."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, upper: np.ndarray):
        self.n, self.low_bits, self.low, self.upper = n, low_bits, low, upper
        if 8 * len(upper) > 1 << 32:
            raise ValueError("a bitmap of more than 2**32 bits: write smaller files")
        self._noted = np.empty(-(-n // STEP), np.uint32)  # positions of set bits 0, STEP, 2 * STEP ...
        seen = 0
        for at in range(0, len(upper), CHUNK):
            ones = self._ones(at, at + CHUNK)
            first = -(-seen // STEP)
            noted = ones[first * STEP - seen:: STEP]
            self._noted[first: first + len(noted)] = noted
            seen += len(ones)

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.int64)
        n = len(values)
        most = int(values[-1]) if n else 0
        low_bits = max(0, (most // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits)) & 1
        upper = np.zeros((most >> low_bits) + n + 1, np.uint8)
        upper[(values >> low_bits) + np.arange(n)] = 1
        return cls(n, low_bits, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little"), np.packbits(upper, bitorder="little"))

    def _ones(self, a: int, b: int) -> np.ndarray:
        """Positions of the set bits in the bytes a .. b of the bitmap."""
        return np.flatnonzero(np.unpackbits(self.upper[a:b], bitorder="little")) + 8 * a

    def select(self, i: np.ndarray) -> np.ndarray:
        """The numbers at the places i."""
        i = np.asarray(i, np.int64)
        high = np.empty(len(i), np.int64)
        order = np.argsort(i // STEP, kind="stable")
        steps, first = np.unique(i[order] // STEP, return_index=True)
        for step, asked in zip(steps.tolist(), np.split(order, first[1:]), strict=False):
            start = int(self._noted[step])
            last = step + 1 == len(self._noted)
            ones = self._ones(start >> 3, len(self.upper) if last else (int(self._noted[step + 1]) >> 3) + 1)
            high[asked] = ones[np.searchsorted(ones, start) + i[asked] - step * STEP] - i[asked]
        at = i[:, None] * self.low_bits + np.arange(self.low_bits)
        low = ((self.low[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(np.int64) if self.low_bits else np.zeros((len(i), 0), np.int64)
        return (high << self.low_bits) + (low << np.arange(self.low_bits)).sum(axis=1)


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    """One file's bytes, without the trailer."""
    ef = EliasFano.of(np.cumsum(counts))
    nulls = sum(d is None for d in doc_ids)
    head = np.array([len(doc_ids), len(ids), ids.itemsize, ef.low_bits, len(ef.upper), nulls], "<i8")
    names = np.array([0 if d is None else d for d in doc_ids], "<i8")
    return b"".join([MAGIC, head.tobytes(), names.tobytes(), ef.low.tobytes(), ef.upper.tobytes(), ids.astype(ids.dtype.newbyteorder("<")).tobytes()])


class IdFile:
    """A file read back: ``doc(i)`` is the ids of its i-th document."""

    def __init__(self, data: memoryview):
        if bytes(data[:4]) != MAGIC:
            raise ValueError("not an id file")
        n, n_ids, width, low_bits, upper, nulls = np.frombuffer(data, "<i8", 6, 4).tolist()
        at = 4 + 48
        names = np.frombuffer(data, "<i8", n, at).tolist()
        self.doc_ids = [None] * nulls + names[nulls:]
        at += 8 * n
        low = (n * low_bits + 7) // 8
        self.ends = EliasFano(n, low_bits, np.frombuffer(data, np.uint8, low, at), np.frombuffer(data, np.uint8, upper, at + low))
        self.ids = np.frombuffer(data, f"<u{width}", n_ids, at + low + upper)

    def doc(self, i: int) -> np.ndarray:
        a, b = self.bounds(np.array([i]))
        return self.ids[a[0]: b[0]]

    def bounds(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.asarray(i, np.int64)
        start = np.where(i > 0, self.ends.select(np.maximum(i - 1, 0)), 0) if len(i) else i
        return start, self.ends.select(i) if len(i) else i


# Classes of bytes for cutting: 0 white space, 1 letters, 2 digits, 3 other signs.
_CLASS = np.full(256, 3, np.uint8)
_CLASS[~NOT_SPACE] = 0
_CLASS[0x30:0x3A] = 2
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = 1
_UNSURE = np.zeros(256, bool)  # bytes whose run between white space is kept whole
_UNSURE[[*range(0x00, 0x09), *range(0x0E, 0x20), 0x7F, ord("'"), ord("<")]] = True
_UNSURE[0xC0:] = True
_UNSURE[0xC3] = False


def word_units(raw: np.ndarray, offsets: np.ndarray) -> Words:
    """Units that word_bpe encodes by themselves."""
    n = len(raw)
    cls = _CLASS[raw]
    unsure = _UNSURE[raw]
    lead = np.flatnonzero(raw[:-1] == 0xC3)  # Latin-1: letters but the signs for times and divide
    unsure[lead] |= (raw[lead + 1] == 0x97) | (raw[lead + 1] == 0xB7)
    folded = LOWER[raw]
    odd = np.flatnonzero(unsure & (cls != 0))
    if len(odd):
        gap = cls == 0
        stops = np.unique(np.concatenate([np.flatnonzero(gap), np.flatnonzero(gap) + 1, offsets]))
        k = np.unique(np.searchsorted(stops, odd, side="right"))
        mark = np.zeros(n + 1, np.int8)
        mark[stops[k - 1]] += 1
        mark[np.append(stops, n)[k]] -= 1
        whole = np.cumsum(mark[:-1]) > 0
        cls[whole] = 4
        folded[whole] = raw[whole]
    begin = np.empty(n, bool)
    begin[:1] = True
    begin[1:] = (cls[1:] != cls[:-1]) | (cls[1:] == 2)
    return units(folded, begin, offsets, cls != 0)


def word_bpe(path: str):
    """Encoder for a list of units, by the tokenizers library."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    last = np.zeros(max(tok.get_vocab().values()) + 1, bool)
    last[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
    plain = bytes(np.flatnonzero((_CLASS > 0) & ~_UNSURE).astype(np.uint8))

    def single(unit: bytes) -> bool:
        return not unit.translate(None, plain) and b"\xc3\x97" not in unit and b"\xc3\xb7" not in unit

    def encode(new: list[bytes]) -> list[list[int]]:
        out: list = [None] * len(new)
        joined = [k for k, u in enumerate(new) if single(u)]
        for a in range(0, len(joined), 2048):
            part = joined[a: a + 2048]
            ids = tok.encode(" ".join(new[k].decode() for k in part), add_special_tokens=False).ids
            ends = np.flatnonzero(last[ids]) + 1
            if len(ends) != len(part):
                continue  # not one pre-token each after all: one by one below
            begin = 0
            for k, end in zip(part, ends.tolist(), strict=True):
                out[k] = ids[begin:end]
                begin = end
        rest = [k for k, x in enumerate(out) if x is None]
        for k, e in zip(rest, tok.encode_batch([new[k].decode(errors="replace") for k in rest], add_special_tokens=False), strict=True):
            out[k] = e.ids
        return out

    return encode


_memos: dict[str, Memo] = {}


def word_ids(path: str, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, number of ids of each text) by word_bpe."""
    if path not in _memos:
        _memos[path] = Memo(word_bpe(path))
    w = word_units(raw, offsets)
    ids, n = _memos[path].ids(raw, w)
    ends = np.concatenate([[0], np.cumsum(n)])
    return ids, ends[w.first[1:]] - ends[w.first[:-1]]


def with_end(ids: np.ndarray, counts: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each text's ids."""
    return np.insert(ids, np.cumsum(counts), end), counts + 1


def write_files(docs: DataFrame, path: str, tokenizer: str, end: int = END_ID, shard_bytes: int = SHARD_BYTES) -> None:
    """Encodes (doc_id, text) and writes the id files below ``path``, shards
    numbered in ascending doc_id order."""
    size = estimated_bytes(docs.select("doc_id", "text"))
    if size >= 1 << 60:  # not known for this plan
        size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // shard_bytes))
    key = F.xxhash64("text")
    ordered = docs.select("doc_id", "text", key.alias("k")).repartitionByRange(parts, "doc_id", "k").sortWithinPartitions("doc_id", "k")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq = TaskContext.get().partitionId() << 24
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, counts = [], []
            for _, raw, at in text_blocks(batch, most=1 << 20):
                i, n = with_end(*word_ids(tokenizer, raw, at), end)
                ids.append(i)
                counts.append(n)
            all_ids = np.concatenate(ids)
            n_ids = len(all_ids)
            blob = pack(batch.column(0).to_pylist(), np.concatenate(counts), all_ids)
            del batch, ids, all_ids, raw, at, i
            yield pa.RecordBatch.from_arrays([pa.array([seq]), pa.array([n_ids]), pa.array([blob], pa.binary())], names=["shard", "n_ids", "file"])
            del blob
            release()
            seq += 1

    files = ordered.select("doc_id", "text").mapInArrow(encode, "shard long, n_ids long, file binary")
    files.select("shard", "n_ids", F.col("file").cast("string").alias("value")).write.partitionBy("shard", "n_ids").option("lineSep", TRAILER).text(path)


def read_files(spark, path: str) -> DataFrame:
    """(shard long, n_ids long, start long, content binary): ``start`` is the
    number of ids in all shards before."""
    files = binary_files(spark, path, {"shard": "long", "n_ids": "long"})
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start"))
    return files.select("shard", "n_ids", "content").join(checked_broadcast(starts), "shard")


def _digests(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for r in range(batch.num_rows):
        f = IdFile(memoryview(batch.column(batch.schema.get_field_index("content"))[r].as_buffer()))
        a, b = f.bounds(np.arange(len(f.doc_ids)))
        crc = [zlib.crc32(f.ids[x:y].astype("<u4").tobytes()) for x, y in zip(a.tolist(), b.tolist(), strict=True)]
        base = batch.column(batch.schema.get_field_index("start"))[r].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array(f.doc_ids, pa.int64()), pa.array(a + base), pa.array(b - a), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def digests(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""
    return arrow_map(files.select("start", "content"), _digests, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode_and_read(docs: DataFrame, tokenizer: str) -> DataFrame:
    path = scratch(docs.sparkSession, "id-files")
    write_files(docs, path, tokenizer)
    return digests(read_files(docs.sparkSession, path))
