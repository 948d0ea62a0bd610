"""Vectorised word scanning over whole text columns.

The operators of this package read words straight from the UTF-8 bytes of
an Arrow string column: a byte table says which bytes belong to words, the
word borders are found with one pass, and each word becomes a 64-bit hash
(polynomial over its bytes, mixed). Hashing goes in pieces of bounded
size that end between words.

Null texts have no words. The hash of a word depends on its (lower-cased)
bytes alone; two different words share one with probability about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 17  # bytes hashed at once
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"): ord("Z") + 1] += 32

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: Words as runs of anything but space, tab and line-break bytes.
NOT_SPACE = ~_SPACES
#: Words as runs of digits, letters and non-ASCII bytes (after lower-casing).
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = True
ALNUM[0x61:0x7B] = True
ALNUM[0x80:] = True

_tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for positions below n."""
    have = _tables.get(0)
    if have is None or len(have[0]) < n:
        size = max(n, PIECE)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        with np.errstate(over="ignore"):
            up = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, _BASE)]), dtype=np.uint64)
            down = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, inverse)]), dtype=np.uint64)
        if size > 4 * PIECE:  # an extraordinary word: do not keep its tables
            return up, down
        _tables[0] = (up, down)
    return _tables[0]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return h ^ (h >> np.uint64(31))


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        empty = b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else ""
        column = column.fill_null(empty)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0]: at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def blocks(lengths: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs [a, b) of consecutive rows with about ``most`` bytes, one row at least."""
    ends = np.cumsum(lengths)
    a = 0
    while a < len(lengths):
        done = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, done + most, side="right")))
        yield a, b
        a = b


class Words:
    """Words of some rows: their hashes, byte borders and the rows they lie in.

    ``first[r] .. first[r + 1]`` are the words of row r.
    """

    __slots__ = ("hash", "start", "end", "first")

    def __init__(self, hash_, start, end, first):
        self.hash, self.start, self.end, self.first = hash_, start, end, first

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def units(folded: np.ndarray, begin: np.ndarray, offsets: np.ndarray, keep: np.ndarray | None = None) -> Words:
    """Units of every row of (already folded) bytes. ``begin`` marks the bytes
    at which a unit starts; rows start one by themselves. Units whose first
    byte is not in ``keep`` are left out."""
    n = len(folded)
    begin[offsets[offsets < n]] = True
    start = np.flatnonzero(begin)
    end = np.append(start[1:], n)
    if keep is not None:
        kept = keep[start]
        start, end = start[kept], end[kept]
    hash_ = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(start, start[i] + PIECE)))
        if j - i > 1 and end[j - 1] - start[i] > 2 * PIECE:  # an extraordinary unit waits for its own turn
            j -= 1
        a, b = start[i], end[j - 1]
        up, down = _powers(b - a + 1)
        with np.errstate(over="ignore"):
            total = np.empty(b - a + 1, np.uint64)
            total[0] = 0
            np.cumsum((folded[a:b].astype(np.uint64) + np.uint64(1)) * up[: b - a], out=total[1:])
            hash_[i:j] = mix((total[end[i:j] - a] - total[start[i:j] - a]) * down[start[i:j] - a])
        i = j
    return Words(hash_, start, end, np.searchsorted(start, offsets, side="left"))


def scan(raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray = NOT_SPACE, lower: bool = True) -> Words:
    """Words of every row. ``inside`` tells the word bytes (of text that is
    lower-cased first if ``lower``)."""
    folded = LOWER[raw] if lower else raw
    word = inside[folded]
    begin = np.empty(len(word), bool)
    begin[:1] = True
    np.not_equal(word[1:], word[:-1], out=begin[1:])
    return units(folded, begin, offsets, word)


def windows(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, row) of every run of ``width`` words inside one row; a row
    of fewer words, but not none, gives one shorter run."""
    counts = words.counts()
    n = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), n)
    base = np.cumsum(n) - n
    return words.first[:-1][row] + (np.arange(len(row)) - base[row]), row


def run_hashes(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) for the runs of ``windows``."""
    at, row = windows(words, width)
    if not len(at):
        return np.zeros(0, np.uint64), row
    length = np.minimum(words.counts(), width)[row]
    h = np.zeros(len(at), np.uint64)
    last = len(words.hash) - 1
    with np.errstate(over="ignore"):
        for k in range(width):
            step = np.where(k < length, words.hash[np.minimum(at + k, last)], np.uint64(0)) if (length <= k).any() else words.hash[at + k]
            h = (h ^ step) * _BASE
            h ^= h >> np.uint64(29)
        h ^= length.astype(np.uint64)
    return mix(h), row
