"""Token ids of repeated units, worked out once.

Encoding a text unit by unit repeats itself: most units of a text are
frequent ones. ``Memo`` keeps the ids of units by their 64-bit hash in a
table of fixed size (first come, first kept), asks the encoder only for
units that it does not hold, and puts the ids of whole texts together with
array operations. Memory is bounded whatever the data are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from quarry.llm.words import Words

SLOTS = 1 << 21


class Memo:
    def __init__(self, encode: Callable[[list[bytes]], Sequence[Sequence[int]]], dtype=np.uint16, slots: int = SLOTS):
        self.encode, self.dtype, self.slots = encode, dtype, slots
        self.key = np.zeros(slots, np.uint64)
        self.at = np.zeros(slots, np.uint32)
        self.n = np.zeros(slots, np.uint32)
        self.flat = np.zeros(1 << 16, dtype)
        self.used = 0

    def ids(self, raw: np.ndarray, units: Words) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in order, number of ids of each unit)."""
        h = units.hash
        slot = (h & np.uint64(self.slots - 1)).astype(np.int64)
        held = self.key[slot] == h
        at = self.at[slot].astype(np.int64)
        n = self.n[slot].astype(np.int64)
        n[~held] = 0
        flat = self.flat
        miss = np.flatnonzero(~held)
        if len(miss):
            u, first, back = np.unique(h[miss], return_index=True, return_inverse=True)
            a, b = units.start[miss[first]], units.end[miss[first]]
            data = raw.tobytes()
            new = self.encode([data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)])
            counts = np.fromiter((len(x) for x in new), np.int64, len(new))
            values = np.fromiter((i for x in new for i in x), self.dtype, int(counts.sum()))
            starts = np.cumsum(counts) - counts
            at[miss] = self.used + starts[back]
            n[miss] = counts[back]
            flat = self._add(u, starts, counts, values)
        total = int(n.sum())
        take = np.arange(total) + np.repeat(at - (np.cumsum(n) - n), n)
        return flat[take], n

    def _add(self, u, starts, counts, values) -> np.ndarray:
        """Keeps new units whose slot is free; returns the ids as this call sees them."""
        need = self.used + len(values)
        if need > len(self.flat):
            grown = np.zeros(max(need, 2 * len(self.flat)), self.dtype)
            grown[: self.used] = self.flat[: self.used]
            self.flat = grown
        self.flat[self.used: need] = values
        seen = self.flat
        slot = (u & np.uint64(self.slots - 1)).astype(np.int64)
        free = self.key[slot] == 0
        _, once = np.unique(slot[free], return_index=True)
        keep = np.flatnonzero(free)[once]
        if need <= 8 * self.slots:
            self.key[slot[keep]] = u[keep]
            self.at[slot[keep]] = self.used + starts[keep]
            self.n[slot[keep]] = counts[keep]
            self.used = need
        return seen
