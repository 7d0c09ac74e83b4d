"""Hashes of runs of bytes, all runs of a batch at once."""

from __future__ import annotations

import numpy as np

# odd multipliers of two independent families, and the final mixing
BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
PIECE_BYTES = 1 << 20


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class RunHasher:
    """Two 64-bit hashes of each run ``data[starts[i]:ends[i]]``: polynomials modulo
    2**64 from prefix sums (a run's sum, divided by its first power), then mixed
    with the run's length. Runs are in order and do not overlap."""

    def __init__(self) -> None:
        self.powers = [np.ones(1, np.uint64) for _ in BASES]
        self.inverses = [np.ones(1, np.uint64) for _ in BASES]

    def _grow(self, n: int) -> None:
        if len(self.powers[0]) < n:
            for k, base in enumerate(BASES):
                for own, step in ((self.powers, base), (self.inverses, pow(base, -1, 1 << 64))):
                    factors = np.full(n, np.uint64(step))
                    factors[0] = 1
                    own[k] = np.cumprod(factors, dtype=np.uint64)

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, piece_bytes: int | None = None) -> list[np.ndarray]:
        out = [np.zeros(len(starts), np.uint64) for _ in BASES]
        limit, a = piece_bytes or PIECE_BYTES, 0
        while a < len(starts):
            b = max(a + 1, int(np.searchsorted(ends, starts[a] + limit, "right")))
            base = starts[a]
            piece = data[base:ends[b - 1]].astype(np.uint64)
            self._grow(len(piece) + 1)
            for k in range(len(BASES)):
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(piece * self.powers[k][:len(piece)], dtype=np.uint64)))
                own = (sums[ends[a:b] - base] - sums[starts[a:b] - base]) * self.inverses[k][starts[a:b] - base]
                out[k][a:b] = mixed(own + (ends[a:b] - starts[a:b]).astype(np.uint64))
            a = b
        return out


class HashIndex:
    """Entry number of keys of two 64-bit hashes: open addressing over arrays. The
    first hash places a key, the second verifies it. 20 to 40 bytes a key."""

    def __init__(self) -> None:
        self.size = 0
        self.first, self.entry, self.second = np.zeros(1 << 12, np.uint64), np.full(1 << 12, -1, np.int32), np.zeros(0, np.uint64)

    def find(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        out, mask = np.full(len(first), -1, np.int64), len(self.entry) - 1
        at, todo = (first & np.uint64(mask)).astype(np.int64), np.arange(len(first))
        while len(todo):
            entry = self.entry[at]
            hit = (entry >= 0) & (self.first[at] == first[todo])
            hit[hit] = self.second[entry[hit]] == second[todo[hit]]
            out[todo[hit]] = entry[hit]
            on = (entry >= 0) & ~hit
            todo, at = todo[on], (at[on] + 1) & mask
        return out

    def add(self, first: np.ndarray, second: np.ndarray) -> None:
        """Distinct keys that are not there yet get the next entries, in order."""
        n = self.size + len(first)
        if 2 * n > len(self.entry):
            kept = np.flatnonzero(self.entry >= 0)
            keys, entries = self.first[kept], self.entry[kept]
            width = 1 << (2 * n).bit_length()
            self.first, self.entry = np.zeros(width, np.uint64), np.full(width, -1, np.int32)
            self._place(keys, entries)
        self.second = np.concatenate((self.second[:self.size], second))
        self._place(first, np.arange(self.size, n, dtype=np.int32))
        self.size = n

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        mask = len(self.entry) - 1
        at, todo = (keys & np.uint64(mask)).astype(np.int64), np.arange(len(keys))
        while len(todo):
            free = self.entry[at] < 0
            self.entry[at[free]] = entries[todo[free]]             # of keys that meet, the last one stays
            placed = self.entry[at] == entries[todo]
            self.first[at[placed]] = keys[todo[placed]]
            todo, at = todo[~placed], (at[~placed] + 1) & mask
