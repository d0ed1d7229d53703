"""A minimal perfect hash over a fixed set of byte strings.

Hash and displace: keys fall into buckets, and each bucket, largest first, looks for a seed that
sends its keys to free slots. ``n`` keys fill exactly ``n`` slots, so a lookup is two hashes, one
array read and one comparison with the key that owns the slot.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from xxhash import xxh3_64_intdigest

_PER_BUCKET = 4
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _slots(hashes: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
    """Where each hash goes under each seed; rows are seeds."""
    with np.errstate(over="ignore"):
        x = (hashes[None, :] ^ (seeds.astype(np.uint64)[:, None] * _MIX)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
    return (x % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """Maps each key of a fixed set to its own slot in ``range(len(keys))``."""

    def __init__(self, keys: Sequence[bytes]) -> None:
        n = self.n = len(keys)
        if len(set(keys)) != n:
            raise ValueError("keys must differ")
        self.buckets = max(1, -(-n // _PER_BUCKET))
        self.seeds = np.zeros(self.buckets, dtype=np.uint32)
        self.owner = np.zeros(n, dtype=np.int64)
        hashes = np.array([xxh3_64_intdigest(k) for k in keys], dtype=np.uint64)
        bucket = (hashes >> np.uint64(32)) % np.uint64(self.buckets)
        order = np.argsort(bucket, kind="stable")
        starts = np.searchsorted(bucket[order], np.arange(self.buckets + 1, dtype=np.uint64))
        taken = np.zeros(n, dtype=bool)
        for b in np.argsort(-np.diff(starts), kind="stable"):
            members = order[starts[b] : starts[b + 1]]
            if not len(members):
                break
            first, tries = 0, 16
            while True:
                at = _slots(hashes[members], np.arange(first, first + tries), n)
                fits = ~taken[at].any(axis=1)
                if len(members) > 1:
                    sorted_at = np.sort(at, axis=1)
                    fits &= (np.diff(sorted_at, axis=1) > 0).all(axis=1)
                if fits.any():
                    pick = int(np.argmax(fits))
                    self.seeds[b] = first + pick
                    taken[at[pick]] = True
                    self.owner[at[pick]] = members
                    break
                first, tries = first + tries, min(4 * tries, 1 << 16)
        #: For a lookup one key at a time, plain lists are faster than arrays.
        self._seeds, self._keys = self.seeds.tolist(), [keys[i] for i in self.owner]
        self._owner = self.owner.tolist()

    def find(self, key: bytes) -> int:
        """The position of ``key`` in the set, or -1."""
        if not self.n:
            return -1
        h = xxh3_64_intdigest(key)
        x = ((h ^ (self._seeds[(h >> 32) % self.buckets] * 0x9E3779B97F4A7C15 & _ALL)) * 0xD6E8FEB86659FD93) & _ALL
        x ^= x >> 32
        x = x * 0xD6E8FEB86659FD93 & _ALL
        slot = (x ^ (x >> 32)) % self.n
        return self._owner[slot] if self._keys[slot] == key else -1


_ALL = (1 << 64) - 1
