"""Sorted runs of byte strings: front coding, and merging that never compares a known prefix again."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import zstandard


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix, of which ``known`` bytes need no look."""
    stop = min(len(a), len(b))
    x, y = a[known:stop], b[known:stop]
    if x == y:
        return stop
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return stop - (differ.bit_length() + 7) // 8


def encode_run(strings: Sequence[bytes]) -> bytes:
    """A sorted run: for each string the prefix it shares with the one before it, and its tail."""
    shared = np.fromiter((common_prefix(a, b) for a, b in zip([b"", *strings], strings)), "<u4", len(strings))
    sizes = np.fromiter(map(len, strings), "<u4", len(strings))
    tails = b"".join([s[k:] for s, k in zip(strings, shared.tolist())])
    head = np.array([len(strings)], "<u4").tobytes()
    return zstandard.compress(head + shared.tobytes() + sizes.tobytes() + tails, 3)


def decode_run(blob: bytes) -> tuple[list[bytes], list[int]]:
    """The strings of a run, and the prefix each shares with the one before it."""
    raw = zstandard.decompress(blob)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    shared = np.frombuffer(raw, "<u4", n, 4).tolist()
    sizes = np.frombuffer(raw, "<u4", n, 4 + 4 * n).tolist()
    at, last, out = 4 + 8 * n, b"", []
    for k, size in zip(shared, sizes):
        last = last[:k] + raw[at : at + size - k]
        at += size - k
        out.append(last)
    return out, shared


class LoserTree:
    """Merges sorted runs of (strings, shared prefixes).

    Each player knows the prefix it shares with the string put out last. The longer prefix wins
    without a look at the strings; only equal ones are compared, from there on; and a loser then
    knows its prefix with the winner, which is the next to go out.
    """

    def __init__(self, runs: Sequence[tuple[Sequence[bytes], Sequence[int]]]) -> None:
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.at = [0] * self.size
        self.text = [run[0][0] if run[0] else None for run in runs] + [None] * (self.size - len(runs))
        self.shared = [0 if t is not None else -1 for t in self.text]
        self.loser = [0] * self.size
        self.compared = 0  # comparisons that looked at strings

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser; a run that is used up shares -1 and loses to all."""
        x, y = self.shared[a], self.shared[b]
        if x != y or x < 0:
            return (a, b) if x >= y else (b, a)
        s, t = self.text[a], self.text[b]
        self.compared += 1
        k = common_prefix(s, t, x)
        # At the end of one string the shorter is the smaller.
        first = k == len(s) or (k < len(t) and s[k] < t[k])
        winner, loser = (a, b) if first else (b, a)
        self.shared[loser] = k
        return winner, loser

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.loser[node] = self._play(self._build(2 * node), self._build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[int, int, bytes, int]]:
        """(run, place in it, string, prefix shared with the string put out before)."""
        if not self.runs:
            return
        best = self._build(1) if self.size > 1 else 0
        while self.shared[best] >= 0:
            yield best, self.at[best], self.text[best], self.shared[best]
            strings, prefixes = self.runs[best]
            self.at[best] = place = self.at[best] + 1
            if place < len(strings):
                self.text[best], self.shared[best] = strings[place], prefixes[place]
            else:
                self.text[best], self.shared[best] = None, -1
            node = (best + self.size) // 2
            while node:
                if self.size == 1:
                    break
                best, self.loser[node] = self._play(best, self.loser[node])
                node //= 2
