"""Suffix-rank intervals over a delimited vocabulary, and the search with one error after an exact half.

The text is ``$w1$w2..$wn$`` with the words in order. Its suffixes are sorted up to the next delimiter,
equal ones by their place, which is an order that stepping to the left keeps. An interval of that
order holds the suffixes that begin with what was read so far; reading one more symbol to the left
is two rank look-ups. Ranks come from counts at every 64th place and a bit mask for each symbol in
between. The index reads to the left; an index over reversed words reads to the right, and the two
together are the two directions of a search scheme.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

_BLOCK = 64
_ONE = np.uint64(1)


def sort_suffixes(text: np.ndarray) -> np.ndarray:
    """Places of ``text`` (0 is the delimiter) by the string up to the next delimiter, then by place."""
    size = len(text)
    ends = np.flatnonzero(text == 0)
    rank = text.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))  # no two delimiters are equal, so nothing is compared beyond one
    step = 1
    while True:
        after = np.full(size, -1, np.int64)
        after[:-step] = rank[step:]
        # A delimiter ends the comparison: what follows it does not count.
        after[ends] = -1
        order = np.lexsort((after, rank))
        a, b = rank[order], after[order]
        rank = np.empty(size, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum((a[1:] != a[:-1]) | (b[1:] != b[:-1]))])
        if rank[order[-1]] == size - 1 or 2 * step >= size:
            return order
        step *= 2


class Index:
    """An index of distinct non-empty words over symbols 1 to ``symbols`` - 1, given as byte strings."""

    def __init__(self, words: Sequence[bytes], symbols: int) -> None:
        self.words = sorted(words)
        self.symbols = symbols
        text = np.frombuffer(b"\0" + b"".join(w + b"\0" for w in self.words), np.uint8)
        order = sort_suffixes(text)
        before = text[order - 1].astype(np.int64)  # the symbol to the left of each suffix, in order
        before[order == 0] = symbols  # nothing is to the left of the text, so a whole word's interval is its number
        blocks = len(before) // _BLOCK + 1
        padded = np.concatenate([before, np.full(blocks * _BLOCK - len(before), symbols)])
        counts = np.bincount(np.arange(len(padded)) // _BLOCK * (symbols + 1) + padded, minlength=blocks * (symbols + 1))
        counts = counts.reshape(blocks, symbols + 1)[:, :symbols]
        first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=symbols))])[:symbols]
        #: Where the suffixes with a symbol to the left of those before a block go.
        self.start = (np.cumsum(counts, axis=0) - counts + first).astype(np.int32)
        self.mask = np.zeros((blocks, symbols + 1), np.uint64)
        rows = np.arange(blocks)
        for i in range(_BLOCK):
            self.mask[rows, padded[i::_BLOCK]] |= _ONE << np.uint64(i)

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """One bound of an interval after reading ``symbol`` to the left."""
        block, below = at // _BLOCK, (_ONE << (at % _BLOCK).astype(np.uint64)) - _ONE
        return self.start[block, symbol] + np.bitwise_count(self.mask[block, symbol] & below)

    def step_all(self, at: np.ndarray) -> np.ndarray:
        """The same for every symbol, one row a bound."""
        block, below = at // _BLOCK, (_ONE << (at % _BLOCK).astype(np.uint64)) - _ONE
        return self.start[block] + np.bitwise_count(self.mask[block, : self.symbols] & below[:, None])


def _codes(words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words from the last to the first, each with its delimiter; where each begins; sizes."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer(b"".join(w[::-1] + b"\0" for w in words), np.uint8).astype(np.int64), np.cumsum(sizes + 1) - sizes - 1, sizes


def near_words(index: Index, queries: Sequence[bytes], exact: np.ndarray, together: int = 8192) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (query, word of the index, by their numbers) with exactly one symbol inserted, deleted or replaced.

    The last ``exact`` symbols of a query are matched as they are, the rest with exactly one error. Of
    equal ways to make a word (a symbol more or less in a run of it) only the last in reading order
    is followed, so a pair comes once.
    """
    for begin in range(0, len(queries), together):
        q, w = _search(index, queries[begin : begin + together], exact[begin : begin + together])
        yield q + begin, w


def _search(index: Index, queries: Sequence[bytes], exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    text, base, size = _codes(queries)
    q = np.arange(len(queries))
    lo, hi = np.zeros(len(q), np.int64), np.full(len(q), len(index.words) + 1)
    for at in range(int(exact.max(initial=0))):
        more = exact[q] > at
        symbol = text[base[q[more]] + at]
        lo[more], hi[more] = index.step(symbol, lo[more]), index.step(symbol, hi[more])
        live = lo < hi
        q, lo, hi = q[live], lo[live], hi[live]
    at = exact[q]
    empty = np.zeros(0, np.int64)
    open_ = (empty, empty, empty, empty)  # states after the error: query, place, interval
    found_q, found_w = [], []
    while len(q) or len(open_[0]):
        new = [open_]
        if len(q):
            new += _errors(index, text, base, size, q, at, lo, hi)
            unread = at < size[q]
            q, at, lo, hi = q[unread], at[unread], lo[unread], hi[unread]
            symbol = text[base[q] + at]
            lo, hi, at = index.step(symbol, lo), index.step(symbol, hi), at + 1
            live = lo < hi
            q, at, lo, hi = q[live], at[live], lo[live], hi[live]
        pq, pat, plo, phi = (np.concatenate([s[i] for s in new]) for i in range(4))
        symbol = text[base[pq] + pat]  # behind the last symbol, the delimiter
        plo, phi = index.step(symbol, plo), index.step(symbol, phi)
        live = plo < phi
        whole = live & (pat == size[pq])
        found_q.append(pq[whole])
        found_w.append(plo[whole])
        live &= ~whole
        open_ = (pq[live], pat[live] + 1, plo[live], phi[live])
    return np.concatenate([empty, *found_q]), np.concatenate([empty, *found_w])


def _errors(index: Index, text: np.ndarray, base: np.ndarray, size: np.ndarray, q: np.ndarray, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple]:
    """States with one error, here, from states without."""
    symbol = text[base[q] + at]
    left = at < size[q]
    # A symbol of the query that the word lacks.
    last_of_run = left & ((at + 1 >= size[q]) | (text[np.minimum(base[q] + at + 1, len(text) - 1)] != symbol))
    lacking = (q[last_of_run], at[last_of_run] + 1, lo[last_of_run], hi[last_of_run])
    all_lo, all_hi = index.step_all(lo), index.step_all(hi)
    row, other = np.nonzero(all_hi[:, 1:] > all_lo[:, 1:])
    other += 1
    differs = other != symbol[row]
    row, other = row[differs], other[differs]
    new_lo, new_hi = all_lo[row, other].astype(np.int64), all_hi[row, other].astype(np.int64)
    # One more symbol in the word, or another one.
    more = (q[row], at[row], new_lo, new_hi)
    swap = left[row]
    return [lacking, more, (q[row[swap]], at[row[swap]] + 1, new_lo[swap], new_hi[swap])]
