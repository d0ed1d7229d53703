"""Counts of hashed character n-grams, as columns over one row.

A gram's code is the polynomial ``h = (h * BASE + code point) mod PRIME`` over its characters, its bucket that code
modulo the number of buckets, so SQL can repeat it. Texts are lower-cased by Spark; a batch of them is hashed, sorted and
counted as arrays of numbers, some ``PIECE`` characters at a time, so a very long text never stands as one array.
Nothing is exploded and nothing is shuffled.

Null and empty texts have no gram; a text shorter than ``n`` is its own single gram.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

BASE = 1_000_003
PRIME = 2_147_483_647  # 2**31 - 1, so a remainder is a shift and a sum
PIECE = 1 << 15  # so that arrays over it stay in a core's cache
_BITS = 31
_POINT = 0x10FFFF  # the largest code point
_ROOM = 1 << 61


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once per row, however often it is named."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _lower(text: str | Column) -> Column:
    return F.lower(F.col(text) if isinstance(text, str) else text)


def pieces(text: str | Column, n: int) -> Column:
    """A lower-cased text in pieces of ``PIECE`` characters and ``n - 1`` of the next; one empty piece for null and empty texts."""
    text = F.coalesce(_lower(text), F.lit(""))

    def cut(whole: Column) -> Column:
        last = F.greatest(F.length(whole) - F.lit(n - 1), F.lit(1))
        starts = F.sequence(F.lit(1), last, F.lit(PIECE))
        return F.transform(starts, lambda s: F.substring(whole, s, F.lit(PIECE + n - 1)))

    return _bind(text, cut)


# ---- codes of a batch of texts --------------------------------------------------------------


def texts_together(texts: pa.Array, n: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row, size, code points)`` of texts in a row, some ``PIECE`` characters at a time; a longer one goes in
    pieces that share ``n - 1`` characters with the next."""
    rows, sizes, held, total = [], [], [], 0

    def out() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(held).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        return np.array(rows), np.array(sizes), points

    for row, text in enumerate(texts):
        text = text.as_py()
        if not text:
            continue
        for start in range(0, max(len(text) - n + 1, 1), PIECE):
            piece = text[start : start + PIECE + n - 1]
            rows.append(row)
            sizes.append(len(piece))
            held.append(piece)
            total += len(piece)
            if total >= PIECE:
                yield out()
                rows, sizes, held, total = [], [], [], 0
    if rows:
        yield out()


def codes_by_size(sizes: np.ndarray, points: np.ndarray, wanted: Sequence[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(n, owner, code)`` for each ``n`` in ``wanted``: the grams of ``n`` characters of each of many texts, in text order."""
    h, top = points, _POINT  # what h may reach; remainders are taken only before it gets too large, and for a result
    padded = np.concatenate([points, np.zeros(max(wanted), dtype=np.int64)])
    begin = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(sizes)), sizes)
    room = np.repeat(begin + sizes, sizes) - np.arange(len(points))  # characters from here to the end of the text
    for n in range(1, max(wanted) + 1):
        if n > 1:
            if top * BASE + _POINT >= _ROOM:
                h, top = _remainder(h), PRIME
            h = h * BASE
            h += padded[n - 1 : n - 1 + len(points)]
            top = top * BASE + _POINT
        if n in wanted:
            if top >= PRIME:
                h, top = _remainder(h), PRIME
            whole = room >= n
            yield n, owner[whole], h[whole]


def _remainder(h: np.ndarray) -> np.ndarray:
    """``h`` modulo ``PRIME``, for numbers below ``_ROOM``."""
    rest = h & PRIME
    rest += h >> _BITS
    rest -= PRIME * (rest >= PRIME)
    return rest


def _buckets(sizes: np.ndarray, points: np.ndarray, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Owner and bucket of every gram; a text shorter than ``n`` is one."""
    owners, found = [], []
    short = [size for size in range(1, n) if (sizes == size).any()]
    for size, owner, code in codes_by_size(sizes, points, [*short, n]):
        mine = slice(None) if size == n else sizes[owner] == size
        owners.append(owner[mine])
        # The same for a power of two, without a division.
        found.append(code[mine] & (width - 1) if width & (width - 1) == 0 else code[mine] % width)
    return np.concatenate(owners), np.concatenate(found)


def _counted(texts: pa.Array, n: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ``row * width + bucket`` of the buckets that texts have, and how often."""
    keys, counts, last = [], [], -1
    for rows, sizes, points in texts_together(texts, n):
        owner, bucket = _buckets(sizes, points, n, width)
        low, cells = rows[0] * width, (rows[-1] + 1 - rows[0]) * width
        key = rows[owner] * width + bucket - low
        if cells <= 8 * len(key):
            # Few long texts: all of their buckets are counted, without a sort.
            every = np.bincount(key, minlength=cells)
            key = np.flatnonzero(every)
            count = every[key]
        else:
            key.sort()
            key, count = _summed(key, None)
        key += low
        if rows[0] == last:
            # A text in several parts has a bucket several times.
            old, new = np.searchsorted(keys[-1], low), np.searchsorted(key, low + width)
            both = np.concatenate([keys[-1][old:], key[:new]])
            order = np.argsort(both, kind="stable")
            mine = _summed(both[order], np.concatenate([counts[-1][old:], count[:new]])[order])
            keys[-1], counts[-1] = keys[-1][:old], counts[-1][:old]
            key, count = (np.concatenate([m, c[new:]]) for m, c in zip(mine, (key, count)))
        keys.append(key)
        counts.append(count)
        last = rows[-1]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(keys), np.concatenate(counts)


def _summed(key: np.ndarray, count: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Different keys of a sorted array, and their counts summed up, one each if there are none."""
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[head], np.diff(np.append(head, len(key))) if count is None else np.add.reduceat(count, head)


def gram_counts(text: str | Column, n: int = 3, width: int = 1 << 14) -> Column:
    """``array<struct<bucket, n>>`` of a text's grams in order of buckets; empty for null and empty texts."""

    @F.arrow_udf("array<struct<bucket:int,n:bigint>>")
    def counts(texts: pa.Array) -> pa.Array:
        key, count = _counted(texts, n, width)
        starts = np.searchsorted(key, np.arange(len(texts) + 1) * width).astype(np.int32)
        bucket = key - np.repeat(np.arange(len(texts)) * width, np.diff(starts))
        entries = pa.StructArray.from_arrays([pa.array(bucket.astype(np.int32)), pa.array(count)], ["bucket", "n"])
        return pa.ListArray.from_arrays(starts, entries)

    # Marked so that Spark does not count again for a filter on the counts.
    return counts.asNondeterministic()(_lower(text))


def dense_counts(text: str | Column, n: int = 3, width: int = 256) -> Column:
    """The counts of all ``width`` buckets as ``array<double>``; zeros for null and empty texts. For small widths."""

    @F.arrow_udf("array<double>")
    def counts(texts: pa.Array) -> pa.Array:
        every = np.zeros((len(texts), width))
        for rows, sizes, points in texts_together(texts, n):
            owner, bucket = _buckets(sizes, points, n, width)
            # Rows go up, and a long one may be there in several parts.
            some = slice(rows[0], rows[-1] + 1)
            every[some] += np.bincount((rows[owner] - rows[0]) * width + bucket, minlength=(rows[-1] + 1 - rows[0]) * width).reshape(-1, width)
        every = every.ravel()
        return pa.ListArray.from_arrays(np.arange(len(texts) + 1, dtype=np.int32) * width, pa.array(every))

    return counts.asNondeterministic()(_lower(text))


def gram_counts_sql(source: str, key: str, text: str, n: int = 3, width: int = 1 << 14) -> str:
    """``(key, bucket, n)`` in SQL, for tests: one row for each bucket that a text of ``source`` has."""
    h = "0::BIGINT"
    for k in range(n):
        h = f"CASE WHEN place + {k} <= len(codes) THEN ({h} * {BASE} + codes[place + {k}]) % {PRIME} ELSE {h} END"
    return f"""(
        SELECT {key}, ({h}) % {width} AS bucket, count(*) AS n
        FROM (SELECT {key}, codes, unnest(range(1, greatest(len(codes) - {n - 1}, least(len(codes), 1)) + 1)) AS place
              FROM (SELECT {key}, list_transform(string_split(lower({text}), ''), lambda c: unicode(c)::BIGINT) AS codes
                    FROM {source} WHERE length({text}) > 0))
        GROUP BY ALL)"""
