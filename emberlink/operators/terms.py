"""Which terms of a large lexicon occur in a text, as plain substrings.

``match_any`` writes every term into the expression, which costs a search a term and row. Here a term is found by its rarest
gram of four characters: the grams of a batch of texts are hashed as one array, and a text is searched only for the terms
whose gram it has. Up to ``MAX_BROADCAST_BYTES`` the grams and terms are looked up in that array itself; beyond that texts meet
terms in an equi-join on the gram's code. The cost follows the texts and the hits, not the number of terms. Codes may collide;
the search that follows makes the result exact.

Letters are compared in lower case. Null and empty terms are left out, repeated terms count once, null and empty texts hold no term.
Terms of fewer than four characters are found by grams of their own length. Long texts go in pieces that overlap by the longest term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from emberlink.functions.grams import texts_together, codes_by_size, pieces
from emberlink.session import cut_lineage

GRAM = 4
#: Up to so many bytes of grams, or of terms, travel to every task; beyond that Spark shuffles grams.
MAX_BROADCAST_BYTES = 32 << 20
_KEY_BITS = 35  # n is at most GRAM, a code below 2**31
_SLOTS = 1 << 20  # of a table that tells most grams that no term has


class Wanted:
    """A sorted set of ``n * 2**32 + code``, and whether it holds the members of an array."""

    def __init__(self, keys: np.ndarray) -> None:
        self.keys = np.unique(keys)
        self.slots = np.zeros(_SLOTS, dtype=bool)
        self.slots[self.keys % _SLOTS] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``keys`` of those that are held, and their places in the set."""
        likely = np.flatnonzero(self.slots[keys % _SLOTS])
        place = np.minimum(np.searchsorted(self.keys, keys[likely]), max(len(self.keys) - 1, 0))
        right = self.keys[place] == keys[likely] if len(self.keys) else np.zeros(0, dtype=bool)
        return likely[right], place[right]


def _grams(texts: pa.Array, sizes: list[int], wanted: Wanted | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(row, key)`` of the different grams of each text, in order: ``n * 2**32 + code``, or its place in ``wanted``."""
    for rows, lengths, points in texts_together(texts, max(sizes)):
        found = []
        for n, owner, code in codes_by_size(lengths, points, sizes):
            key = code + (n << 32)
            if wanted is not None:
                at, key = wanted.find(key)
                owner = owner[at]
            found.append((rows[owner], key))
        row, key = (np.concatenate([f[i] for f in found]) for i in range(2))
        # Row and key in one number: a plain sort is several times faster than one by two columns.
        both = np.sort((row << _KEY_BITS) | key)
        both = both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both
        yield both >> _KEY_BITS, both & ((1 << _KEY_BITS) - 1)


def _grams_of(text: Column, sizes: list[int]) -> Column:
    """The different ``(n, code)`` of a text."""

    @F.arrow_udf("array<struct<n:int,code:int>>")
    def grams(texts: pa.Array) -> pa.Array:
        parts = [*_grams(texts, sizes, None), (np.zeros(0, np.int64), np.zeros(0, np.int64))]
        row, key = (np.concatenate([p[i] for p in parts]) for i in range(2))
        starts = np.searchsorted(row, np.arange(len(texts) + 1)).astype(np.int32)
        pair = [pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32))]
        return pa.ListArray.from_arrays(starts, pa.StructArray.from_arrays(pair, ["n", "code"]))

    return grams.asNondeterministic()(text)


def _seen(texts: DataFrame, sizes: list[int], wanted: Wanted | None) -> DataFrame:
    """``(n, code, seen)``: in how many rows of ``piece`` each gram occurs, of those that are ``wanted``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, key in _grams(batch.column("piece"), sizes, wanted):
                key, times = np.unique(key, return_counts=True)
                if wanted is not None:
                    key = wanted.keys[key]
                yield pa.RecordBatch.from_arrays(
                    [pa.array((key >> 32).astype(np.int32)), pa.array((key & 0xFFFFFFFF).astype(np.int32)), pa.array(times)], ["n", "code", "times"]
                )

    counted = texts.select("piece").mapInArrow(count, "n int, code int, times long")
    return counted.groupBy("n", "code").agg(F.sum("times").alias("seen"))


def _keys(df: DataFrame) -> np.ndarray:
    """``n`` and ``code`` of every row, as one number each; for frames that are known to be small."""
    table = df.select((F.col("n").cast("long") * F.lit(1 << 32) + F.col("code")).alias("key")).toArrow()
    return table.column("key").to_numpy().astype(np.int64)


def term_keys(texts: DataFrame, text: str, terms: DataFrame, term: str = "term", max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``(term, n, code, seen)``: for each term its gram that the fewest texts have (``seen``; the smallest code of equals).

    Terms with a gram that no text has are left out: they occur nowhere.
    """
    lowered = terms.select(F.lower(F.col(term)).alias("term")).where("term != ''").distinct()
    lowered = cut_lineage(lowered.withColumn("n", F.least(F.length("term"), F.lit(GRAM))), "terms")
    sizes = sorted(r["n"] for r in lowered.select("n").distinct().collect())
    if not sizes:
        return texts.sparkSession.createDataFrame([], "term string, n int, code int, seen long")
    own = lowered.select("term", "n", F.explode(_grams_of(F.col("term"), sizes)).alias("gram")).where("gram.n = n")
    grams = cut_lineage(own.select("term", "n", "gram.code"), "term-grams")
    different = grams.select("n", "code").distinct()
    small = different.count() * 24 <= max_broadcast_bytes
    seen = _seen(texts.select(F.explode(pieces(F.col(text), GRAM)).alias("piece")), sizes, Wanted(_keys(different)) if small else None)
    if not small:
        seen = seen.join(different, ["n", "code"], "left_semi")
    rarest = grams.join(seen, ["n", "code"], "left").groupBy("term", "n").agg(
        F.min(F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "code")).alias("least")
    )
    return rarest.select("term", "n", "least.code", "least.seen").where("seen > 0")


def match_terms(
    texts: DataFrame, key: str, text: str, terms: DataFrame, term: str = "term", max_broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """``(key, term)`` for every term, lower-cased, that the text of ``key`` holds; each pair once."""
    keys = cut_lineage(term_keys(texts, text, terms, term, max_broadcast_bytes), "term-keys")
    size = F.sum(F.octet_length("term") + 40).alias("bytes")
    facts = keys.agg(F.max(F.length("term")).alias("longest"), F.collect_set("n").alias("sizes"), size).first()
    sizes, longest = sorted(facts["sizes"]), facts["longest"] or 1
    if not sizes:
        return texts.select(key, F.lit(None).cast("string").alias("term")).where("false")
    # Pieces overlap by the longest term, so whatever begins in one also ends in it.
    cut = texts.select(key, F.explode(pieces(F.col(text), longest)).alias("__piece"))
    if facts["bytes"] <= max_broadcast_bytes:
        # Numbers stand for terms until each pair is there once.
        held, names = _terms_in("__piece", keys, sizes)
        pairs = cut.select(key, F.explode(held).alias("__no")).distinct()
        return pairs.join(F.broadcast(names), "__no").select(key, "term")
    grams = cut.withColumn("__gram", F.explode(_grams_of(F.col("__piece"), sizes)))
    met = grams.select(key, "__piece", F.col("__gram.n").alias("n"), F.col("__gram.code").alias("code")).join(keys.select("term", "n", "code"), ["n", "code"])
    return met.where(F.contains("__piece", "term")).select(key, "term").distinct()


def _terms_in(piece: str, keys: DataFrame, sizes: list[int]) -> tuple[Column, DataFrame]:
    """The numbers of the terms that a piece of text holds, and ``(__no, term)``; ``keys`` go to every task."""
    table = keys.select("term", "n", "code").toArrow()  # at most max_broadcast_bytes, checked by the caller
    key = table.column("n").to_numpy().astype(np.int64) * (1 << 32) + table.column("code").to_numpy()
    wanted, terms = Wanted(key), table.column("term").to_pylist()
    own: list[list[tuple[str, int]]] = [[] for _ in wanted.keys]
    for no, (place, name) in enumerate(zip(np.searchsorted(wanted.keys, key).tolist(), terms)):
        own[place].append((name, no))
    spark = keys.sparkSession
    shipped = spark.sparkContext.broadcast((wanted, own))

    @F.arrow_udf("array<int>")
    def held(texts: pa.Array) -> pa.Array:
        wanted, own = shipped.value
        ends, found = np.zeros(len(texts) + 1, dtype=np.int32), []
        text, last, mine = "", -1, {}
        for rows, places in _grams(texts, sizes, wanted):
            for row, place in zip(rows.tolist(), places.tolist()):
                if row != last:
                    found.extend(mine)
                    ends[last + 1] = len(mine)
                    text, last, mine = texts[row].as_py(), row, {}
                for name, no in own[place]:
                    if name in text:
                        mine[no] = None
        found.extend(mine)
        ends[last + 1] = len(mine)
        return pa.ListArray.from_arrays(np.cumsum(ends, dtype=np.int32), pa.array(found, pa.int32()))

    names = spark.createDataFrame(list(enumerate(terms)), "__no int, term string")
    return held.asNondeterministic()(F.col(piece)), names
