"""Byte-level BPE: texts to ids and back, from a public file of ranks.

Lookup has two tiers. A minimal perfect hash holds the whole vocabulary: a pre-token that is a
token itself costs one probe. Any other is a linked list of bytes, whose adjacent pairs wait in a
heap by rank and then by place; the lowest pair merges, its neighbours' new pairs join the heap,
and stale entries are skipped, so a pre-token of n bytes costs n log n however long it is. What a
pre-token becomes is remembered within a task, so either tier runs once for each distinct one.

Ids travel as binary, each a little-endian unsigned 32-bit integer.

Defined results: a null text counts as empty and has no ids. Strings of special tokens are
ordinary text. Every byte has a token, so decoding gives back exactly the bytes that went in.
Null ids decode to no bytes. Rows are independent: repeated rows and extra columns stay as they are.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType

from emberlink.llm.common import fresh, table
from emberlink.llm.perfect_hash import PerfectHash

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
REMEMBERED = 300_000  # distinct pre-tokens a task keeps; beyond that it starts anew, with the same results
_LONG = 64  # characters; longer pre-tokens are not kept


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank. The file is opened once, on the driver."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in (line.split() for line in lines if line.strip())}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"{path}: ranks are not 0, 1, 2, ...")
    return [ranks[i] for i in range(len(ranks))]


class Codec:
    """Both tiers over one vocabulary. Pickles as the vocabulary, and is built once per worker."""

    def __init__(self, tokens: list[bytes], pattern: str = public_tokenizers.PATTERN) -> None:
        self.tokens, self.pattern = tokens, pattern
        self.whole = PerfectHash(tokens)
        self.rank_of = {t: i for i, t in enumerate(tokens)}  # of pairs, while merging
        self.packed = [i.to_bytes(4, "little") for i in range(len(tokens))]
        self.words = regex.compile(pattern)
        self.seen: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token that is no token itself."""
        rank_of, n = self.rank_of.get, len(piece)
        # A part is known by its first byte's place; ``end`` is where it stops, 0 once it is merged away.
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank_of(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = end[i]
            # Stale: the left part is gone, or either part has grown since.
            if not j or j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            if stop < n:
                before[stop] = i
                if (r := rank_of(piece[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            h = before[i]
            if h >= 0 and (r := rank_of(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        ids, i = [], 0
        while i < n:
            ids.append(self.rank_of[piece[i : end[i]]])
            i = end[i]
        return ids

    def _resolve(self, word: str) -> bytes:
        piece = word.encode("utf-8")
        whole = self.whole.find(piece)
        ids = [whole] if whole >= 0 else self.merge(piece)
        return b"".join([self.packed[i] for i in ids])

    def encode(self, text: str) -> bytes:
        seen, out = self.seen, []
        for word in self.words.findall(text):
            ids = seen.get(word)
            if ids is None:
                if len(seen) >= REMEMBERED:
                    seen.clear()
                ids = self._resolve(word)
                if len(word) <= _LONG:
                    seen[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_CODECS: dict[tuple[int, str], Codec] = {}


def _codec(tokens: list[bytes], pattern: str) -> Codec:
    """A worker's codec for one vocabulary."""
    key = (hash(tuple(tokens)), pattern)
    if key not in _CODECS:
        _CODECS[key] = Codec(tokens, pattern)
    return _CODECS[key]


def encode_texts(df: DataFrame, tokens: list[bytes], text_col: str = "text", ids_col: str = "ids", pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Add ``ids_col``: the text's ids as binary. ``tokens`` come from :func:`read_ranks`."""
    vocabulary = df.sparkSession.sparkContext.broadcast(tokens)  # one file's tokens, whatever the input

    @F.pandas_udf(BinaryType())
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        codec = _codec(vocabulary.value, pattern)
        for batch in batches:
            yield pd.Series([codec.encode(t) if t else b"" for t in batch], dtype=object)

    # Not deterministic to the optimizer only: it must not run the encoder again for each use.
    return df.withColumn(ids_col, encode.asNondeterministic()(F.col(text_col)))


def decode_ids(df: DataFrame, tokens: list[bytes], ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add ``bytes_col``: the bytes that ``ids_col`` stands for."""
    vocabulary = df.sparkSession.sparkContext.broadcast(tokens)

    @F.pandas_udf(BinaryType())
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = vocabulary.value
        for batch in batches:
            yield pd.Series([b"".join(map(known.__getitem__, memoryview(i).cast("I"))) if i else b"" for i in batch], dtype=object)

    return df.withColumn(bytes_col, decode.asNondeterministic()(F.col(ids_col)))


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Digests of every text's ids and of the bytes they decode to."""
    tokens = read_ranks(vocabulary or public_tokenizers.path(VOCABULARY))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ids, back = fresh(docs.columns, "ids"), fresh(docs.columns, "decoded")
    coded = decode_ids(encode_texts(docs, tokens, "text", ids), tokens, ids, back)
    return coded.select(
        "doc_id",
        F.floor(F.octet_length(ids) / 4).alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(back, 256).alias("decoded_sha256"),
    )
