"""Packing documents into training sequences by the histogram of their lengths.

Shortest-pack-first over the length histogram: lengths are placed longest first, each into the
emptiest packs that still hold it, and what is counted is packing patterns, not documents. The
histogram has at most ``limit`` entries and the patterns are few for any corpus, so that part
runs on the driver; documents then find their place by their rank among those of equal length.

Where no open pack holds a length, as few new packs as possible are opened for it, each with as
many of that length as fit. (One pack for each, as in the published form, would leave a corpus of
equal copies almost all padding.)

A document's ids are its text's, by a public tokenizer, and a closing id. Documents of more than
``limit`` ids are cut every ``limit`` ids, so all but their last pieces fill a sequence.

Defined results: a null text counts as empty and yields the closing id alone. A null ``doc_id`` is a
document like any other. Strings of special tokens are ordinary text. Repeated rows are documents of their own. Extra columns are not read.
An empty table gives no pieces.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from emberlink.llm.common import cut_lineage, table
from emberlink.llm.memo import Memo

VOCABULARY = "word_bpe_49k.json"
LIMIT = 4096
CLOSING_ID = 2
REMEMBERED_BYTES = 96_000_000  # of distinct words a task keeps; beyond that it starts anew, with the same results
_BATCH = 4_000_000  # characters tokenized at a time
_TOGETHER = 500  # plain words
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")  # one piece each, in whatever case, and in normal form
_WORD_END = "</w>"

Slot = tuple[int, int, int, int, int]


class WordCoder:
    """Ids of texts, word by word.

    The tokenizer's pieces never reach across a space or a line feed, and its normalization acts
    on each side of one alone, so the ids of a text are those of its words in a row. Marks and signs
    between a letter or digit and the word's end are a piece of their own, too. Each distinct word of a batch is looked up once, and
    new ones of plain letters go through the tokenizer many at a time: each of them is one piece, whose last
    id is one that ends a word.
    """

    def __init__(self, vocabulary: str, closing_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(vocabulary)
        self.tokenizer.encode_special_tokens = True
        by_id = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(by_id.values()) + 1, bool)
        self.ends[[i for token, i in by_id.items() if token.endswith(_WORD_END)]] = True
        self.closing = np.array([closing_id], "<u4")
        self.memo = Memo(REMEMBERED_BYTES)
        self._start_anew()

    def _start_anew(self, kept: list[str] = [], ids: np.ndarray | None = None, count: np.ndarray | None = None) -> None:
        """Entry 0 is the closing id; the others are what is ``kept``."""
        self.memo.clear()
        self.memo.add(["\n"])  # no word: texts are cut there
        self.ids, self.count, self.met = self.closing, np.ones(1, np.int64), np.zeros(1, np.int32)
        if kept:
            self._add(kept, ids, count)

    def _forget(self) -> None:
        """Keep the words of two batches or more; if these are too many as well, none."""
        again = np.flatnonzero(self.met > 1)
        words = list(self.memo.place)
        kept = [words[i] for i in again.tolist()]
        if 2 * len(kept) > len(words):
            return self._start_anew()
        self._start_anew(kept, self._of(again), self.count[again])

    def _of(self, entries: np.ndarray) -> np.ndarray:
        """The ids of entries in a row."""
        sizes = self.count[entries]
        begin = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.first[entries] - begin, sizes) + np.arange(sizes.sum())]

    def _add(self, words: list[str], ids: np.ndarray, count: np.ndarray) -> None:
        self.memo.add(words, 4 * len(ids) + 20 * len(count))
        self.ids, self.count = np.concatenate([self.ids, ids]), np.concatenate([self.count, count])
        self.first = np.cumsum(self.count) - self.count
        self.met = np.concatenate([self.met, np.zeros(len(words), np.int32)])

    def _new_ids(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(ids, how many of them each word has) of plain words, a block at a time."""
        blocks = [words[i : i + _TOGETHER] for i in range(0, len(words), _TOGETHER)]
        for block, coded in zip(blocks, self.tokenizer.encode_batch_fast([" ".join(b) for b in blocks], add_special_tokens=False)):
            ids = np.array(coded.ids, "<u4")
            last = np.flatnonzero(self.ends[ids])
            if len(last) != len(block):
                raise ValueError("the vocabulary does not end words the way this coder needs")
            yield ids, np.diff(last, prepend=-1)

    def _learn(self, words: list[str]) -> np.ndarray:
        """Add entries for ``words``; the order in which they are added."""
        is_plain = np.fromiter((w.isalpha() and _PLAIN.fullmatch(w) is not None for w in words), bool, len(words))
        order = np.argsort(~is_plain, kind="stable")
        plain, others = [words[i] for i in order[: is_plain.sum()]], [words[i] for i in order[is_plain.sum() :]]
        coded = list(self._new_ids(plain))
        for one in self.tokenizer.encode_batch_fast(others, add_special_tokens=False):
            coded.append((np.array(one.ids, "<u4"), np.array([len(one.ids)])))
        self._add(plain + others, *(np.concatenate([c[i] for c in coded]) for i in range(2)))
        return order

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, each text's closing id included, and where each text's begin (and the last end)."""
        if self.memo.full:
            self._forget()
        marked = pc.replace_substring_regex(texts, r"([\pL\pN])([\pP\pS]+)([ \n]|$)", r"\1 \2\3")
        split = pc.split_pattern(pc.replace_substring(marked, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        entry = self.memo.numbers(words)
        new = np.flatnonzero(entry < 0)
        if len(new):
            next_entry = len(self.memo.place)
            entry[new[self._learn([words[i] for i in new])]] = next_entry + np.arange(len(new))
        self.met[entry] += 1
        used = entry[coded.indices.to_numpy()]
        behind = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        used = np.insert(used, behind, 0)
        places = np.cumsum(self.count[used])
        ends = places[behind + np.arange(len(behind))]
        return self._of(used), np.concatenate([[0], ends])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text, closing id included.

        Texts are worked on in runs of some ``_BATCH`` characters; longer ones are cut at spaces, where ids do not meet.
        """
        parts = [(i, part) for i, text in enumerate(texts) for part in _at_spaces(text)]
        sizes = np.cumsum([len(p) for _, p in parts]) // _BATCH
        packed: list[list[bytes]] = [[] for _ in texts]
        for batch in np.unique(sizes):
            rows = np.flatnonzero(sizes == batch)
            ids, at = self.encode_array(pa.array([parts[r][1] for r in rows], pa.string()))
            for r, lo, hi in zip(rows.tolist(), at[:-1].tolist(), at[1:].tolist()):
                packed[parts[r][0]].append(ids[lo:hi].tobytes())
        # Each part closes with an id of its own; only the last one counts.
        return [b"".join([p[:-4] for p in own[:-1]] + own[-1:]) for own in packed]


def _at_spaces(text: str) -> list[str]:
    """``text`` in parts of some ``_BATCH`` characters, cut at spaces, which are left out."""
    out, start = [], 0
    while len(text) - start > _BATCH:
        stop = text.find(" ", start + _BATCH)
        if stop < 0:
            break
        out.append(text[start:stop])
        start = stop + 1
    return [*out, text[start:] if start else text]


_CODERS: dict[tuple[int, int], WordCoder] = {}


def _coder(vocabulary: str, closing_id: int) -> WordCoder:
    """A worker's coder, with the words it has met in earlier tasks; of bounded size."""
    key = (hash(vocabulary), closing_id)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = WordCoder(vocabulary, closing_id)
    return _CODERS[key]


def cut_pieces(df: DataFrame, vocabulary: str, limit: int = LIMIT, closing_id: int = CLOSING_ID, keep_ids: bool = False) -> DataFrame:
    """Pieces of at most ``limit`` ids, with ``turn``: their number among those of equal length in one task."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)  # one file, whatever the input
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "turn", *(["ids"] if keep_ids else [])]
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, turn long" + ", ids binary" * keep_ids
    arrow = pa.schema([(c, pa.binary() if c == "ids" else pa.int64()) for c in columns])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, turns = _coder(shared.value, closing_id), defaultdict(int)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            sizes = np.cumsum(pc.binary_length(texts).to_numpy()) // _BATCH
            for part in np.unique(sizes):
                lo, hi = np.searchsorted(sizes, part, "left"), np.searchsorted(sizes, part, "right")
                coded = coder.encode(texts.slice(lo, hi - lo).to_numpy(zero_copy_only=False).tolist())
                out = []
                for doc_id, packed in zip(batch.column("doc_id").slice(lo, hi - lo).to_pylist(), coded):
                    total = len(packed) // 4
                    for start in range(0, total, limit):
                        piece = packed[4 * start : 4 * (start + limit)]
                        length = len(piece) // 4
                        out.append((doc_id, start, length, zlib.crc32(piece), total, turns[length], piece)[: len(columns)])
                        turns[length] += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def pack_histogram(histogram: dict[int, int], limit: int = LIMIT) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns and how often each occurs: every counted length is in exactly one place."""
    open_packs: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, count]
    rooms = np.zeros(limit + 1, dtype=bool)

    def put(room: int, pattern: tuple[int, ...], count: int) -> None:
        if count:
            open_packs[room].append([pattern, count])
            rooms[room] = True

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        if not 0 < length <= limit:
            raise ValueError(f"length {length} is not in 1..{limit}")
        while left:
            fitting = np.flatnonzero(rooms[length:])
            if not len(fitting):
                each = limit // length
                put(limit - each * length, (length,) * each, left // each)
                put(limit - left % each * length, (length,) * (left % each), int(left % each > 0))
                break
            room = length + int(fitting[-1])
            pattern, count = open_packs[room].pop()
            used = min(left, count)
            put(room, pattern, count - used)
            rooms[room] = bool(open_packs[room])
            put(room - length, (*pattern, length), used)
            left -= used
    return [(pattern, count) for room in sorted(open_packs) for pattern, count in open_packs[room]]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[Slot]:
    """(length, first rank, ranks, first sequence, offset), by length and rank."""
    found: list[Slot] = []
    next_rank, sequence = defaultdict(int), 0
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            found.append((length, next_rank[length], count, sequence, offset))
            next_rank[length] += count
            offset += length
        sequence += count
    return sorted(found)


def place(pieces: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces that carry ``task`` and ``turn``."""
    spark = pieces.sparkSession
    per_task = cut_lineage(pieces.groupBy("length", "task").count(), "packing-counts")
    histogram = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    table_of_slots = np.array(slots(pack_histogram(histogram, limit)), dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table_of_slots)  # bounded by the number of lengths

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    firsts = per_task.select("length", "task", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("first"))
    ranked = pieces.join(firsts, ["length", "task"]).withColumn("rank", F.col("first") + F.col("turn"))

    @F.pandas_udf("sequence_id long, offset long")
    def look_up(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = shared.value
        key = s[:, 0] << 48 | s[:, 1]
        at = s[np.searchsorted(key, length.to_numpy() << 48 | rank.to_numpy(), side="right") - 1]
        return pd.DataFrame({"sequence_id": at[:, 3] + rank.to_numpy() - at[:, 1], "offset": at[:, 4]})

    found = ranked.withColumn("place", look_up("length", "rank"))
    return found.select(*[c for c in pieces.columns if c not in ("task", "turn")], "place.sequence_id", "place.offset")


def pack(df: DataFrame, vocabulary: str, limit: int = LIMIT, closing_id: int = CLOSING_ID, keep_ids: bool = False) -> DataFrame:
    """One row per piece of every document (``doc_id``, ``text``): what it holds and where it goes.

    ``vocabulary`` is the tokenizer file's content. With ``keep_ids`` each piece carries its ids.
    """
    pieces = cut_pieces(df, vocabulary, limit, closing_id, keep_ids).withColumn("task", F.spark_partition_id())
    return place(cut_lineage(pieces, "packing-pieces"), limit)


def read_vocabulary(path: str | None = None) -> str:
    with open(path or public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        return file.read()


def op3_pack(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents in sequences of at most 4096 ids."""
    return pack(table(spark, sf_dir, "documents"), read_vocabulary(vocabulary))
