"""A tagger for names that the gazetteer lacks: an averaged perceptron over begin, inside and outside tags.

It learns from sentences in which the gazetteer finds a name, and sees a word only through its shape and affixes and
through the words around it, never as a whole, so it can tell a name it has not met. Training runs in Spark: sentences are
dealt to shards of some ``SHARD`` characters by hash, each shard passes over its own from the weights all have agreed on, and the
results are averaged after every round (iterative parameter mixing), in groups of ``FAN``. The weights are ``ROWS`` hashed features by
tags, whatever the input. Tags of a sentence are the best path (Viterbi), computed for many sentences at a time; a pass looks
ahead, and what it has found beyond a sentence that changes the weights is found anew.

Training takes every different sentence with a name, whatever its length, but for those held out, which take part with ``whole``;
tagging reads every text whole. Null and empty texts have no names. A sentence longer than ``WINDOW`` words is learned and tagged in
windows. Repeated sentences count once in training, and a sentence and its copies are on one side of the held-out split.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from emberlink.operators.entities import GAZETTEER, entities
from emberlink.session import cut_lineage, scratch_scope

ROWS = 1 << 15
SHARD = 1 << 21  # characters of sentences that one task passes over
FAN = 8  # results of shards that are averaged in one task
WINDOW = 200
HELD_OUT = 5  # one sentence in so many, by crc32 of its text
KEPT = 200_000  # words whose scores a task keeps from one batch to the next
_TOGETHER = 512  # sentences that are decoded at a time
_AHEAD = 64  # windows that a pass looks ahead at most

_TOKEN = re.compile(r"[^\W_]+|[^\w\s]|_")
_SENTENCE = r"(?<=[.!?\n])\s+"

Words = list[tuple[str, int, int]]


def _row(feature: str) -> int:
    return zlib.crc32(feature.encode("utf-8", "replace")) % ROWS


_common_row = lru_cache(1 << 16)(_row)  # for features that many words share


@lru_cache(1 << 16)
def _mark(c: str) -> str:
    return "X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else c


@lru_cache(1 << 16)
def _squeezed(marks: str) -> str:
    return re.sub(r"(.)\1+", r"\1+", marks)


def _shape(word: str) -> str:
    return _squeezed("".join(map(_mark, word[:20])))


def _own(word: str) -> list[int]:
    low = word.lower()
    parts = [f"shape={_shape(word)}", f"long={min(len(word), 8)}"]
    parts += [f"end={low[-k:]}" for k in (1, 2, 3) if k < len(low)]
    parts += [f"start={low[:k]}" for k in (1, 2, 3) if k < len(low)]
    return [_common_row(p) for p in parts]


def _around(word: str, place: str) -> list[int]:
    return [_row(f"{place}={word.lower()}"), _common_row(f"{place}.shape={_shape(word)}")]


def _all_rows(word: str) -> list[list[int]]:
    """The rows of a word for each of ``_PLACES``."""
    low, shape = word.lower(), _shape(word)
    return [_own(word), *[[_row(f"{place}={low}"), _common_row(f"{place}.shape={shape}")] for place, _ in _PLACES[1:]]]


_PLACES = (("", 0), ("before2", -2), ("before", -1), ("after", 1))
_EDGE = ""


def features(words: Sequence[str]) -> list[list[int]]:
    """The weight rows that each word of a sentence takes part in."""
    found = []
    for i, word in enumerate(words):
        rows = _own(word)
        for place, step in _PLACES[1:]:
            j = i + step
            rows += _around(words[j] if 0 <= j < len(words) else _EDGE, place)
        found.append(rows)
    return found


def split_words(text: str) -> Iterator[Words]:
    """Sentences of a text as ``(word, start, end)``, none longer than ``WINDOW`` words."""
    start = 0
    for end in [*(m.end() for m in re.finditer(_SENTENCE, text)), len(text)]:
        words = [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(text, start, end)]
        for at in range(0, len(words), WINDOW):
            yield words[at : at + WINDOW]
        start = end


class Tags:
    """Outside is 0; label k begins as 1 + 2k and goes on as 2 + 2k."""

    def __init__(self, gazetteer: Mapping[str, Sequence[str]]):
        self.labels = list(gazetteer)
        self.count = 1 + 2 * len(self.labels)
        self.names: dict[str, list[tuple[tuple[str, ...], int]]] = {}
        for k, label in enumerate(self.labels):
            for name in gazetteer[label]:
                tokens = tuple(_TOKEN.findall(name))
                if tokens:
                    self.names.setdefault(tokens[0], []).append((tokens, k))
        for known in self.names.values():
            known.sort(key=lambda n: -len(n[0]))
        inside = np.arange(2, self.count, 2)
        self.barred = np.zeros((self.count + 1, self.count))
        self.barred[:, inside] = -np.inf  # the last row: before the first word
        self.barred[inside, inside] = 0
        self.barred[inside - 1, inside] = 0

    def known(self, words: Sequence[str]) -> np.ndarray:
        """Tags of the gazetteer's names, the longest first."""
        tags, i = np.zeros(len(words), dtype=np.int64), 0
        while i < len(words):
            for tokens, k in self.names.get(words[i], ()):
                if tuple(words[i : i + len(tokens)]) == tokens:
                    tags[i] = 1 + 2 * k
                    tags[i + 1 : i + len(tokens)] = 2 + 2 * k
                    i += len(tokens) - 1
                    break
            i += 1
        return tags

    def spans(self, tags: Sequence[int]) -> list[tuple[int, int, int]]:
        """``(first word, last word + 1, label)``."""
        found: list[tuple[int, int, int]] = []
        for i, tag in enumerate(tags):
            if tag % 2:
                found.append((i, i + 1, tag // 2))
            elif tag:
                first, _, k = found[-1]
                found[-1] = (first, i + 1, k)
        return found


def best_paths(scores: np.ndarray, lengths: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """The path of tags with the highest sum for each of many sentences; the lower tag wins ties, from the end on.

    ``scores``: sentence, word, tag. ``steps``: from tag (the last row: from the start), to tag.
    """
    n, longest, tags = scores.shape
    value = scores[:, 0] + steps[-1]
    came = np.zeros((longest, n, tags), dtype=np.int64)
    stay = np.arange(tags)
    for i in range(1, longest):
        ways = value[:, :, None] + steps[None, :-1]
        on = (lengths > i)[:, None]
        came[i] = np.where(on, ways.argmax(axis=1), stay)
        value = np.where(on, ways.max(axis=1) + scores[:, i], value)
    paths = np.zeros((n, longest), dtype=np.int64)
    paths[:, -1] = value.argmax(axis=1)
    for i in range(longest - 1, 0, -1):
        paths[:, i - 1] = came[i][np.arange(n), paths[:, i]]
    return paths


class Adds:
    """What a word adds to the scores at each place, summed up once for each different word and kept for later batches."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.ids: dict[str, int] = {}
        self.tables = [np.zeros((0, weights.shape[1])) for _ in _PLACES]

    def know(self, sentences: Iterable[Sequence[str]]) -> None:
        """Give an id to every word, from 0 for the edge; beyond ``KEPT`` words all are forgotten first."""
        if not self.ids or len(self.ids) > KEPT:
            self.ids, self.tables = {_EDGE: 0}, [t[:0] for t in self.tables]
        for words in sentences:
            for word in words:
                self.ids.setdefault(word, len(self.ids))
        new = list(itertools.islice(self.ids, len(self.tables[0]), None))
        more: list[list[np.ndarray]] = [[] for _ in _PLACES]
        for at in range(0, len(new), _TOGETHER * 8):
            for found, rows in zip(more, zip(*map(_all_rows, new[at : at + _TOGETHER * 8]))):
                starts = np.cumsum([0, *map(len, rows[:-1])])
                found.append(np.add.reduceat(self.weights[np.fromiter(itertools.chain.from_iterable(rows), np.int64)], starts, axis=0))
        self.tables = [np.concatenate([t, *m]) for t, m in zip(self.tables, more)]


def _decode(sentences: list[list[str]], weights: np.ndarray, barred: np.ndarray, adds: Adds | None = None) -> list[np.ndarray]:
    """Tags for each sentence."""
    found: list[np.ndarray] = [np.zeros(0, dtype=np.int64)] * len(sentences)
    adds = adds or Adds(weights)
    adds.know(sentences)
    vocabulary, tags = adds.ids, weights.shape[1]
    steps = weights[ROWS:] + barred
    order = sorted((i for i, s in enumerate(sentences) if s), key=lambda i: len(sentences[i]))
    for at in range(0, len(order), _TOGETHER):
        some = order[at : at + _TOGETHER]
        lengths = np.array([len(sentences[i]) for i in some])
        longest = lengths[-1]
        ids = np.zeros((len(some), longest + 3), dtype=np.int64)
        for row, i in enumerate(some):
            ids[row, 2 : 2 + lengths[row]] = [vocabulary[w] for w in sentences[i]]
        scores = np.zeros((len(some), longest, tags))
        for table, (_, step) in zip(adds.tables, _PLACES):
            scores += table[ids[:, 2 + step : 2 + step + longest]]
        for row, (i, path) in enumerate(zip(some, best_paths(scores, lengths, steps))):
            found[i] = path[: lengths[row]]
    return found


# ---- training -------------------------------------------------------------------------------


def sentences_with_names(df: DataFrame, text: str | Column, gazetteer: Mapping[str, Sequence[str]]) -> DataFrame:
    """Different sentences in which the gazetteer finds a name, and whether they are ``held_out``."""
    text = F.col(text) if isinstance(text, str) else text
    split = df.select(F.explode(F.split(text, _SENTENCE)).alias("sentence"))
    named = split.where(F.size(entities("sentence", gazetteer)) > 0)
    return named.groupBy("sentence").agg(F.lit(1).alias("__one")).select(
        "sentence", (F.crc32("sentence") % HELD_OUT == 0).alias("held_out")
    )


class Shard:
    """Sentences as numbers: the words of all windows in a row, the rows of each different word, the wanted tags."""

    #: How many rows a word takes part in at each place; a word with fewer has ``-1`` in their stead.
    _WIDE = (8, 2, 2, 2)

    def __init__(self, ids: np.ndarray, want: np.ndarray, lengths: np.ndarray, table: np.ndarray, orders: np.ndarray):
        self.ids, self.want, self.lengths, self.table, self.orders = ids, want, lengths, table, orders

    @classmethod
    def of(cls, sentences: Sequence[str], tags: Tags, rounds: int) -> Shard:
        known = {_EDGE: 0}
        ids, want, lengths, first = [], [], [], []
        for sentence in sentences:
            first.append(len(lengths))
            for tokens in split_words(sentence):
                if tokens:
                    words = [t[0] for t in tokens]
                    ids.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
                    want.append(tags.known(words).astype(np.int8))
                    lengths.append(len(words))
        table = np.full((len(known), sum(cls._WIDE)), -1, dtype=np.int32)
        for rows, word in zip(table, known):
            at = 0
            for wide, found in zip(cls._WIDE, _all_rows(word)):
                rows[at : at + len(found)] = found
                at += wide
        first.append(len(lengths))
        orders = []
        for turn in range(rounds):
            places = sorted(range(len(sentences)), key=lambda i: (zlib.crc32(f"{turn}:{sentences[i]}".encode("utf-8", "replace")), sentences[i]))
            orders.append([w for i in places for w in range(first[i], first[i + 1])])
        none = [np.zeros(0, np.int32)]
        return cls(
            np.concatenate(ids or none).astype(np.int32), np.concatenate(want or none).astype(np.int8), np.array(lengths, np.int32),
            table, np.array(orders, np.int32).reshape(rounds, -1),
        )

    def pack(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() for name in ("ids", "want", "lengths", "table", "orders")}

    @classmethod
    def unpack(cls, row, rounds: int) -> Shard:
        ids, lengths, table, orders = (np.frombuffer(getattr(row, n), np.int32) for n in ("ids", "lengths", "table", "orders"))
        return cls(ids, np.frombuffer(row.want, np.int8), lengths, table.reshape(-1, sum(cls._WIDE)), orders.reshape(rounds, -1))

    def turn(self, no: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of weights and wanted tag of each word, and where each window begins (and the last ends), in the order of a round."""
        lengths = self.lengths[self.orders[no]].astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)])
        from_ = (np.cumsum(self.lengths, dtype=np.int64) - self.lengths)[self.orders[no]]
        place = np.arange(starts[-1]) - np.repeat(starts[:-1], lengths)
        ids = self.ids[np.repeat(from_, lengths) + place]
        left = np.repeat(lengths, lengths) - place
        rows, at = [], 0
        for wide, (_, step) in zip(self._WIDE, _PLACES):
            there = (place + step >= 0) & (left > step)
            near = np.where(there, ids[np.clip(np.arange(len(ids)) + step, 0, max(len(ids) - 1, 0))], 0)
            rows.append(self.table[near, at : at + wide])
            at += wide
        return np.concatenate(rows, axis=1), self.want[np.repeat(from_, lengths) + place].astype(np.int64), starts


def _pass(weights: np.ndarray, rows: np.ndarray, want: np.ndarray, starts: np.ndarray, tags: Tags) -> tuple[np.ndarray, np.ndarray]:
    """One pass of the perceptron, one window after another: the weights at its end, and their mean over the pass."""
    # The last row stands for features that a word lacks, and stays zero.
    w = np.concatenate([weights, np.zeros((1, tags.count))])
    late = np.zeros_like(w)
    seen, block, windows = 0, 1, len(starts) - 1
    while seen < windows:
        end = min(seen + block, windows)
        part, lengths = slice(starts[seen], starts[end]), np.diff(starts[seen : end + 1])
        window = np.repeat(np.arange(end - seen), lengths)
        place = np.arange(starts[seen], starts[end]) - np.repeat(starts[seen:end], lengths)
        scores = np.zeros((end - seen, lengths.max(), tags.count))
        scores[window, place] = w[rows[part]].sum(axis=1)
        have = best_paths(scores, lengths, w[ROWS:-1] + tags.barred)[window, place]
        wrong = np.flatnonzero(have != want[part])
        if not len(wrong):
            seen, block = end, min(2 * block, _AHEAD)
            continue
        # All before the first wrong window have been found with the weights of their turn.
        first = window[wrong[0]]
        seen, block = seen + first, max(1, min(2 * int(first) + 1, _AHEAD))
        _learn(w, late, seen, rows[starts[seen] : starts[seen + 1]], want[starts[seen] : starts[seen + 1]], have[window == first], tags)
        seen += 1
    return w[:-1], (w - late / max(windows, 1))[:-1]


def _learn(w: np.ndarray, late: np.ndarray, seen: int, rows: np.ndarray, good: np.ndarray, bad: np.ndarray, tags: Tags) -> None:
    """Towards the wanted tags of a window and away from those it got; ``late`` keeps what the mean lacks."""
    before = ROWS + np.concatenate([[[tags.count], [tags.count]], np.stack([good[:-1], bad[:-1]])], axis=1)
    own = good != bad
    steps = own | (before[0] != before[1])
    for target, by in ((w, 1.0), (late, float(seen))):
        for tag, came, sign in ((good, before[0], by), (bad, before[1], -by)):
            np.add.at(target, (rows[own], tag[own, None]), sign)
            np.add.at(target, (came[steps], tag[steps]), sign)
        target[-1] = 0.0


_PARTS = "shard int, n long, last binary, mean binary"


def _average(parts: pd.DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """How many sentences, and both weights averaged by sentences, as flat arrays."""
    parts = parts.sort_values(["n", "last"])
    share = parts["n"] / parts["n"].sum()
    return (int(parts["n"].sum()), *(sum(p * np.frombuffer(b) for p, b in zip(share, parts[c])) for c in ("last", "mean")))


def _fold(group: pd.DataFrame) -> pd.DataFrame:
    n, last, mean = _average(group)
    return pd.DataFrame({"shard": [int(group["shard"].iloc[0])], "n": [n], "last": [last.tobytes()], "mean": [mean.tobytes()]})


def train(
    df: DataFrame, text: str | Column, gazetteer: Mapping[str, Sequence[str]] = GAZETTEER,
    rounds: int = 4, shards: int = 8, whole: bool = False,
) -> np.ndarray:
    """Weights learned from the sentences that are not held out, with ``whole`` from all; all zero when there are none.

    There are ``shards`` shards, and more where they would hold more than ``SHARD`` characters.
    """
    with scratch_scope(df.sparkSession):
        return _train(sentences_with_names(df, text, gazetteer), Tags(gazetteer), rounds, shards, whole)


def _train(named: DataFrame, tags: Tags, rounds: int, shards: int, whole: bool) -> np.ndarray:
    fit = cut_lineage(named.select("sentence") if whole else named.where(~F.col("held_out")).select("sentence"), "sentences", free=True)
    size = fit.agg(F.sum(F.length("sentence").cast("long"))).first()[0]
    weights = np.zeros((ROWS + tags.count + 1, tags.count))
    if size is None:
        return weights
    shards = max(shards, -(-size // SHARD))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sentences = [s for batch in batches for s in batch["sentence"]]
        if sentences:
            from pyspark import TaskContext

            packed = Shard.of(sentences, tags, rounds).pack()
            yield pd.DataFrame({"shard": [TaskContext.get().partitionId()], "n": [len(sentences)], **{k: [v] for k, v in packed.items()}})

    # By number, so that a task has one shard.
    dealt = fit.repartitionById(shards, F.pmod(F.xxhash64("sentence"), F.lit(shards)).cast("int"))
    numbers = dealt.mapInPandas(deal, "shard int, n long, ids binary, want binary, lengths binary, table binary, orders binary")
    numbers = cut_lineage(numbers, "shards", free=True)
    means = []
    for turn in range(rounds):
        parts = cut_lineage(numbers.mapInPandas(_round(weights, turn, rounds, tags), _PARTS), "round")
        groups = shards
        while groups > FAN:
            grouped = parts.withColumn("shard", F.expr(f"shard div {FAN}").cast("int")).groupBy("shard")
            parts = cut_lineage(grouped.applyInPandas(_fold, _PARTS), "mixed", free=True)
            groups = -(-groups // FAN)
        _, last, mean = _average(parts.toPandas())
        weights = last.reshape(weights.shape)
        means.append(mean.reshape(weights.shape))
    return np.mean(means, axis=0)


def _round(weights: np.ndarray, turn: int, rounds: int, tags: Tags) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                last, mean = _pass(weights, *Shard.unpack(row, rounds).turn(turn), tags)
                yield pd.DataFrame({"shard": [row.shard], "n": [row.n], "last": [last.tobytes()], "mean": [mean.tobytes()]})

    return run


# ---- tagging --------------------------------------------------------------------------------


def make_tagger(weights: np.ndarray, gazetteer: Mapping[str, Sequence[str]] = GAZETTEER) -> Callable[[], Callable]:
    """For ``extract_entities``: a tagger from texts to ``(name, label)`` in order of occurrence.

    A name of the gazetteer keeps the gazetteer's label; the trained tags speak where it finds nothing.
    """
    tags = Tags(gazetteer)

    def make():
        adds = Adds(weights)

        def tag(texts: Sequence[str]) -> list[list[tuple[str, str]]]:
            cut = [(no, words) for no, text in enumerate(texts) for words in split_words(text or "")]
            plain = [[w[0] for w in words] for _, words in cut]
            found: list[list[tuple[str, str]]] = [[] for _ in texts]
            for (no, words), flat, path in zip(cut, plain, _decode(plain, weights, tags.barred, adds)):
                sure = tags.spans(tags.known(flat))
                taken = {i for first, end, _ in sure for i in range(first, end)}
                more = [s for s in tags.spans(path) if taken.isdisjoint(range(s[0], s[1]))]
                for first, end, k in sorted(sure + more):
                    found[no].append((texts[no][words[first][1] : words[end - 1][2]], tags.labels[k]))
            return found

        return tag

    return make


def held_out_scores(df: DataFrame, text: str | Column, weights: np.ndarray, gazetteer: Mapping[str, Sequence[str]] = GAZETTEER) -> DataFrame:
    """Per label, over all held-out sentences: spans of the gazetteer (``names``), of the tags alone (``found``), in both (``right``), and F1."""
    tags = Tags(gazetteer)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            cut = [[w[0] for w in words] for s in batch["sentence"] for words in split_words(s)]
            sums = np.zeros((3, len(tags.labels)), dtype=np.int64)
            for words, path in zip(cut, _decode(cut, weights, tags.barred)):
                want, have = set(tags.spans(tags.known(words))), set(tags.spans(path))
                for row, spans in zip(sums, (want, have, want & have)):
                    for span in spans:
                        row[span[2]] += 1
            yield pd.DataFrame({"label": tags.labels, "names": sums[0], "found": sums[1], "right": sums[2]})

    held_out = sentences_with_names(df, text, gazetteer).where("held_out").select("sentence")
    counted = held_out.mapInPandas(count, "label string, names long, found long, right long")
    f1 = F.when(F.col("names") + F.col("found") > 0, 2 * F.col("right") / (F.col("names") + F.col("found")))
    return counted.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("names", "found", "right")]).withColumn("f1", F.round(f1, 4))
