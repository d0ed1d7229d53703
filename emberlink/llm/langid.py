"""Language of a text by a bidirectional gated recurrent network over bytes.

The network reads each run of letters (lower case, UTF-8) byte by byte in both directions and
gives every byte position a probability for each language; a document's probabilities are the
means over all positions of its whole text. State starts anew at each run of letters. So a run's
sum of position probabilities depends on the run alone, and a task computes it once for each
distinct run it meets; every occurrence counts.

Training is plain numpy: backpropagation through time with Adam, from a fixed seed. It uses a
bounded sample of labelled rows: ``SAMPLE_DOCS`` documents of each language, those with the
smallest hash of their id and text, and of these the ``SAMPLE_RUNS`` most frequent runs of each
language, counted over whole texts. More labelled rows do not make training cost more.

Defined results: a null text, or one without a letter, is ``und`` with score 0. Without a single
labelled row, every text is ``und``. Ties go to the first language in alphabetical order.
Repeated rows are judged alike, and columns that are not asked for are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from emberlink.llm.common import fresh, table
from emberlink.llm.memo import Memo

UNDETERMINED = "und"
SAMPLE_DOCS = 300
SAMPLE_RUNS = 3000
WIDTH = 16  # of the byte embedding and of each direction's state
EPOCHS = 8
BATCH = 256
LONGEST = 32  # bytes the network reads at once; longer runs are cut there
REMEMBERED_BYTES = 48_000_000  # of distinct runs a task keeps; beyond that it starts anew, with the same results
_TOGETHER = 2_000_000  # characters of text whose runs are learned at once
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
#: A filter's threshold: long texts of random letters score 0.3 to 0.4, documents that mix two languages 0.44 and more,
#: others 0.55 and more. A mean over few letters strays, by some ``STRAY`` over the root of their number.
MIN_SCORE = 0.42
STRAY = 0.5
_SEED = 7


@dataclass
class Model:
    """Weights of the network and the languages of its outputs."""

    languages: list[str]
    weights: dict[str, np.ndarray]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


def _start(n_languages: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(_SEED)
    draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"embed": draw(256, WIDTH) * 4, "out": draw(2 * WIDTH, n_languages), "out_b": np.zeros(n_languages, np.float32)}
    for d in "fb":
        w |= {f"{d}_in": draw(WIDTH, 3 * WIDTH), f"{d}_state": draw(WIDTH, 3 * WIDTH), f"{d}_bias": np.zeros(3 * WIDTH, np.float32)}
    return w


def pad(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes as (time, run), and which of them are there."""
    lengths = np.array([len(r) for r in runs])
    grid = np.zeros((len(runs), int(lengths.max(initial=0))), dtype=np.uint8)
    there = np.arange(grid.shape[1])[None, :] < lengths[:, None]
    grid[there] = np.frombuffer(b"".join(runs), dtype=np.uint8)
    return grid.T, there.T


def _walk(w: dict[str, np.ndarray], d: str, x: np.ndarray, there: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """One direction's states after each byte; positions that are not there pass the state on."""
    steps, n = there.shape
    gates_in = x @ w[f"{d}_in"] + w[f"{d}_bias"]
    h = np.zeros((n, WIDTH), np.float32)
    states, tape = np.empty((steps, n, WIDTH), np.float32), []
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        s = h @ w[f"{d}_state"]
        zr = _sigmoid(gates_in[t, :, : 2 * WIDTH] + s[:, : 2 * WIDTH])
        z, r = zr[:, :WIDTH], zr[:, WIDTH:]
        c = np.tanh(gates_in[t, :, 2 * WIDTH :] + r * s[:, 2 * WIDTH :])
        live = there[t][:, None]
        new = np.where(live, h + z * (c - h), h)
        if keep:
            tape.append((t, h, s, z, r, c, live))
        states[t] = h = new
    return states, tape


def _probabilities(w: dict[str, np.ndarray], states: np.ndarray) -> np.ndarray:
    logits = states @ w["out"] + w["out_b"]
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def label_positions(model: Model, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Language probabilities of every byte, as (time, run, language), and which bytes are there."""
    grid, there = pad(runs)
    x = model.weights["embed"][grid]
    states = np.concatenate([_walk(model.weights, d, x, there, False)[0] for d in "fb"], axis=2)
    return _probabilities(model.weights, states), there


def loss_and_gradient(w: dict[str, np.ndarray], grid: np.ndarray, there: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Weighted cross-entropy over positions, and its gradient through time."""
    x = w["embed"][grid]
    walks = {d: _walk(w, d, x, there, True) for d in "fb"}
    both = np.concatenate([walks[d][0] for d in "fb"], axis=2)
    p = _probabilities(w, both)
    mass = (there * weight[None, :] / (there * weight[None, :]).sum()).astype(np.float32)[:, :, None]
    loss = -float((mass * target[None] * np.log(p + 1e-9)).sum())
    d_logits = mass * (p - target[None])
    flat = lambda a: a.reshape(-1, a.shape[-1])
    g = {"out": flat(both).T @ flat(d_logits), "out_b": flat(d_logits).sum(axis=0)}
    d_both, d_x = d_logits @ w["out"].T, np.zeros_like(x)
    for k, d in enumerate("fb"):
        d_states, d_in = d_both[:, :, k * WIDTH : (k + 1) * WIDTH], np.zeros((*grid.shape, 3 * WIDTH), np.float32)
        d_h, d_w = np.zeros((grid.shape[1], WIDTH), np.float32), np.zeros_like(w[f"{d}_state"])
        for t, h, s, z, r, c, live in reversed(walks[d][1]):
            up = d_h + d_states[t]
            on = up * live
            d_c = on * z * (1 - c * c)
            d_z = on * (c - h) * z * (1 - z)
            d_r = d_c * s[:, 2 * WIDTH :] * r * (1 - r)
            d_s = np.concatenate([d_z, d_r, d_c * r], axis=1)
            d_in[t] = np.concatenate([d_z, d_r, d_c], axis=1)
            d_w += h.T @ d_s
            d_h = np.where(live, on * (1 - z), up) + d_s @ w[f"{d}_state"].T
        g |= {f"{d}_in": flat(x).T @ flat(d_in), f"{d}_state": d_w, f"{d}_bias": flat(d_in).sum(axis=0)}
        d_x += d_in @ w[f"{d}_in"].T
    g["embed"] = np.zeros_like(w["embed"])
    np.add.at(g["embed"], grid.ravel(), flat(d_x * there[:, :, None]))
    return loss, g


def train(counts: dict[str, dict[bytes, int]], epochs: int = EPOCHS) -> Model:
    """Fit the network to each language's runs of letters and their counts."""
    languages = sorted(counts)
    # What is read at once is what is learned: runs in the parts that labelling cuts them into.
    by_part: dict[str, Counter[bytes]] = {l: Counter() for l in languages}
    for l in languages:
        for run, n in counts[l].items():
            for part in pieces(run):
                by_part[l][part] += n
    runs = sorted({r for of in by_part.values() for r in of})
    share = np.array([[by_part[l][r] / sum(counts[l].values()) for l in languages] for r in runs], dtype=np.float32)
    model = Model(languages, _start(len(languages)))
    w = model.weights
    target, weight = share / share.sum(axis=1, keepdims=True), np.sqrt(share.sum(axis=1))
    # Runs of like length share a batch, so little of it is padding.
    by_length = np.argsort([len(r) for r in runs], kind="stable")
    batches = [by_length[i : i + BATCH] for i in range(0, len(runs), BATCH)]
    padded = [pad([runs[i] for i in b]) for b in batches]
    mean, square, step = {k: np.zeros_like(v) for k, v in w.items()}, {k: np.zeros_like(v) for k, v in w.items()}, 0
    rng = np.random.default_rng(_SEED)
    for epoch in range(epochs):
        rate = 0.02 * (1 - epoch / epochs)
        for i in rng.permutation(len(batches)):
            _, g = loss_and_gradient(w, *padded[i], target[batches[i]], weight[batches[i]])
            norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            step += 1
            for k in w:
                v = g[k] * min(1.0, 1.0 / (norm + 1e-9))
                mean[k] = 0.9 * mean[k] + 0.1 * v
                square[k] = 0.99 * square[k] + 0.01 * v * v
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
    return model


def pieces(run: bytes) -> list[bytes]:
    """A run in parts of at most ``LONGEST`` bytes, which are read one by one."""
    return [run[k : k + LONGEST] for k in range(0, len(run), LONGEST)]


class Labeller:
    """Pools a network's position probabilities over documents."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.memo = Memo(REMEMBERED_BYTES, 4 * (len(model.languages) + 1))
        self.sums = np.empty((0, len(model.languages) + 1), np.float32)  # by run; the last column counts positions

    def _learn(self, runs: list[str]) -> None:
        parts = [(i, p) for i, r in enumerate(runs) for p in pieces(r.encode("utf-8"))]
        sums = np.zeros((len(runs), self.sums.shape[1]), np.float32)
        order = np.argsort([len(p) for _, p in parts], kind="stable")
        for start in range(0, len(order), 2048):
            picked = [parts[i] for i in order[start : start + 2048]]
            p, there = label_positions(self.model, [c for _, c in picked])
            owners = np.array([i for i, _ in picked])
            np.add.at(sums[:, :-1], owners, (p * there[:, :, None]).sum(axis=0))
            np.add.at(sums[:, -1], owners, there.sum(axis=0))
        self.memo.add(runs)
        self.sums = np.concatenate([self.sums, sums])

    def label(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        languages, scores, _ = self.judge(texts)
        return languages, scores

    def judge(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and number of positions of each text."""
        positions = np.zeros(len(texts), np.int64)
        if not self.model.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), positions
        if self.memo.full:
            self.memo.clear()
            self.sums = self.sums[:0]
        counted = [Counter(_LETTERS.findall(t.lower())) if t else Counter() for t in texts]
        new = list(set().union(*counted).difference(self.memo.place))
        if new:
            self._learn(new)
        languages, scores = [], np.zeros(len(texts))
        for i, counts in enumerate(counted):
            if not counts:
                languages.append(UNDETERMINED)
                continue
            at = np.fromiter(map(self.memo.place.__getitem__, counts), np.int64, len(counts))
            times = np.fromiter(counts.values(), np.float64, len(counts))
            pooled = times @ self.sums[at]
            best = int(np.argmax(pooled[:-1]))
            languages.append(self.model.languages[best])
            scores[i] = min(1.0, pooled[best] / pooled[-1])
            positions[i] = pooled[-1]
        return languages, scores, positions


def sample_counts(labelled: DataFrame, docs: int = SAMPLE_DOCS, runs: int = SAMPLE_RUNS) -> dict[str, dict[bytes, int]]:
    """Counts of frequent letter runs by language, from a bounded sample of (``text``, ``lang``).

    The rows of a language with the smallest hashes are found without moving texts; only theirs
    are then split, over their whole length.
    """
    keyed = labelled.where("lang is not null and text is not null").withColumn("pick", F.xxhash64("doc_id", "text"))
    order = Window.partitionBy("lang").orderBy("pick")
    picked = keyed.select("lang", "pick").withColumn("n", F.row_number().over(order)).where(F.col("n") <= docs)
    # At most ``docs`` rows a language: small enough for every task.
    chosen = keyed.join(F.broadcast(picked.select("lang", "pick").distinct()), ["lang", "pick"])
    words = chosen.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}[\p{L}\p{M}]*)"))).alias("run"))
    counted = words.groupBy("lang", "run").count()
    top = Window.partitionBy("lang").orderBy(F.desc("count"), "run")
    found: dict[str, dict[bytes, int]] = {}
    for row in counted.withColumn("n", F.row_number().over(top)).where(F.col("n") <= runs).collect():
        found.setdefault(row["lang"], {})[row["run"].encode("utf-8")] = row["count"]
    return found


def train_on(labelled: DataFrame) -> Model:
    """Train on a sample of a table with ``doc_id``, ``text`` and ``lang``."""
    counts = sample_counts(labelled)
    return train(counts) if counts else Model([], {})


def predict(df: DataFrame, model: Model, text_col: str = "text", lang_col: str = "lang_pred", score_col: str = "score", positions_col: str | None = None) -> DataFrame:
    """Add the predicted language, its mean probability over all letters of the text, and how many bytes these are."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # a few thousand numbers

    @F.pandas_udf("language string, score double, positions long")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = _labeller(shared.value)
        for batch in batches:
            texts = list(batch)
            weight = np.cumsum([len(t) if t else 1 for t in texts]) // _TOGETHER
            cuts = [0, *np.flatnonzero(np.diff(weight)) + 1, len(texts)]
            parts = [labeller.judge(texts[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]
            scores, positions = (np.concatenate([np.zeros(0), *[p[k] for p in parts]]) for k in (1, 2))
            yield pd.DataFrame({"language": pd.Series([l for p in parts for l in p[0]], dtype=object), "score": scores, "positions": positions.astype(np.int64)})

    found = fresh(df.columns, "found")
    added = df.withColumn(found, label.asNondeterministic()(F.col(text_col)))
    values = {lang_col: F.col(found)["language"], score_col: F.col(found)["score"]}
    if positions_col:
        values[positions_col] = F.col(found)["positions"]
    return added.withColumns(values).drop(found)


_LABELLERS: dict[tuple, Labeller] = {}


def _labeller(model: Model) -> Labeller:
    """A worker's labeller for one model, with the runs it has met in earlier tasks."""
    key = (*model.languages, *(w.tobytes() for w in model.weights.values()))
    if key not in _LABELLERS:
        _LABELLERS.clear()
        _LABELLERS[key] = Labeller(model)
    return _LABELLERS[key]


def held_out(doc_id: Column) -> Column:
    """The fold that training never sees: crc32 of the id as text, divisible by 5."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def keep_known(docs: DataFrame, min_score: float = MIN_SCORE, stray: float = STRAY) -> DataFrame:
    """A filter: documents whose language the network can tell, with the columns they came with.

    What goes: texts without a letter, and those whose best language scores below ``min_score`` by more than chance
    explains, such as garbled text. The network knows nothing but the languages it was trained on: texts in
    another script or a related language may well score high, and stay.
    """
    lang, score, positions = (fresh(docs.columns, c) for c in ("lang_pred", "lang_score", "lang_positions"))
    told = predict(docs, train_on(docs.where(~held_out(F.col("doc_id")))), "text", lang, score, positions)
    known = F.col(score) + stray / F.sqrt(F.greatest(F.col(positions), F.lit(1))) >= min_score
    return told.where((F.col(lang) != UNDETERMINED) & known).select(*docs.columns)


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text of ``documents``, learned from four fifths of its labels."""
    docs = table(spark, sf_dir, "documents")
    model = train_on(docs.where(~held_out(F.col("doc_id"))))
    texts = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(texts, model).select("doc_id", "held_out", "lang_pred", "score")
