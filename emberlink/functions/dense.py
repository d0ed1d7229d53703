"""A dense text encoder: hashed n-gram TF-IDF, reduced to its main directions by a randomised range finder.

Counts are made a batch of texts at a time (:mod:`emberlink.functions.grams`); document frequencies are one row per
bucket, so at most ``width`` rows reach the driver. The counts are written once to the shared folder, as small whole
numbers; every pass makes the weights from them anew where it multiplies, which would take several times the texts on disk. Texts with many
buckets are multiplied as dense rows, others entry by entry. A pass multiplies them by a narrow matrix, takes the R factor of the product by a tall-skinny QR (one R a task,
merged in groups of ``FAN`` until one is left), and sums the transposed product by blocks of buckets, again in groups.
What the driver and every task hold is ``width`` by ``dims + oversample`` numbers, checked against ``MAX_BYTES``; nothing
there grows with the number of texts. The last pass gives the right singular vectors; a text's vector is its weights
times these, at length one.

Every text takes part in the fit. Null and empty texts are left out of the result, as in
:func:`emberlink.functions.encode.encode_hashed`. Repeated texts get equal vectors. No text at all gives empty frames.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from emberlink.functions.encode import count_once, inverse_frequencies
from emberlink.functions.grams import gram_counts
from emberlink.session import cut_lineage

MAX_BYTES = 64 << 20
FAN = 32  # factors or sums that are merged in one task
_ENTRIES = 1 << 16  # weights that are multiplied at a time
_NEAR = 1 << 12  # of them, in a core's cache
_DENSE = 12  # buckets for each one that a text has, up to which it is multiplied as a dense row
_BLOCK = 512  # buckets of a transposed product that travel as one row


def encode_dense(
    *frames: tuple[DataFrame, str], dims: int = 64, width: int = 1 << 14, n: int = 3,
    oversample: int = 8, passes: int = 2, seed: int = 11, out: str = "vector", keep_text: bool = True,
) -> list[DataFrame]:
    """Add a ``float`` vector of ``dims`` components to each ``(frame, text column)``; one fit over all frames.

    Where the weights have fewer directions than ``dims``, the other components are zero. Without ``keep_text``, the text
    is not written beside the counts.
    """
    held = width * (dims + oversample) * 8
    if held > MAX_BYTES:
        raise ValueError(f"width * (dims + oversample) takes {held} bytes, more than {MAX_BYTES}")
    counted = [count_once(df, text, gram_counts(text, n, width), "__grams", keep_text) for df, text in frames]
    idf = _idf([df.select("__grams") for df in counted], width)
    together = counted[0].select("__grams")
    for other in counted[1:]:
        together = together.unionByName(other.select("__grams"))
    axes = main_axes(together, width, dims, oversample, passes, seed, idf)
    return [_project(df, axes, out, idf) for df in counted]


def _idf(counted: Sequence[DataFrame], width: int) -> np.ndarray:
    return inverse_frequencies(counted, width, lambda grams: grams.flatten().field("bucket").to_numpy())


def _weights(starts: np.ndarray, buckets: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Count times inverse frequency, at length one a text."""
    weight = n * idf[buckets]
    filled = np.flatnonzero(np.diff(starts))
    length = np.ones(len(starts) - 1)
    length[filled] = np.sqrt(np.add.reduceat(weight * weight, starts[filled])) if len(filled) else 1.0
    return weight / np.repeat(np.where(length > 0, length, 1.0), np.diff(starts))


def tf_idf(counted: Iterable[DataFrame], width: int, grams: str = "__grams") -> list[DataFrame]:
    """``__at`` (buckets) and ``__weight`` (length one a row) from ``grams``; document frequencies are over all frames.

    The weight before scaling is count * ln((texts + 1) / (texts with the bucket + 1)); a bucket of every text weighs nothing.
    """
    counted = list(counted)
    idf = _idf([df.select(grams) for df in counted], width)

    @F.arrow_udf("array<double>")
    def weights(at: pa.Array, n: pa.Array) -> pa.Array:
        starts = at.offsets.to_numpy() - at.offsets[0].as_py()
        return pa.ListArray.from_arrays(starts, pa.array(_weights(starts, at.flatten().to_numpy(), n.flatten().to_numpy(), idf)))

    return [
        one.withColumn("__at", F.col(f"{grams}.bucket"))
        .withColumn("__weight", weights.asNondeterministic()("__at", F.col(f"{grams}.n")))
        .drop(grams)
        for one in counted
    ]


# ---- products of sparse rows ----------------------------------------------------------------


def _slices(batch: pa.RecordBatch, idf: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(row starts, buckets, weights)`` of some rows at a time; a row is never cut. With ``idf``, weights are made from the only column, counts."""
    if idf is None:
        at, weight = batch.column("__at"), batch.column("__weight")
        buckets, weights = at.flatten().to_numpy(), weight.flatten().to_numpy()
    else:
        at = batch.column(0)
        entries = at.flatten()
        buckets, weights = entries.field("bucket").to_numpy(), None
        counts = entries.field("n").to_numpy()
    offsets = at.offsets.to_numpy() - at.offsets[0].as_py()
    row = 0
    while row < len(batch):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _ENTRIES, side="right")) - 1)
        low, high = offsets[row], offsets[end]
        starts, some = offsets[row : end + 1] - low, buckets[low:high]
        yield starts, some, weights[low:high] if idf is None else _weights(starts, some, counts[low:high], idf)
        row = end


def _as_dense(starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, width: int) -> np.ndarray | None:
    """Rows with many buckets as a plain matrix; None for others."""
    rows = len(starts) - 1
    if rows * width > _DENSE * len(buckets):
        return None
    plain = np.zeros((rows, width))
    plain[np.repeat(np.arange(rows), np.diff(starts)), buckets] = weights
    return plain


def _times(starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, matrix: np.ndarray, plain: np.ndarray | None = None) -> np.ndarray:
    """Sparse rows times ``matrix``; ``plain``: the rows as a plain matrix, if there is one."""
    plain = _as_dense(starts, buckets, weights, len(matrix)) if plain is None else plain
    if plain is not None:
        return plain @ matrix
    product = np.zeros((len(starts) - 1, matrix.shape[1]))
    filled = np.flatnonzero(np.diff(starts))
    first, ends = starts[filled], starts[filled + 1]
    at = 0
    while at < len(filled):
        to = max(at + 1, int(np.searchsorted(ends, first[at] + _NEAR, side="right")))
        some = slice(first[at], ends[to - 1])
        product[filled[at:to]] = np.add.reduceat(matrix[buckets[some]] * weights[some, None], first[at:to] - first[at], axis=0)
        at = to
    return product


def _add_transposed(sums: np.ndarray, starts: np.ndarray, buckets: np.ndarray, weights: np.ndarray, matrix: np.ndarray) -> None:
    """Add the transposed rows times (the rows times ``matrix``) to ``sums``."""
    plain = _as_dense(starts, buckets, weights, len(matrix))
    product = _times(starts, buckets, weights, matrix, plain)
    if plain is not None:
        sums += plain.T @ product
        return
    row = np.repeat(np.arange(len(product)), np.diff(starts))
    order = np.argsort(buckets.astype(np.uint16) if len(matrix) <= 1 << 16 else buckets, kind="stable")
    for at in range(0, len(order), _NEAR):
        some = order[at : at + _NEAR]
        names = buckets[some]
        first = np.flatnonzero(np.concatenate([[True], names[1:] != names[:-1]]))
        sums[names[first]] += np.add.reduceat(product[row[some]] * weights[some, None], first, axis=0)


def _merged(df: DataFrame, key: str, fold, schema: str) -> DataFrame:
    """Rows with one ``no`` after another, folded per ``key`` in groups of ``FAN`` until each key has one row."""
    most = df.agg(F.max("no")).first()[0]
    while most:
        # Grouped by key and place: a task never holds more than FAN rows of a key at once.
        df = df.withColumn("no", F.expr(f"no div {FAN}")).groupBy(key, "no").applyInPandas(fold, schema)
        most //= FAN
        df = cut_lineage(df, "merge") if most else df
    return df


def _factor(rows: DataFrame, matrix: np.ndarray, idf: np.ndarray | None = None) -> np.ndarray:
    """R of the QR of ``rows`` times ``matrix``: square, whatever the number of rows."""
    size = matrix.shape[1]
    schema = "key int, no long, r binary"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = np.zeros((0, size))
        for batch in batches:
            for part in _slices(batch, idf):
                r = np.linalg.qr(np.vstack([r, _times(*part, matrix)]), mode="r")
        full = np.zeros((size, size))
        full[: len(r)] = r
        no = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"key": pa.array([0], pa.int32()), "no": pa.array([no], pa.int64()), "r": [full.tobytes()]})

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        stacked = np.vstack([np.frombuffer(r).reshape(size, size) for r in group.sort_values("r")["r"]])
        r = np.linalg.qr(stacked, mode="r")
        return pd.DataFrame({"key": [0], "no": [int(group["no"].iloc[0])], "r": [r.tobytes()]})

    factors = cut_lineage(rows.mapInArrow(local, schema), "factors")
    found = _merged(factors, "key", fold, schema).toPandas()
    return np.frombuffer(found["r"].iloc[0]).reshape(size, size) if len(found) else np.zeros((size, size))


def _transposed(rows: DataFrame, matrix: np.ndarray, idf: np.ndarray | None = None) -> np.ndarray:
    """Transposed ``rows`` times (``rows`` times ``matrix``)."""
    width, size = matrix.shape
    schema = "key int, no long, sums binary"

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        sums = np.zeros((width, size))
        for batch in batches:
            for part in _slices(batch, idf):
                _add_transposed(sums, *part, matrix)
        no = TaskContext.get().partitionId()
        for key in range(0, width, _BLOCK):
            block = sums[key : key + _BLOCK]
            yield pa.RecordBatch.from_pydict(
                {"key": pa.array([key], pa.int32()), "no": pa.array([no], pa.int64()), "sums": [block.tobytes()]}
            )

    def fold(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(s) for s in group.sort_values("sums")["sums"])
        return pd.DataFrame({"key": [int(group["key"].iloc[0])], "no": [int(group["no"].iloc[0])], "sums": [total.tobytes()]})

    blocks = cut_lineage(rows.mapInArrow(local, schema), "blocks")
    found = _merged(blocks, "key", fold, schema).toPandas()
    whole = np.zeros((width, size))
    for key, sums in zip(found["key"], found["sums"]):
        block = np.frombuffer(sums).reshape(-1, size)
        whole[key : key + len(block)] = block
    return whole


def main_axes(
    rows: DataFrame, width: int, dims: int, oversample: int = 8, passes: int = 2, seed: int = 11, idf: np.ndarray | None = None
) -> np.ndarray:
    """``width`` by ``dims``: the first right singular vectors of ``rows`` (``__at``, ``__weight``; with ``idf``, counts), the largest first.

    Each axis points to where its largest component is positive. Directions that the rows do not have are zero columns.
    """
    size = min(width, dims + oversample)
    matrix = np.random.default_rng(seed).standard_normal((width, size))
    found = np.zeros((width, size))
    for _ in range(max(passes, 1)):
        r = _factor(rows, matrix, idf)
        u, s, vt = np.linalg.svd(r)
        kept = s > (s[0] if len(s) else 0) * 1e-10
        # matrix @ back has rows @ (matrix @ back) orthonormal: Q of the tall product, which is never written.
        back = vt.T[:, kept] / s[kept]
        if not kept.any():
            return np.zeros((width, dims))
        found = _transposed(rows, matrix @ back, idf)
        matrix = np.linalg.qr(found)[0]
    axes, s, _ = np.linalg.svd(found, full_matrices=False)
    axes = axes[:, s > s[0] * 1e-10][:, :dims]
    turned = np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])])
    whole = np.zeros((width, dims))
    whole[:, : axes.shape[1]] = axes * turned
    return whole


def _project(df: DataFrame, axes: np.ndarray, out: str, idf: np.ndarray) -> DataFrame:
    """``out`` from ``__grams``; the other columns stay in the JVM."""
    dims = axes.shape[1]

    @F.arrow_udf("array<float>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for grams in batches:
            v = np.zeros((0, dims))
            if len(grams):
                v = np.vstack([_times(*part, axes) for part in _slices(pa.RecordBatch.from_arrays([grams], ["__grams"]), idf)])
            length = np.linalg.norm(v, axis=1, keepdims=True)
            unit = (v / np.where(length > 0, length, 1.0)).astype(np.float32)
            yield pa.ListArray.from_arrays(np.arange(len(unit) + 1, dtype=np.int32) * dims, unit.ravel())

    # Not written: a projection of what was written, and cheap beside it. Marked, so that filters do not project again.
    return df.withColumn(out, project.asNondeterministic()("__grams")).drop("__grams")
