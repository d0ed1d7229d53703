"""Text vectors: a built-in hashed n-gram encoder, and a hook for a model of the user's own."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from emberlink.functions.grams import dense_counts
from emberlink.session import cut_lineage

Encoder = Callable[[Sequence[str]], Sequence[Sequence[float]]]


def encode_hashed(
    *frames: tuple[DataFrame, str], width: int = 256, n: int = 3, out: str = "vector", keep_text: bool = True
) -> list[DataFrame]:
    """Add a TF-IDF vector of hashed character n-grams to each ``(frame, text column)``.

    The document frequencies are taken over all the frames, so their vectors compare. Texts are read and counted
    once: the frames are written with their counts to the shared folder, without ``keep_text`` all but the text.
    """
    counted = [count_once(df, text, dense_counts(text, n, width), "__counts", keep_text) for df, text in frames]
    idf = inverse_frequencies([df.select("__counts") for df in counted], width, _present)

    @F.arrow_udf("array<float>")
    def weigh(counts: pa.Array) -> pa.Array:
        weights = counts.flatten().to_numpy().reshape(len(counts), width) * idf
        length = np.sqrt((weights * weights).sum(axis=1, keepdims=True))
        unit = (weights / np.where(length > 0, length, 1.0)).astype(np.float32)
        return pa.ListArray.from_arrays(np.arange(len(unit) + 1, dtype=np.int32) * width, unit.ravel())

    return [df.withColumn(out, weigh.asNondeterministic()("__counts")).drop("__counts") for df in counted]


def _present(counts: pa.Array) -> np.ndarray:
    """The bucket of every count that is not zero."""
    found = counts.flatten().to_numpy()
    return np.flatnonzero(found) % (len(found) // len(counts))


def inverse_frequencies(counted: Sequence[DataFrame], width: int, present: Callable[[pa.Array], np.ndarray]) -> np.ndarray:
    """ln((texts + 1) / (texts with the bucket + 1)) of each bucket, over the only column of all frames.

    ``present`` gives the buckets that a batch of texts has, once for each text. A task leaves one row.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, seen = 0, np.zeros(width, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                texts += batch.num_rows
                seen += np.bincount(present(batch.column(0)), minlength=width)
        yield pa.RecordBatch.from_pydict({"texts": pa.array([texts], pa.int64()), "seen": pa.array([seen.tolist()], pa.list_(pa.int64()))})

    texts, seen = 0, np.zeros(width, dtype=np.int64)
    for df in counted:
        parts = df.mapInArrow(count, "texts long, seen array<long>")
        one = parts.select("texts", F.posexplode("seen").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))
        for bucket, n, m in one.toPandas().itertuples(index=False):
            seen[bucket] += n
            texts += m if bucket == 0 else 0
    return np.log((texts + 1) / (seen + 1))


def count_once(df: DataFrame, text: str, counts: Column, name: str, keep_text: bool) -> DataFrame:
    """Rows with a text and their ``counts``, written and read back."""
    counted = df.where(F.length(F.col(text)) > 0).withColumn(name, counts)
    return cut_lineage(counted if keep_text else counted.drop(text), name.strip("_"))


def encode_with(df: DataFrame, text: str, make_encoder: Callable[[], Encoder], out: str = "vector") -> DataFrame:
    """Vectors from a user's model; ``make_encoder`` loads it once per task."""

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = make_encoder()
        for texts in batches:
            yield pd.Series([list(map(float, v)) for v in encoder(texts.tolist())])

    return df.where(F.length(F.col(text)) > 0).withColumn(out, run(F.col(text)))
