"""Nearest neighbours by inner product over randomly rotated one-bit codes.

Each vector, less the mean of all, is turned by one random rotation and keeps the signs of its
components, packed to bits, and three numbers: its length, how well the code matches it, and its
product with the mean. From these an inner product with a query is estimated without bias, and an
error bound goes with it. A tile takes every vector whose upper bound reaches the ``k``-th best
lower bound, and scores those on the original vectors in double precision.

The mean is taken over all rows; nothing is fitted on a sample and every row is coded. ``epsilon``
sets the bound's confidence: recall against brute force is 1.0 on the given tables with 3.0.

Defined results: rows whose id is null, or whose vector is null, empty, zero, or holds a null or a
non-finite number, take no part. Vectors of different lengths never meet. A candidate row that
occurs twice takes two places; of several query rows with one id the smallest vector (array
order) asks. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberlink.llm.common import table
from emberlink.llm.tiles import best_k, matrix, merge_lists, over_tiles, pack_blocks, usable

PARTIAL = "query_id long, s_no int, vec_id long, score double"
EPSILON = 3.0
SEED = 20240131
_STRIPE = 256  # query rows estimated at once


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, mean: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual lengths, products of code and direction, products with the mean."""
    rest = vectors - mean
    length = np.linalg.norm(rest, axis=1)
    direction = (rest / np.where(length > 0, length, 1.0)[:, None]) @ turn
    match = np.abs(direction).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(direction > 0, axis=1), length, np.where(match > 0, match, 1.0), vectors @ mean


def estimate(queries: np.ndarray, mean: np.ndarray, turn: np.ndarray, codes: np.ndarray, length: np.ndarray, match: np.ndarray, with_mean: np.ndarray, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """Inner products of queries with coded vectors, and the bounds of their errors."""
    dim = queries.shape[1]
    rest = queries - mean
    q_length = np.linalg.norm(rest, axis=1)
    signs = np.unpackbits(codes, axis=1, count=dim).astype(np.float32) * 2 - 1
    on_code = ((rest @ turn).astype(np.float32) @ signs.T).astype(np.float64) / np.sqrt(dim)
    guess = on_code / match * length + with_mean + (queries @ mean - mean @ mean)[:, None]
    spread = np.sqrt(np.maximum(0.0, 1 - match**2)) / match / np.sqrt(max(1, dim - 1))
    # The last term covers rounding: float32 products, and vectors equal to the mean.
    wide = epsilon * q_length[:, None] * (spread * length) + 1e-5 * (np.abs(guess) + q_length[:, None] * length)
    return guess, wide + 1e-12


def nearest(df: DataFrame, is_query: Column, k: int, epsilon: float = EPSILON, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): each query's ``k`` nearest by inner product."""
    v = F.col(vector_col).cast("array<double>")
    clean = (
        df.where(F.col(id_col).isNotNull() & usable(vector_col) & F.exists(v, lambda x: x != 0))
        .select(F.col(id_col).cast("long").alias("id"), v.alias("vector"), is_query.alias("asks"))
    )
    asked = clean.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    queries = pack_blocks(asked, "id", "vector", "ann-queries")
    blocks = pack_blocks(clean, "id", "vector", "ann-vectors")
    means = {row["dim"]: np.array(row["mean"]) for row in _means(clean).collect()}

    def code(batches):
        for batch in batches:
            for row in batch.itertuples(index=False):
                _, vectors = matrix(row.ids, row.data, row.dim)
                codes, *scalars = encode(vectors, means[row.dim], rotation(row.dim))
                yield pd.DataFrame({**{c: [getattr(row, c)] for c in ("dim", "no", "ids", "data")}, "codes": [codes.tobytes()], "scalars": [np.stack(scalars).astype("<f8").tobytes()]})

    index = blocks.mapInPandas(code, "dim int, no int, ids binary, data binary, codes binary, scalars binary")

    def work(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(s):
            dim, s_no = int(s["dim"][0]), int(s["s_no"][0])
            q_ids, wanted = matrix(q["ids"][0], q["data"][0], dim)
            s_ids, vectors = matrix(s["ids"][0], s["data"][0], dim)
            codes = np.frombuffer(s["codes"][0], np.uint8).reshape(len(s_ids), -1)
            scalars = np.frombuffer(s["scalars"][0], "<f8").reshape(3, -1)
            mean, turn = means[dim], rotation(dim)
            for start in range(0, len(q_ids), _STRIPE):
                asking = wanted[start : start + _STRIPE]
                guess, wide = estimate(asking, mean, turn, codes, *scalars, epsilon)
                for i, query in enumerate(q_ids[start : start + _STRIPE]):
                    others = np.flatnonzero(s_ids != query)
                    low = guess[i, others] - wide[i, others]
                    floor = np.partition(low, len(low) - k)[len(low) - k] if len(low) > k else -np.inf
                    others = others[guess[i, others] + wide[i, others] >= floor]
                    exact = vectors[others] @ asking[i]
                    best = best_k(exact, s_ids[others], k)
                    out.append(pd.DataFrame({"query_id": query, "s_no": s_no, "vec_id": s_ids[others][best], "score": exact[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "s_no": [], "vec_id": [], "score": []})

    return merge_lists(over_tiles(queries, index, work, PARTIAL), k)


def _means(clean: DataFrame) -> DataFrame:
    """One row per vector length: the mean of all its vectors."""
    parts = clean.select(F.size("vector").alias("dim"), F.posexplode("vector").alias("at", "x"))
    each = parts.groupBy("dim", "at").agg(F.avg("x").alias("x"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: p["x"])
    return each.groupBy("dim").agg(ordered.alias("mean"))


def op9_rabitq_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``embeddings`` whose ``vec_id`` is divisible by 20, against all rows."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
