"""Exact top-k search by tiled matrix products.

Queries and candidates are cut into blocks; each pair of blocks is one matrix product, of which a
tile keeps every query's ``k`` best. The lists of a query are then merged as a tree.

Defined results: rows whose id is null, or whose vector is null, empty, or holds a null or a
non-finite number, take no part. Vectors of different lengths never meet. A zero vector is an
ordinary vector. A candidate row that occurs twice takes two places; of several query rows with
one id the smallest vector (array order) asks. An empty table gives an empty result. Products
that do not fit a long stop at its ends.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from emberlink.llm.common import table
from emberlink.llm.tiles import best_k, matrix, merge_lists, over_tiles, pack_blocks, usable

PARTIAL = "query_id long, s_no int, vec_id long, score long"
_STRIPE = 256  # query rows per matrix product
_LONG = 2**63 - 1


def integer_products(queries: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """Inner products of two matrices of whole numbers, without rounding."""
    longest = lambda m: float(np.sqrt(np.einsum("ij,ij->i", m, m)).max(initial=0.0))
    bound = longest(queries) * longest(shard)
    if bound < 2**52:
        return (queries @ shard.T).astype(np.int64)
    if bound < 2**62 and max(np.abs(queries).max(), np.abs(shard).max()) < 2**62:
        return queries.astype(np.int64) @ shard.astype(np.int64).T
    exact = np.array([[int(x) for x in row] for row in queries], dtype=object)
    other = np.array([[int(x) for x in row] for row in shard], dtype=object)
    return np.clip(exact.dot(other.T), -_LONG - 1, _LONG).astype(np.int64)


def top_k_integer(df: DataFrame, is_query: Column, k: int, scale: float = 64.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): each query's ``k`` highest integer products.

    Components become ``floor(scale * x)``. Every row but the query's own is a candidate; ties go
    to the smaller id.
    """
    clean = df.where(F.col(id_col).isNotNull() & usable(vector_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks")
    )
    asked = clean.where("asks").groupBy("id").agg(F.min("vector").alias("vector"))
    queries = pack_blocks(asked, "id", "vector", "topk-queries")
    shards = pack_blocks(clean, "id", "vector", "topk-shards")

    def work(q: pd.DataFrame, s: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(q) and len(s):
            dim, s_no = int(s["dim"][0]), int(s["s_no"][0])
            q_ids, wanted = matrix(q["ids"][0], q["data"][0], dim)
            s_ids, shard = matrix(s["ids"][0], s["data"][0], dim)
            wanted, shard = np.floor(scale * wanted), np.floor(scale * shard)
            for start in range(0, len(q_ids), _STRIPE):
                scores = integer_products(wanted[start : start + _STRIPE], shard)
                for query, row in zip(q_ids[start : start + _STRIPE], scores):
                    others = np.flatnonzero(s_ids != query)
                    best = others[best_k(row[others], s_ids[others], k)]
                    out.append(pd.DataFrame({"query_id": query, "s_no": s_no, "vec_id": s_ids[best], "score": row[best]}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "s_no": [], "vec_id": [], "score": []}, dtype="int64")

    return merge_lists(over_tiles(queries, shards, work, PARTIAL), k)


def op10_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of ``embeddings`` whose ``vec_id`` is divisible by 20, against all rows."""
    return top_k_integer(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


OP10_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
q AS (SELECT vec_id, min(w) AS w FROM v WHERE vec_id % 20 = 0 GROUP BY vec_id),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
    CAST(list_sum(list_transform(list_zip(q.w, v.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM q JOIN v ON q.vec_id <> v.vec_id AND len(q.w) = len(v.w)
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
