"""Packing a vector table into blocks that meet in a grid of tiles.

A block is one row: up to ``rows`` vectors as one little-endian binary, next to their ids. A
tile is a pair (query block, shard). Both sides are grouped by the pair of numbers, so a task holds
two blocks at a time, whatever the size of either table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from emberlink.llm.common import cut_lineage

BLOCK_ROWS = 4096


def usable(vector: str | Column) -> Column:
    """True for a vector that is not null, not empty and holds only finite numbers."""
    v = F.col(vector) if isinstance(vector, str) else vector
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite, F.lit(False))


def pack_blocks(df: DataFrame, id_col: str, vector_col: str, label: str, rows: int = BLOCK_ROWS) -> DataFrame:
    """``id``s and vectors as blocks (``dim``, ``no``, ``ids``, ``data``), written to the shared folder.

    A block holds vectors of one length only, as float64; ``no`` counts blocks of that length from
    0. Blocks are cut inside each task as rows stream by; only their numbers are shuffled.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def block(dim: int, pairs: list) -> pd.DataFrame:
            ids = np.array([p[0] for p in pairs], dtype="<i8")
            data = np.array([p[1] for p in pairs], dtype="<f8")
            return pd.DataFrame({"dim": [dim], "ids": [ids.tobytes()], "data": [data.tobytes()]})

        for batch in batches:
            for key, vector in zip(batch["id"].to_numpy(), batch["vector"]):
                pairs = held.setdefault(len(vector), [])
                pairs.append((key, vector))
                if len(pairs) >= rows:
                    yield block(len(vector), held.pop(len(vector)))
        for dim, pairs in held.items():
            yield block(dim, pairs)

    picked = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    cut_up = picked.mapInPandas(cut, "dim int, ids binary, data binary")
    blocks = cut_lineage(cut_up.withColumn("block", F.monotonically_increasing_id()), label)
    order = Window.partitionBy("dim").orderBy("block")
    numbers = blocks.select("dim", "block").withColumn("no", F.row_number().over(order) - 1)
    return blocks.join(numbers, ["dim", "block"]).drop("block")


def over_tiles(
    queries: DataFrame, shards: DataFrame, work: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame], schema: str
) -> DataFrame:
    """Apply ``work`` to every (query block, shard) pair of one vector length.

    A block is copied once for each block of the other side: the cost of any scan of all shards
    by all queries, and it falls with the square of the block size.
    """
    many = lambda df: df.groupBy("dim").agg((F.max("no") + 1).alias("others"))
    spread = F.explode(F.sequence(F.lit(0), F.col("others") - 1))
    rest = lambda df: [c for c in df.columns if c not in ("dim", "no")]
    q = queries.join(many(shards), "dim").select("dim", F.col("no").alias("q_no"), spread.alias("s_no"), *rest(queries))
    s = shards.join(many(queries), "dim").select("dim", spread.alias("q_no"), F.col("no").alias("s_no"), *rest(shards))
    keys = ["dim", "q_no", "s_no"]
    return q.groupBy(*keys).cogroup(s.groupBy(*keys)).applyInPandas(work, schema)


def matrix(ids: bytes, data: bytes, dim: int) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, dtype="<i8")
    return keys, np.frombuffer(data, dtype="<f8").reshape(len(keys), dim)


def best_k(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` best entries of one row of scores: score descending, then id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        picked = np.flatnonzero(scores >= cut)
    else:
        picked = np.arange(len(scores))
    return picked[np.lexsort((ids[picked], -scores[picked]))][:k]


def merge_lists(partial: DataFrame, k: int, fan_in: int = 32) -> DataFrame:
    """Merge per-tile lists (``query_id``, ``s_no``, ``vec_id``, ``score``) as a tree of two levels.

    Lists of ``fan_in`` shards merge first, then what they leave; each level keeps ``k`` rows a
    group before and after its shuffle, so no task sees more than ``fan_in * k`` rows of a query
    from one branch. Rows that tie in score and id, and are therefore the same row, keep their
    number.
    """
    best = [F.desc("score"), F.asc("vec_id")]
    low = Window.partitionBy("query_id", "branch").orderBy(*best)
    top = Window.partitionBy("query_id").orderBy(*best)
    level = partial.withColumn("branch", F.floor(F.col("s_no") / fan_in).cast("int"))
    level = level.withColumn("rank", F.row_number().over(low)).where(F.col("rank") <= k)
    return (
        level.withColumn("rank", F.row_number().over(top)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
