"""First writer wins: duplicates inside a batch, and keys that a table already holds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F


def _list(columns: str | Column | Iterable[str | Column]) -> list[Column]:
    if isinstance(columns, (str, Column)):
        columns = [columns]
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def dedup_first(
    df: DataFrame,
    key: str | Column | Iterable[str | Column],
    order: str | Column | Iterable[str | Column],
) -> DataFrame:
    """The first row per key in ``order``; null keys count as one key.

    Filtering ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key that holds a third of the rows sends one row per task.
    """
    first = Window.partitionBy(*_list(key)).orderBy(*_list(order))
    return (
        df.withColumn("__rank", F.row_number().over(first)).where("__rank = 1").drop("__rank")
    )


def insert_absent(
    new: DataFrame,
    target: DataFrame,
    key: str | Iterable[str],
    order: str | Column | Iterable[str | Column],
) -> DataFrame:
    """The rows of ``new`` to append: first per key, and only keys that ``target`` lacks.

    Only the key columns of the target are read, and its copies collapse before the shuffle. Null
    keys count as one key; key on ``article_id`` where rows without a url must stay apart. Both
    steps use one key column that is never null, so the new rows are shuffled once.
    """
    keys = [key] if isinstance(key, str) else list(key)
    whole = F.to_json(F.struct(*[F.col(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))
    known = target.select(whole.alias("__key")).distinct()
    first = dedup_first(new.withColumn("__key", whole), "__key", order)
    return first.join(known, "__key", "left_anti").select(*new.columns)
