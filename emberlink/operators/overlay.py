"""Partial update by id."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from emberlink.operators.dedup import dedup_first


def overlay(
    base: DataFrame,
    patch: DataFrame,
    key: str,
    columns: Iterable[str],
    patch_order: str | Column | Iterable[str | Column] | None = None,
    missing_clears: bool = False,
) -> DataFrame:
    """``base`` with ``columns`` set from the patch row of the same key; all else stays.

    A patch row sets its columns even to null. Of several patch rows of a key the first in
    ``patch_order`` counts (by default in the order of ``columns``), so every row of ``base`` stays
    one row. ``missing_clears`` empties the columns of rows that have no patch instead of keeping
    what they had.
    """
    columns = list(columns)
    patch = dedup_first(patch.select(key, *columns) if patch_order is None else patch, key, columns if patch_order is None else patch_order)
    found = F.col("__found").isNotNull()
    side = patch.select(
        F.col(key), F.lit(True).alias("__found"), *[F.col(c).alias(f"__new_{c}") for c in columns]
    )
    joined = base.join(side, key, "left")
    kept = {
        c: (F.lit(None).cast(patch.schema[c].dataType) if missing_clears or c not in base.columns else F.col(c))
        for c in columns
    }
    merged = joined.withColumns(
        {c: F.when(found, F.col(f"__new_{c}")).otherwise(kept[c]) for c in columns}
    )
    order = base.columns + [c for c in columns if c not in base.columns]
    return merged.select(*order)
