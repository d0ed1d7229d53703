"""Small helpers that several operators share."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from emberlink.session import cut_lineage, scratch_dir, scratch_scope, use_utc

__all__ = ["cut_lineage", "fresh", "scratch_dir", "scratch_scope", "table", "use_utc"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(taken: Sequence[str], name: str) -> str:
    """``name``, or a variant of it that no column in ``taken`` has (letter case ignored)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"{name}_{uuid.uuid4().hex[:6]}"
    return name
