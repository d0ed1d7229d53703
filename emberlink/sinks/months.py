"""Tables laid out by month, so that a partial update rewrites only the months it changes.

A table is a Parquet folder with one folder ``month=yyyy-MM`` for each month of its date column, and ``month=none`` for rows without a
date. An update reads the keys to see which months hold patched rows, overlays those months, and
overwrites them as partitions; files of all other months stay as they are. One writer at a time. The
new months are written aside first, since a table cannot be read while it is overwritten; a run that ends before the overwrite
leaves the table untouched, and an update may run again.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from emberlink.operators.overlay import overlay
from emberlink.session import cut_lineage

MONTH = "month"
NO_DATE = "none"


def month_of(date: str | Column) -> Column:
    date = F.col(date) if isinstance(date, str) else date
    return F.coalesce(F.date_format(date, "yyyy-MM"), F.lit(NO_DATE))


def write_months(df: DataFrame, path: str, date: str, mode: str = "errorifexists") -> None:
    """Write ``df`` by the month of ``date``. A hot month is spread over tasks as its rows were; nothing is shuffled."""
    if MONTH in df.columns:
        raise ValueError(f"the column {MONTH!r} belongs to the layout")
    df.withColumn(MONTH, month_of(date)).write.mode(mode).partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table in the columns of ``schema`` and ``month``; columns that older files lack are null."""
    declared = T.StructType([*schema.fields, T.StructField(MONTH, T.StringType())])
    return spark.read.schema(declared).parquet(path)


def touched_months(table: DataFrame, patch: DataFrame, key: str) -> list[str]:
    """Months that hold a key of ``patch``: one value a month of the calendar. Reads the key column only."""
    known = patch.select(key).where(F.col(key).isNotNull())
    found = table.select(key, MONTH).join(known, key, "left_semi").select(MONTH).distinct()
    return sorted(r[MONTH] for r in found.collect())


def update_months(
    spark: SparkSession, path: str, schema: T.StructType, patch: DataFrame, key: str, columns: Iterable[str], patch_order=None
) -> list[str]:
    """Overlay ``patch`` on the table at ``path``, as :func:`overlay` does, and say which months were rewritten.

    ``columns`` must be in ``schema``; the files written last hold all of it. Patch rows whose key the table lacks, or is null, change
    nothing. The date column is not to be patched, since a row would have to move to another month.
    """
    columns = list(columns)
    unknown = [c for c in columns if c not in schema.names]
    if unknown:
        raise ValueError(f"not in the table's schema: {', '.join(unknown)}")
    patch = cut_lineage(patch.where(F.col(key).isNotNull()), "patch")
    table = read_months(spark, path, schema)
    months = touched_months(table, patch, key)
    if months:
        changed = overlay(table.where(F.col(MONTH).isin(*months)), patch, key, columns, patch_order)
        aside = cut_lineage(changed.select(*schema.names, MONTH), "months")
        aside.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
    return months
