"""Row filters. Each is a plain predicate, so scans can push it down where the source allows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from emberlink.functions import times
from emberlink.functions.text import blank_to_null, match_any


def has(column: str) -> Column:
    """The field is set."""
    return F.col(column).isNotNull()


def lacks(column: str) -> Column:
    """The field is missing or null; the two are not told apart."""
    return F.col(column).isNull()


def pending(df: DataFrame, column: str, override: bool = False) -> DataFrame:
    """Rows still to be processed: those without ``column``, or all with ``override``."""
    return df if override else df.where(lacks(column))


def at_least(df: DataFrame, column: str, bound) -> DataFrame:
    """Rows whose value reaches ``bound``; null never does."""
    return df.where(F.col(column) >= F.lit(bound))


def recent(df: DataFrame, column: str, days: int, as_of: str | dt.datetime) -> DataFrame:
    """Rows at most ``days`` old at ``as_of``."""
    return df.where(times.recent(column, days, as_of))


def require_all(df: DataFrame, *columns: str) -> DataFrame:
    """Every field is set and not blank."""
    return df.where(reduce(lambda a, b: a & b, [blank_to_null(c).isNotNull() for c in columns]))


def require_any(df: DataFrame, *columns: str) -> DataFrame:
    """At least one field is set and not blank."""
    return df.where(reduce(lambda a, b: a | b, [blank_to_null(c).isNotNull() for c in columns]))


def nonempty(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.length(F.col(column)) > 0)


def keyword_filter(df: DataFrame, fields: str | Iterable[str], terms: Iterable[str]) -> DataFrame:
    """Rows with any term, as a case-insensitive substring, in any of the fields."""
    return df.where(match_any(fields, terms))


def search(
    df: DataFrame,
    fields: str | Iterable[str],
    any_of: Iterable[str],
    and_any_of: Iterable[str] | None = None,
) -> DataFrame:
    """Boolean text search ``(k1 OR k2 ..) AND (p1 OR p2 ..)``."""
    condition = match_any(fields, any_of)
    if and_any_of is not None:
        condition = condition & match_any(fields, and_any_of)
    return df.where(condition)


def restrict(
    df: DataFrame,
    languages: Iterable[str] | None = None,
    countries: Iterable[str] | None = None,
    start: str | dt.date | None = None,
    end: str | dt.date | None = None,
    date_column: str = "published_at",
) -> DataFrame:
    """Language, country and whole-day date limits; both end days are included."""
    if languages is not None:
        df = df.where(F.col("language").isin(*languages))
    if countries is not None:
        df = df.where(F.col("country").isin(*countries))
    if start is not None:
        df = df.where(F.col(date_column) >= F.lit(str(start)).cast("date"))
    if end is not None:
        df = df.where(F.col(date_column) < F.date_add(F.lit(str(end)).cast("date"), 1))
    return df


def with_coordinates(df: DataFrame, latitude: str, longitude: str) -> DataFrame:
    return df.where(has(latitude) & has(longitude))
