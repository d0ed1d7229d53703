"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from emberlink.functions.text import blank_to_null


def natural_key(*parts: str | Column) -> Column:
    """A stable id from the columns that identify a row; null parts count as empty."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [F.coalesce(c.cast("string"), F.lit("")) for c in columns]
    return F.sha2(F.concat_ws("|", *texts), 256)


def article_key(url: str | Column = "url", title: str | Column = "title", source: str | Column = "source") -> Column:
    """Identity of an article: its url or, without one, title and source."""
    return F.coalesce(F.sha2(blank_to_null(url), 256), natural_key(title, source))
