"""Text predicates and expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F


def _columns(fields: str | Column | Iterable[str | Column]) -> list[Column]:
    if isinstance(fields, (str, Column)):
        fields = [fields]
    return [F.col(f) if isinstance(f, str) else f for f in fields]


def match_any(
    fields: str | Column | Iterable[str | Column],
    terms: Iterable[str],
    case_sensitive: bool = False,
    lower_terms: bool = True,
) -> Column:
    """True when any field contains any term as a plain substring; never null.

    The terms become literals, so the lexicon needs no join. The fields are bound once per row
    by ``exists``: written as a bare OR in a filter, ``lower`` would run once per term.
    ``lower_terms=False`` lower-cases the text but not the terms.
    """
    terms = list(terms)
    if not terms:
        return F.lit(False)
    values = _columns(fields)
    if not case_sensitive:
        values = [F.lower(v) for v in values]
        if lower_terms:
            terms = [t.lower() for t in terms]

    def hit(value: Column) -> Column:
        return reduce(lambda a, b: a | b, [value.contains(t) for t in terms])

    return F.coalesce(F.exists(F.array(*values), hit), F.lit(False))


def matching_terms(
    fields: str | Column | Iterable[str | Column], terms: Iterable[str]
) -> Column:
    """All terms contained in any field, as written, in the order given."""
    values = [F.coalesce(F.lower(v), F.lit("")) for v in _columns(fields)]

    def hits(text: Column) -> Column:
        return F.array_compact(
            F.array(*[F.when(text.contains(t.lower()), F.lit(t)) for t in terms])
        )

    joined = F.concat_ws("\x00", *values)
    return F.element_at(F.transform(F.array(joined), hits), 1)


def first_type(
    fields: str | Column | Iterable[str | Column], lexicon: Mapping[str, Iterable[str]]
) -> Column:
    """The first type, in declared order, with a term in the text; null when there is none."""
    fields = _columns(fields)
    return F.coalesce(
        *[F.when(match_any(fields, terms), F.lit(kind)) for kind, terms in lexicon.items()]
    )


def blank_to_null(value: str | Column) -> Column:
    """Null for null and for the empty string, which both count as missing."""
    (value,) = _columns(value)
    return F.nullif(value, F.lit(""))


def article_text(title: str | Column = "title", description: str | Column = "description") -> Column:
    """Title, a space, description; nulls are skipped and the result is trimmed."""
    return F.trim(F.concat_ws(" ", *_columns([title, description])))


def event_text(
    disaster_type: str | Column = "disaster_type",
    latitude: str | Column = "latitude",
    longitude: str | Column = "longitude",
    event_date: str | Column = "event_date",
) -> Column:
    """The sentence that stands for a hazard in semantic matching."""
    parts = [
        F.coalesce(c.cast("string"), F.lit(""))
        for c in _columns([disaster_type, latitude, longitude, event_date])
    ]
    return F.concat(parts[0], F.lit(" in "), parts[1], F.lit(","), parts[2], F.lit(" on "), parts[3])
