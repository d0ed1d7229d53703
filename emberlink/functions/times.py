"""Time parsing and windows. Session time zone is UTC throughout."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

# Feed dates by their ending. The parser takes no weekday names, so the leading "Tue, " is
# stripped before.
_FEED_LAYOUTS = [
    (r" [+-][0-9]{4}$", "d MMM yyyy HH:mm:ss Z"),
    (r" [A-Z]+$", "d MMM yyyy HH:mm:ss zzz"),
]
_ISO = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]|$)"
_EPOCH = r"^[0-9]{9,11}(\.[0-9]+)?$"


def parse_published(value: str | Column) -> Column:
    """A timestamp from an ISO, feed or plain date, or from epoch seconds; else null.

    The shape of the text picks the parser: trying one layout after the other would raise, and
    swallow, an exception for every layout that does not fit.
    """
    value = F.col(value) if isinstance(value, str) else value
    raw = F.trim(value)
    feed = F.regexp_replace(raw, r"^[A-Za-z]{3}, ", "")
    parsed = F.when(raw.rlike(_ISO), raw.try_cast("timestamp")).when(
        raw.rlike(_EPOCH), F.timestamp_seconds(raw.try_cast("double"))
    )
    for ending, layout in _FEED_LAYOUTS:
        fits = raw.rlike(r"^([A-Za-z]{3}, )?[0-9]{1,2} [A-Za-z]{3} [0-9]{4} .*" + ending)
        parsed = parsed.when(fits, F.try_to_timestamp(feed, F.lit(layout)))
    return parsed


def as_timestamp(as_of: str | dt.datetime | Column) -> Column:
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def recent(column: str | Column, days: int, as_of: str | dt.datetime | Column) -> Column:
    """At most ``days`` old at ``as_of``; the boundary itself is kept, null is not."""
    column = F.col(column) if isinstance(column, str) else column
    return column >= as_timestamp(as_of) - F.make_dt_interval(F.lit(days))
