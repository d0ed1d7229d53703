"""Date-window link: articles published within some days of a hazard of their type."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from emberlink import lexicons as lx
from emberlink.functions.text import match_any
from emberlink.session import cut_lineage

# One row per covered date, of about a hundred bytes a type.
MAX_BROADCAST_DATES = 100_000
SALTS = 32


def event_window_plan(hazards: DataFrame, days: int = lx.NEWS_WINDOW_DAYS) -> DataFrame:
    """Search window of each hazard: ``from_date`` and ``to_date``, both included."""
    return hazards.withColumns(
        {"from_date": F.date_sub("event_date", days), "to_date": F.date_add("event_date", days)}
    )


def first_hazard_by_date(
    hazards: DataFrame, types: Iterable[str], days: int, order: str | Column = "hazard_id"
) -> DataFrame:
    """One row per covered date, with the first hazard of each type whose window holds it.

    Hazards shrink to one per type and event date before they are spread over their window, so
    what is spread, and the result, is bounded by the calendar and not by the number of hazards.
    """
    order = F.col(order) if isinstance(order, str) else order
    # Ids that grow in ``order``, so that the first of a group is a plain minimum.
    ranked = hazards.where(F.col("event_date").isNotNull()).select(
        "disaster_type", order.alias("ord"), "hazard_id", "latitude", "longitude", "event_date"
    ).sort("ord").withColumn("rank", F.monotonically_increasing_id())
    ranked = cut_lineage(ranked, "hazards")
    by_day = ranked.groupBy("disaster_type", "event_date").agg(F.min("rank").alias("rank"))
    spread = by_day.withColumn(
        "covered", F.explode(F.sequence(F.date_sub("event_date", days), F.date_add("event_date", days)))
    )
    types = list(types)
    dates = spread.groupBy("covered").agg(
        *[F.min(F.when(F.col("disaster_type") == kind, F.col("rank"))).alias(f"rank_{i}") for i, kind in enumerate(types)]
    )
    whole = F.struct("ord", "hazard_id", "latitude", "longitude", "event_date")
    for i, kind in enumerate(types):
        dates = dates.join(ranked.select(F.col("rank").alias(f"rank_{i}"), whole.alias(f"first_{kind}")), f"rank_{i}", "left")
    return dates.select("covered", *[f"first_{kind}" for kind in types])


def link_by_window(
    articles: DataFrame,
    hazards: DataFrame,
    days: int = lx.NEWS_WINDOW_DAYS,
    lexicon: Mapping[str, Iterable[str]] = lx.NEWSAPI_TYPES,
    places: Iterable[str] | None = lx.NEWSAPI_PLACES,
    fields: str | Iterable[str] = ("title", "description"),
    as_of: str | dt.date | None = None,
    recent_days: int = lx.HAZARD_DAYS,
    order: str | Column = "hazard_id",
    max_broadcast_dates: int = MAX_BROADCAST_DATES,
) -> DataFrame:
    """Articles with the hazard they belong to; others are dropped.

    An article belongs to a hazard when it is published within ``days`` of it and has a keyword
    of its type and a place name. Types go in lexicon order, hazards of a type in ``order``; the
    first one wins. ``as_of`` leaves out hazards older than ``recent_days``.

    The hazard side is one row per covered date. Up to ``MAX_BROADCAST_DATES`` rows it is broadcast,
    and articles are not shuffled; beyond that each date is joined in ``SALTS`` parts, so a day of
    much news is spread over tasks.
    """
    if as_of is not None:
        oldest = F.date_sub(F.lit(str(as_of)).cast("date"), recent_days)
        hazards = hazards.where(F.col("event_date") >= oldest)
    types = list(lexicon)
    by_date = first_hazard_by_date(hazards, types, days, order)
    found = articles
    if places is not None:
        found = found.where(match_any(fields, places))
    by_date = cut_lineage(by_date, "dates")
    found = found.withColumn("covered", F.to_date("published_at"))
    if by_date.count() <= max_broadcast_dates:
        found = found.join(F.broadcast(by_date), "covered")
    else:
        salted = by_date.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64(*found.columns), F.lit(SALTS)).cast("int")
        found = found.withColumn("__salt", salt).join(salted, ["covered", "__salt"]).drop("__salt")
    choice = F.coalesce(
        *[
            F.when(
                F.col(f"first_{kind}").isNotNull() & match_any(fields, terms),
                F.struct(F.lit(kind).alias("type"), F.col(f"first_{kind}").alias("hazard")),
            )
            for kind, terms in lexicon.items()
        ]
    )
    inherited = {
        "linked_disaster_type": "__choice.type",
        "linked_disaster_id": "__choice.hazard.hazard_id",
        "query_lat": "__choice.hazard.latitude",
        "query_lon": "__choice.hazard.longitude",
        "query_date": "__choice.hazard.event_date",
    }
    chosen = found.withColumn("__choice", choice).where(F.col("__choice").isNotNull())
    kept = [c for c in articles.columns if c not in inherited]
    return chosen.select(*kept, *[F.col(path).alias(name) for name, path in inherited.items()])
