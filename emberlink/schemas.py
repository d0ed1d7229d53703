"""Declared schemas: the canonical tables and the payloads they come from."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B = T.StringType(), T.DoubleType(), T.BooleanType()
_TS, _DAY = T.TimestampType(), T.DateType()


def _struct(*columns: tuple[str, T.DataType] | str) -> T.StructType:
    """Nullable columns; a bare name is a string column."""
    pairs = [(c, _S) if isinstance(c, str) else c for c in columns]
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


def _list_of(*columns: tuple[str, T.DataType] | str) -> T.ArrayType:
    return T.ArrayType(_struct(*columns))


ENTITY = _struct("text", "label")

ARTICLES = _struct(
    "article_id", "title", "description", "content", "url",
    "published_raw", ("published_at", _TS), "source", "source_type",
    "language", "country", "query",
    "linked_disaster_type", "linked_disaster_id",
    ("query_lat", _D), ("query_lon", _D), ("query_date", _DAY), ("location_match", _B),
    ("relevance_score", _D), ("semantic_score", _D), "semantic_linked_disaster_id",
    ("priority_match", _B), "linked_fire_id", ("match_score", _D),
    ("entities", T.ArrayType(ENTITY)), "query_region", ("ingested_at", _TS),
)

WILDFIRES = _struct(
    "fire_id", "country", ("latitude", _D), ("longitude", _D), ("brightness", _D),
    "confidence", ("acq_date", _DAY), "acq_time", "satellite", "instrument",
    ("frp", _D), "daynight", "source", ("ingested_at", _TS),
)

LANDSLIDES = _struct(
    "type", "event_id", "location", ("date", _DAY), ("latitude", _D), ("longitude", _D),
    "source_name", "fatality_count", "landslide_size", "trigger", ("created_at", _TS),
)

DISASTER_EVENTS = _struct(
    "type", "title", "description", "link", "guid",
    ("published_at", _TS), "source", ("ingested_at", _TS),
)

HAZARDS = _struct(
    "hazard_id", "disaster_type", ("latitude", _D), ("longitude", _D), ("event_date", _DAY)
)

# ---- payloads as they land ------------------------------------------------------------

_OUTLET = ("source", _struct("name"))

NEWSAPI_RESPONSE = _struct(
    ("articles", _list_of(_OUTLET, "title", "description", "url", "publishedAt")), "_corrupt"
)
GNEWS_RESPONSE = _struct(
    ("articles", _list_of(_OUTLET, "title", "description", "content", "url", "publishedAt")),
    "_corrupt",
)
MEDIASTACK_RESPONSE = _struct(
    ("data", _list_of("title", "description", "url", "published_at", "source")), "_corrupt"
)
REDDIT_POST = _struct("subreddit", "title", "selftext", "url", ("created_utc", _D), "_corrupt")
RSS_DOCUMENT = _struct(
    ("channel", _struct(("item", _list_of("title", "link", "description", "pubDate", "guid")))),
    "_corrupt",
)
FIRMS_ROW = _struct(
    "country_id", ("latitude", _D), ("longitude", _D), ("bright_ti4", _D), "confidence",
    "acq_date", "acq_time", "satellite", "instrument", ("frp", _D), "daynight",
)
LANDSLIDE_ROW = _struct(
    "event_id", "location", "date", "latitude", "longitude", "source_name", "fatality_count",
    "landslide_size", "trigger", "_corrupt",
)
TOPIC_MESSAGE = _struct(
    "title", "description", "url", "publishedAt", "source", "source_type", "timestamp",
    "language", "country", "query", "disaster_type", "_corrupt",
)
