"""The batch flows end to end: imports from each kind of source, and enriching articles."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from emberlink import lexicons as lx, schemas
from emberlink.functions.ids import natural_key
from emberlink.functions.text import article_text, blank_to_null
from emberlink.operators.classify import classify_first, flag_any, region_of, score_relevance
from emberlink.operators.dedup import dedup_first, insert_absent
from emberlink.operators.entities import GAZETTEER, extract_entities
from emberlink.operators.filters import keyword_filter, recent, require_any
from emberlink.operators.nearest import link_space_time
from emberlink.operators.overlay import overlay
from emberlink.operators.semantic import link_semantic
from emberlink.operators.window_link import link_by_window

SEMANTIC_COLUMNS = ["semantic_score", "semantic_linked_disaster_id", "linked_disaster_type", "priority_match"]


#: What tells apart rows that lack the key they are known by.
_TRAITS = ("title", "source", "date", "latitude", "longitude", "location")


def identified(df: DataFrame, name: str = "__identity", key: str = "url", traits: Iterable[str] = ("title", "source")) -> DataFrame:
    """Add what makes a row itself: its ``key`` or, without one, its ``traits``, of those it has."""
    parts = [c for c in traits if c in df.columns]
    return df.withColumn(name, F.coalesce(blank_to_null(F.col(key).cast("string")), natural_key(*parts)))


def insert_articles(new: DataFrame, stored: DataFrame | None, order: str | Column | Iterable[str | Column], key: str | None = None) -> DataFrame:
    """The rows of ``new`` to append: first of each article, and not stored.

    ``key`` names another identity than the url. Rows without a key are known by title and source, or by what
    else both sides have of ``_TRAITS``; a stored side without any of these cannot hold them.
    """
    traits = ["title", "source"] if key is None else [c for c in _TRAITS if c in new.columns]
    key = key or "url"
    if stored is not None:
        both = [c for c in traits if c in stored.columns]
        traits = both or traits
        stored = identified(stored if both else stored.where(blank_to_null(F.col(key).cast("string")).isNotNull()), key=key, traits=traits)
    new = identified(new, key=key, traits=traits)
    first = dedup_first(new, "__identity", order) if stored is None else insert_absent(new, stored, "__identity", order)
    return first.drop("__identity")


def ingest_news(
    articles: DataFrame,
    hazards: DataFrame,
    stored: DataFrame | None = None,
    key: str | None = None,
    order: str | Column | Iterable[str | Column] = "article_id",
    **link_options,
) -> DataFrame:
    """Articles to append: they belong to a hazard, come first of their copies, and are not stored."""
    linked = link_by_window(require_any(articles, "title", "description"), hazards, **link_options)
    return insert_articles(linked, stored, order, key)


Order = str | Column | Iterable[str | Column]


def import_feed(
    items: DataFrame,
    as_of,
    stored: DataFrame | None = None,
    lexicon: Mapping[str, Iterable[str]] = lx.RELIEFWEB_TYPES,
    places: Iterable[str] = lx.RELIEFWEB_PLACES,
    days: int = lx.RELIEFWEB_DAYS,
    fields: str | Iterable[str] = ("title", "description"),
    order: Order = "article_id",
) -> DataFrame:
    """Feed items to append: recent, of a known type, flagged by place, first of their copies, not stored."""
    typed = classify_first(recent(items, "published_at", days, as_of), fields, lexicon)
    return insert_articles(flag_any(typed, fields, places), stored, order)


def import_posts(
    posts: DataFrame,
    as_of,
    stored: DataFrame | None = None,
    terms: Iterable[str] = lx.REDDIT_KEYWORDS,
    forums: Iterable[str] | None = lx.REDDIT_SUBREDDITS,
    days: int = lx.REDDIT_DAYS,
    fields: str | Iterable[str] = ("title", "description"),
    order: Order = "article_id",
) -> DataFrame:
    """Forum posts to append: recent, with a keyword, from the forums asked for, first of their copies, not stored."""
    kept = keyword_filter(recent(posts, "published_at", days, as_of), fields, terms)
    if forums is not None and "subreddit" in posts.columns:
        kept = kept.where(F.lower("subreddit").isin([f.lower() for f in forums]))
    return insert_articles(kept, stored, order)


def type_posts(posts: DataFrame, fields: str | Iterable[str] = ("title", "description")) -> DataFrame:
    """Streamed posts that name a hazard, with its type."""
    return classify_first(posts, fields, lx.REDDIT_STREAM_TYPES)


def import_hazard_events(events: DataFrame, stored: DataFrame | None = None, terms: Iterable[str] = lx.GDACS_TITLE_TERMS, order: Order = "guid") -> DataFrame:
    """Feed events to append: their title has a term, first of their ``guid`` (or title and source), not stored."""
    return insert_articles(keyword_filter(events, "title", terms), stored, order, "guid")


def import_landslides(slides: DataFrame, stored: DataFrame | None = None, order: Order = "date") -> DataFrame:
    """Catalog rows to append: first of their ``event_id`` (or date and place), not stored."""
    return insert_articles(slides, stored, order, "event_id")


def enrich(
    articles: DataFrame,
    fires: DataFrame,
    event_vectors: DataFrame | None = None,
    vector: str = "vector",
    hazard_terms: Iterable[str] = lx.RELEVANCE_FIRE,
    place_terms: Iterable[str] = lx.RELEVANCE_PLACES,
    gazetteer: Mapping[str, Sequence[str]] = GAZETTEER,
    regions: Iterable[tuple[str, float, float, float, float]] = (),
    link_options: Mapping | None = None,
    semantic_options: Mapping | None = None,
) -> DataFrame:
    """Relevance, then semantic link, then space-time link, then entities, then region.

    The order matters: the space-time link needs the semantic score, entities need the link.
    Without ``event_vectors`` the semantic columns stay as they are. Columns that an article
    table lacks are added empty; a ``vector`` column is used and left out of the result.
    """
    added = {
        f.name: F.lit(None).cast(f.dataType)
        for f in schemas.ARTICLES.fields
        if f.name not in articles.columns
        and f.name in ("relevance_score", "entities", "linked_fire_id", "match_score", *SEMANTIC_COLUMNS)
    }
    news = score_relevance(articles.withColumns(added), hazard_terms=hazard_terms, place_terms=place_terms)
    if event_vectors is not None:
        sides = news.select("article_id", F.col(vector).alias("vector"), article_text().alias("text"))
        found = link_semantic(sides.where("length(text) > 0"), event_vectors, text="text", **(semantic_options or {}))
        news = overlay(news, found, "article_id", SEMANTIC_COLUMNS)
    if vector in news.columns:
        news = news.drop(vector)
    nearest = link_space_time(news, fires, **(link_options or {}))
    news = overlay(news, nearest, "article_id", ["linked_fire_id", "match_score"])
    news = extract_entities(news, article_text(), gazetteer)
    boxes = list(regions)
    return news.withColumn("query_region", region_of("query_lat", "query_lon", boxes)) if boxes else news
