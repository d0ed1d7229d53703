"""Queries over single articles: expressions, filters, classifiers, updates, de-duplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from emberlink import schemas
from emberlink.functions.text import article_text, blank_to_null, event_text, match_any
from emberlink.functions.times import parse_published
from emberlink.operators import classify, filters, tagger
from emberlink.operators.dedup import dedup_first
from emberlink.operators.entities import entities, extract_entities
from emberlink.operators.hazards import hazards_union
from emberlink.operators.outlines import outlines_frame, regions_by_outline
from emberlink.operators.overlay import overlay
from emberlink.flows import import_feed, import_hazard_events, import_landslides, import_posts, insert_articles
from emberlink.operators.terms import match_terms
from emberlink.plans import standins as st
from emberlink.plans.registry import query
from emberlink.session import scratch_dir
from emberlink.sinks import months
from emberlink.sources.canonical import canonical_union

ALL_TERMS = [t for terms in st.TYPES.values() for t in terms]


def _day(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d')"


def _published_day():
    return F.date_format("published_at", "yyyy-MM-dd").alias("published_day")


# ---- projections --------------------------------------------------------------------------


@query(
    "canonical_union",
    """
    SELECT source_type, title, url, md5(coalesce(description, '')) AS body, source, language
    FROM (
        SELECT 'newsapi' AS source_type, source AS title,
               'https://news.example/' || md5(lower(trim(text))) AS url, text AS description,
               source, lang AS language FROM documents
        UNION ALL
        SELECT 'google_rss', regexp_extract(html, '<title>([^<]*)</title>', 1), url, html,
               'Google News RSS', NULL FROM pages
        UNION ALL
        SELECT 'reddit', role || ' ' || turn, NULL, text, 'r/' || conv_id, NULL FROM conversations)
    """,
)
def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    news = st.articles(spark, sf_dir).drop("article_id").withColumn("source_type", F.lit("newsapi"))
    feed = st.table(spark, sf_dir, "pages").select(
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        "url",
        F.col("html").alias("description"),
        F.lit("Google News RSS").alias("source"),
        F.lit("google_rss").alias("source_type"),
    )
    forum = st.table(spark, sf_dir, "conversations").select(
        F.concat_ws(" ", "role", F.col("turn").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.concat(F.lit("r/"), F.col("conv_id").cast("string")).alias("source"),
        F.lit("reddit").alias("source_type"),
    )
    return canonical_union(news, feed, forum, as_of=st.AS_OF).select(
        "source_type", "title", "url", F.md5(F.coalesce("description", F.lit(""))).alias("body"), "source", "language"
    )


@query(
    "parse_published",
    """
    SELECT event_id, layout,
           CASE layout WHEN 'broken' THEN NULL
                       WHEN 'date' THEN strftime(ts, '%Y-%m-%d 00:00:00')
                       ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS published
    FROM events, (VALUES ('rfc'), ('rfc_offset'), ('iso_z'), ('iso'), ('date'), ('epoch'), ('broken')) AS l(layout)
    """,
)
def parse_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event time written in each layout, and parsed back."""
    ts = F.col("ts").cast("timestamp")
    texts = {
        "rfc": F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"),
        "rfc_offset": F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss '+0000'"),
        "iso_z": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "iso": F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
        "date": F.date_format(ts, "yyyy-MM-dd"),
        "epoch": F.unix_timestamp(ts).cast("string"),
        "broken": F.concat(F.lit("about "), F.date_format(ts, "MMMM")),
    }
    written = F.explode(F.array(*[F.struct(F.lit(k).alias("layout"), v.alias("raw")) for k, v in texts.items()]))
    return (
        st.table(spark, sf_dir, "events")
        .select("event_id", written.alias("w"))
        .select(
            "event_id",
            "w.layout",
            F.date_format(parse_published(F.col("w.raw")), "yyyy-MM-dd HH:mm:ss").alias("published"),
        )
    )


@query(
    "fallbacks",
    f"""
    SELECT article_id, coalesce(nullif(guid, ''), url) AS guid,
           coalesce({_day('published_at')}, '{st.AS_OF}') AS published_day, coalesce(outlet, '') AS outlet
    FROM (SELECT article_id, url,
                 CASE WHEN relevance_score IS NULL THEN '' WHEN relevance_score > 0 THEN source END AS guid,
                 CASE WHEN relevance_score IS NOT NULL THEN published_at END AS published_at,
                 CASE WHEN semantic_score = 0 THEN source END AS outlet
          FROM {st.ENRICHED_SQL} AS e)
    """,
)
def fallbacks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing guid falls back to the link, missing date to ``as_of``, missing name to ''."""
    e = st.enriched(spark, sf_dir)
    guid = F.when(F.col("relevance_score").isNull(), "").when(F.col("relevance_score") > 0, F.col("source"))
    published = F.when(F.col("relevance_score").isNotNull(), F.col("published_at"))
    return e.select(
        "article_id",
        F.coalesce(blank_to_null(guid), F.col("url")).alias("guid"),
        F.coalesce(F.date_format(published, "yyyy-MM-dd"), F.lit(st.AS_OF)).alias("published_day"),
        F.coalesce(F.when(F.col("semantic_score") == 0, F.col("source")), F.lit("")).alias("outlet"),
    )


@query(
    "article_text",
    f"""
    SELECT article_id, md5(trim(concat_ws(' ', title, CASE WHEN relevance_score IS NOT NULL THEN description END))) AS text_md5
    FROM {st.ENRICHED_SQL} AS e
    """,
)
def text_of_article(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and description, where some articles have no description."""
    e = st.enriched(spark, sf_dir)
    description = F.when(F.col("relevance_score").isNotNull(), F.col("description"))
    return e.select("article_id", F.md5(article_text(F.col("title"), description)).alias("text_md5"))


@query(
    "event_text",
    f"""
    SELECT hazard_id, disaster_type || ' in ' || printf('%.2f', latitude) || ',' || printf('%.2f', longitude)
           || ' on ' || strftime(event_date, '%Y-%m-%d') AS sentence
    FROM {st.HAZARDS_SQL} AS h
    """,
)
def text_of_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    two = lambda c: F.format_string("%.2f", F.col(c))
    return _hazards(spark, sf_dir).select(
        "hazard_id", event_text("disaster_type", two("latitude"), two("longitude"), "event_date").alias("sentence")
    )


def _hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    union = hazards_union(st.wildfires(spark, sf_dir), st.landslides(spark, sf_dir))
    return union.withColumn("hazard_id", F.col("hazard_id").cast("long"))


# ---- filters ------------------------------------------------------------------------------


@query(
    "filter_exists",
    f"""
    SELECT 'scored' AS state, article_id FROM {st.ENRICHED_SQL} AS a WHERE relevance_score IS NOT NULL
    UNION ALL SELECT 'pending', article_id FROM {st.ENRICHED_SQL} AS b WHERE relevance_score IS NULL
    UNION ALL SELECT 'all', article_id FROM {st.ENRICHED_SQL} AS c
    """,
)
def filter_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.enriched(spark, sf_dir)
    parts = {
        "scored": e.where(filters.has("relevance_score")),
        "pending": filters.pending(e, "relevance_score"),
        "all": filters.pending(e, "relevance_score", override=True),
    }
    frames = [df.select(F.lit(state).alias("state"), "article_id") for state, df in parts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "filter_range",
    f"""
    SELECT fire_id AS id, 'fire' AS kind FROM {st.WILDFIRES_SQL} AS w WHERE acq_date >= DATE '2024-01-15'
    UNION ALL
    SELECT article_id, 'article' FROM {st.PLACED_ARTICLES_SQL} AS a WHERE semantic_score >= 0.2
    """,
)
def filter_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    fires = filters.at_least(st.wildfires(spark, sf_dir), "acq_date", "2024-01-15")
    scored = filters.at_least(st.placed_articles(spark, sf_dir), "semantic_score", 0.2)
    return fires.select(F.col("fire_id").alias("id"), F.lit("fire").alias("kind")).unionByName(
        scored.select(F.col("article_id").alias("id"), F.lit("article").alias("kind"))
    )


@query(
    "filter_recent",
    f"""
    SELECT article_id, days FROM {st.PLACED_ARTICLES_SQL} AS a, (VALUES (10), (14), (30)) AS d(days)
    WHERE published_at >= TIMESTAMP '{st.AS_OF} 00:00:00' - to_days(days)
    """,
)
def filter_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = st.placed_articles(spark, sf_dir)
    frames = [
        filters.recent(a, "published_at", days, st.AS_OF).select("article_id", F.lit(days).alias("days"))
        for days in (10, 14, 30)
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query(
    "filter_required",
    f"""
    WITH e AS (
        SELECT article_id, CASE WHEN relevance_score > 0 THEN title WHEN relevance_score = 0 THEN '' END AS title,
               CASE WHEN semantic_score = 0 THEN url END AS url
        FROM {st.ENRICHED_SQL} AS x)
    SELECT 'all' AS rule, article_id FROM e WHERE nullif(title, '') IS NOT NULL AND nullif(url, '') IS NOT NULL
    UNION ALL
    SELECT 'any', article_id FROM e WHERE nullif(title, '') IS NOT NULL OR nullif(url, '') IS NOT NULL
    """,
)
def filter_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.enriched(spark, sf_dir).select(
        "article_id",
        F.when(F.col("relevance_score") > 0, F.col("title")).when(F.col("relevance_score") == 0, "").alias("title"),
        F.when(F.col("semantic_score") == 0, F.col("url")).alias("url"),
    )
    every = filters.require_all(e, "title", "url").select(F.lit("all").alias("rule"), "article_id")
    some = filters.require_any(e, "title", "url").select(F.lit("any").alias("rule"), "article_id")
    return every.unionByName(some)


@query(
    "keyword_filter",
    f"SELECT article_id FROM {st.ARTICLES_SQL} AS a WHERE {st.any_sql('title', ALL_TERMS)} OR {st.any_sql('description', ALL_TERMS)}",
)
def keyword_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.keyword_filter(st.articles(spark, sf_dir), ["title", "description"], ALL_TERMS).select("article_id")


@query(
    "boolean_search",
    f"""
    SELECT article_id FROM {st.ARTICLES_SQL} AS a
    WHERE {st.any_sql('description', st.TYPES['wildfire'])} AND {st.any_sql('description', st.PLACES)}
    """,
)
def boolean_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.search(st.articles(spark, sf_dir), "description", st.TYPES["wildfire"], st.PLACES).select("article_id")


@query(
    "restrict_scan",
    f"""
    SELECT article_id, language FROM {st.ARTICLES_SQL} AS a
    WHERE language IN ('de', 'en') AND country IN ('DE', 'EN', 'CH')
      AND published_at >= DATE '2024-01-05' AND published_at < DATE '2024-01-11'
    """,
)
def restrict_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.restrict(
        st.articles(spark, sf_dir), ["de", "en"], ["DE", "EN", "CH"], "2024-01-05", "2024-01-10"
    ).select("article_id", "language")


# ---- classifiers and enrichment -----------------------------------------------------------


@query(
    "classify_type",
    f"""
    SELECT article_id, kind AS linked_disaster_type
    FROM (SELECT article_id, {st.type_sql("description")} AS kind FROM {st.ARTICLES_SQL} AS a) WHERE kind IS NOT NULL
    """,
)
def classify_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = classify.classify_first(st.articles(spark, sf_dir), "description", st.TYPES)
    return typed.select("article_id", "linked_disaster_type")


@query(
    "location_flag",
    f"SELECT article_id, {st.any_sql('description', st.PLACES)} AS location_match FROM {st.ARTICLES_SQL} AS a",
)
def location_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.flag_any(st.articles(spark, sf_dir), "description", st.PLACES).select("article_id", "location_match")


@query(
    "relevance_score",
    f"""
    SELECT article_id, coalesce(relevance_score,
        ({st.any_sql('description', st.TYPES['wildfire'])}::INT + {st.any_sql('description', st.PLACES)}::INT) / 2.0::DOUBLE) AS relevance_score
    FROM {st.ENRICHED_SQL} AS e
    """,
)
def relevance_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify.score_relevance(
        st.enriched(spark, sf_dir), fields=["title", "description"], hazard_terms=st.TYPES["wildfire"], place_terms=st.PLACES
    )
    return scored.select("article_id", "relevance_score")


GRID = {"types": st.TYPES, "countries": [*st.PLACES, "DE", "fr"], "languages": ["de", "en"]}


@query(
    "grid_tags",
    f"""
    SELECT article_id, kind AS cell_type, keyword AS cell_keyword, place AS cell_country, language AS cell_language,
           keyword || ' ' || place AS query
    FROM {st.ARTICLES_SQL} AS a,
         (VALUES {', '.join(f"('{k}', '{t}')" for k, terms in st.TYPES.items() for t in terms)}) AS k(kind, keyword),
         (VALUES {', '.join(f"('{p}')" for p in [*st.PLACES, 'DE', 'fr'])}) AS p(place)
    WHERE language IN ('de', 'en') AND contains(lower(description), keyword)
      AND CASE WHEN len(place) = 2 THEN upper(country) = upper(place) ELSE contains(lower(description), place) END
    """,
)
def grid_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.tag_grid(st.articles(spark, sf_dir), GRID).select(
        "article_id", "cell_type", "cell_keyword", "cell_country", "cell_language", "query"
    )


# Frequent words of the texts, in the place of names.
NAMES = {"LOC": ["The", "Der", "La"], "ORG": ["And", "Und", "El"]}


@query(
    "entities",
    f"""
    SELECT article_id, row_number() OVER (PARTITION BY article_id ORDER BY nth) - 1 AS pos, word AS text,
           CASE WHEN word IN ('The', 'Der', 'La') THEN 'LOC' ELSE 'ORG' END AS label
    FROM (SELECT article_id, unnest(words) AS word, unnest(range(len(words))) AS nth
          FROM (SELECT article_id, regexp_extract_all(description, '[\\p{{L}}\\p{{N}}]+') AS words
                FROM {st.ARTICLES_SQL} AS a) AS w) AS u
    WHERE word IN ('The', 'Der', 'La', 'And', 'Und', 'El')
    """,
)
def entity_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    tagged = st.articles(spark, sf_dir).select("article_id", F.posexplode(entities("description", NAMES)))
    return tagged.select("article_id", F.col("pos").cast("long").alias("pos"), "col.text", "col.label")


@query(
    "entities_pending",
    f"""
    SELECT article_id, CASE WHEN linked_fire_id IS NULL THEN NULL ELSE
        len(list_filter(regexp_extract_all(description, '[\\p{{L}}\\p{{N}}]+'),
            lambda w: w IN ('The', 'Der', 'La', 'And', 'Und', 'El'))) END AS n_entities
    FROM {st.ENRICHED_SQL} AS e
    """,
)
def entities_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only linked articles without entities are tagged."""
    e = st.enriched(spark, sf_dir).withColumn("entities", F.lit(None).cast("array<struct<text:string,label:string>>"))
    tagged = extract_entities(e, "description", NAMES)
    return tagged.select(
        "article_id", F.when(F.col("entities").isNotNull(), F.size("entities").cast("long")).alias("n_entities")
    )


@query(
    "large_lexicon",
    """
    WITH terms AS (
        SELECT DISTINCT lower(w) AS term FROM (SELECT unnest(string_split(text, ' ')) AS w FROM benchmark) WHERE length(w) > 0)
    SELECT doc_id, count(*) AS n, md5(string_agg(term, '|' ORDER BY term)) AS terms
    FROM documents JOIN terms ON contains(lower(text), term) GROUP BY doc_id
    """,
)
def large_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All words of ``benchmark`` as a lexicon, searched for in all documents."""
    words = st.table(spark, sf_dir, "benchmark").select(F.explode(F.split("text", " ")).alias("term"))
    hits = match_terms(st.table(spark, sf_dir, "documents"), "doc_id", "text", words)
    found = hits.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list("term")).alias("terms"))
    return found.withColumn("terms", F.md5(F.concat_ws("|", "terms")))


@query("entities_trained")
def entities_trained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of every article by the tagger, trained on all sentences, beside the gazetteer."""
    e = st.articles(spark, sf_dir).withColumns(
        {"linked_fire_id": F.lit(1), "entities": F.lit(None).cast(T.ArrayType(schemas.ENTITY))}
    )
    weights = tagger.train(e, "description", NAMES, whole=True)
    tagged = extract_entities(e, "description", NAMES, make_tagger=tagger.make_tagger(weights, NAMES))
    shown = F.transform("entities", lambda x: F.concat_ws("|", x["text"], x["label"]))
    return tagged.select("article_id", F.size("entities").alias("n"), F.concat_ws(",", shown).alias("spans"))


@query("entities_held_out")
def entities_held_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How well the tags alone, which never see a word whole, find the gazetteer's names in sentences outside training."""
    e = st.articles(spark, sf_dir)
    return tagger.held_out_scores(e, "description", tagger.train(e, "description", NAMES), NAMES)


@query(
    "region_assign",
    f"SELECT article_id, {st.region_sql('query_lat', 'query_lon')} AS region FROM {st.PLACED_ARTICLES_SQL} AS a",
)
def region_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = classify.region_of("query_lat", "query_lon", st.REGIONS)
    return st.placed_articles(spark, sf_dir).select("article_id", region.alias("region"))


_EDGES = [
    (name, rank, *here, *there)
    for rank, (name, rings) in enumerate(st.OUTLINES) for ring in rings for here, there in zip(ring, [*ring[1:], ring[0]])
]


@query(
    "region_outline",
    f"""
    WITH edges(name, rank, y1, x1, y2, x2) AS (
        SELECT name, rank, y1::DOUBLE, x1::DOUBLE, y2::DOUBLE, x2::DOUBLE
        FROM (VALUES {', '.join(map(str, _EDGES))}) AS e(name, rank, y1, x1, y2, x2)),
    points AS (SELECT article_id, query_lat AS y, query_lon AS x FROM {st.PLACED_ARTICLES_SQL} AS a),
    within AS (
        SELECT article_id, name, rank FROM points JOIN edges
        ON (y1 > y) != (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1
        GROUP BY ALL HAVING count(*) % 2 = 1)
    SELECT article_id, (SELECT arg_min(name, rank) FROM within AS w WHERE w.article_id = p.article_id) AS region FROM points AS p
    """,
)
def region_outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    outlines = outlines_frame(spark, st.OUTLINES)
    return regions_by_outline(st.placed_articles(spark, sf_dir), outlines, "query_lat", "query_lon").select("article_id", "region")


# ---- de-duplication and updates -----------------------------------------------------------


@query(
    "dedup_first",
    f"SELECT min(article_id) AS article_id, url FROM {st.ARTICLES_SQL} AS a GROUP BY url",
)
def first_per_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_first(st.articles(spark, sf_dir).select("article_id", "url"), "url", "article_id")


@query(
    "dedup_insert_absent",
    f"""
    WITH a AS (SELECT article_id, CASE WHEN article_id % 4 > 0 THEN url END AS url, title, relevance_score FROM {st.ENRICHED_SQL} AS e),
    keyed AS (SELECT *, coalesce(url, 'no url: ' || title) AS key FROM a)
    SELECT min(article_id) AS article_id, any_value(url) AS url FROM keyed
    WHERE relevance_score IS NULL
      AND key NOT IN (SELECT key FROM keyed WHERE relevance_score IS NOT NULL)
    GROUP BY key
    """,
)
def insert_absent_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled articles are the table, the others the batch to insert; a quarter have no url and go by title."""
    e = st.enriched(spark, sf_dir).select("article_id", F.when(F.col("article_id") % 4 > 0, F.col("url")).alias("url"), "title", "relevance_score")
    new = e.where(filters.lacks("relevance_score"))
    table = e.where(filters.has("relevance_score"))
    return insert_articles(new, table, "article_id").select("article_id", "url")


@query(
    "overlay_update",
    f"""
    SELECT article_id, title, language, coalesce(quality / 2.0::DOUBLE, 9.0) AS relevance_score,
           CASE WHEN doc_id IS NOT NULL THEN toxic / 2.0::DOUBLE END AS semantic_score
    FROM {st.ARTICLES_SQL} AS a LEFT JOIN labels ON article_id = doc_id
    """,
)
def overlay_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels patch one column that exists and one that is new."""
    base = st.articles(spark, sf_dir).select("article_id", "title", "language", F.lit(9.0).alias("relevance_score"))
    patch = st.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article_id"),
        (F.col("quality") / F.lit(2.0)).alias("relevance_score"),
        (F.col("toxic") / F.lit(2.0)).alias("semantic_score"),
    )
    return overlay(base, patch, "article_id", ["relevance_score", "semantic_score"])


@query(
    "overlay_months",
    f"""
    SELECT article_id, title, strftime(published_at, '%Y-%m') AS month, coalesce(quality / 2.0::DOUBLE, 9.0) AS relevance_score,
           toxic / 2.0::DOUBLE AS semantic_score
    FROM (SELECT article_id, title, published_at + to_days((article_id % 365)::INTEGER) AS published_at FROM {st.ARTICLES_SQL} AS a)
    LEFT JOIN labels ON article_id = doc_id
    """,
)
def overlay_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same update on a table by month, whose files lack one of the columns."""
    later = F.col("published_at") + F.make_dt_interval((F.col("article_id") % 365).cast("int"))
    base = st.articles(spark, sf_dir).select("article_id", "title", later.alias("published_at"), F.lit(9.0).alias("relevance_score"))
    patch = st.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("article_id"),
        (F.col("quality") / F.lit(2.0)).alias("relevance_score"),
        (F.col("toxic") / F.lit(2.0)).alias("semantic_score"),
    )
    path, schema = scratch_dir(spark, "by-month"), T.StructType([*base.schema.fields, T.StructField("semantic_score", T.DoubleType())])
    months.write_months(base, path, "published_at")
    months.update_months(spark, path, schema, patch, "article_id", ["relevance_score", "semantic_score"])
    return months.read_months(spark, path, schema).drop("published_at")


@query(
    "relief_feed",
    f"""
    SELECT min(article_id) AS article_id, url, any_value(kind) AS linked_disaster_type,
           any_value(place) AS location_match
    FROM (SELECT article_id, url, {st.type_sql("description")} AS kind, {st.any_sql('description', st.PLACES)} AS place
          FROM {st.ARTICLES_SQL} AS a
          WHERE published_at >= TIMESTAMP '{st.AS_OF} 00:00:00' - to_days(14))
    WHERE kind IS NOT NULL GROUP BY url
    """,
)
def relief_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole feed import: recent, classified, flagged, first per url."""
    found = import_feed(st.articles(spark, sf_dir), st.AS_OF, None, st.TYPES, st.PLACES, 14, "description")
    return found.select("article_id", "url", "linked_disaster_type", "location_match")


@query(
    "forum_import",
    f"""
    SELECT article_id FROM {st.ARTICLES_SQL} AS a
    WHERE published_at >= TIMESTAMP '{st.AS_OF} 00:00:00' - to_days(10) AND {st.any_sql('description', ALL_TERMS)}
    """,
)
def forum_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recent posts with any keyword, before de-duplication."""
    recent = filters.recent(st.articles(spark, sf_dir), "published_at", 10, st.AS_OF)
    return recent.where(match_any(["title", "description"], ALL_TERMS)).select("article_id")


@query(
    "post_import",
    f"""
    WITH a AS (SELECT article_id, url FROM {st.ARTICLES_SQL} AS a
               WHERE published_at >= TIMESTAMP '{st.AS_OF} 00:00:00' - to_days(10) AND {st.any_sql('description', ALL_TERMS)})
    SELECT min(article_id) AS article_id, url FROM a
    WHERE url NOT IN (SELECT url FROM {st.ENRICHED_SQL} AS e WHERE relevance_score IS NOT NULL) GROUP BY url
    """,
)
def post_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole import of forum posts, into a table that holds the labelled ones."""
    stored = st.enriched(spark, sf_dir).where(filters.has("relevance_score"))
    found = import_posts(st.articles(spark, sf_dir), st.AS_OF, stored, ALL_TERMS, None, 10, "description")
    return found.select("article_id", "url")


_GUIDS = "SELECT event_id, user_id AS guid, event_type AS title, ts FROM events"


@query(
    "insert_guid",
    f"""
    WITH e AS ({_GUIDS})
    SELECT min(event_id) AS event_id, guid FROM e
    WHERE title IN ('view', 'purchase') AND guid NOT IN (SELECT guid FROM e WHERE title = 'signup') GROUP BY guid
    """,
)
def insert_by_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed events by guid: users in the place of guids, event types in the place of titles."""
    events = st.table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("guid"), F.col("event_type").alias("title"))
    stored = events.where("title = 'signup'")
    return import_hazard_events(events, stored, ["view", "purchase"], "event_id").select("event_id", "guid")


@query(
    "insert_without_guid",
    f"""
    WITH e AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN guid END AS guid, title || ' ' || event_id % 50 AS title FROM ({_GUIDS}) AS g),
    i AS (SELECT *, coalesce(guid::VARCHAR, 'by title ' || title) AS identity FROM e)
    SELECT min(event_id) AS event_id, any_value(guid) AS guid, min(CASE WHEN guid IS NULL THEN title END) AS title FROM i
    WHERE NOT starts_with(title, 'signup') AND identity NOT IN (SELECT identity FROM i WHERE event_id % 7 = 0) GROUP BY identity
    """,
)
def insert_without_guid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed events of which two thirds have no guid: these are known by their title."""
    guid = F.when(F.col("event_id") % 3 == 0, F.col("user_id"))
    title = F.concat_ws(" ", "event_type", (F.col("event_id") % 50).cast("string"))
    events = st.table(spark, sf_dir, "events").select("event_id", guid.alias("guid"), title.alias("title"))
    found = import_hazard_events(events.where("not startswith(title, 'signup')"), events.where("event_id % 7 = 0"), [""], "event_id")
    return found.select("event_id", "guid", F.when(F.col("guid").isNull(), F.col("title")).alias("title"))


@query(
    "insert_event_id",
    f"""
    WITH s AS (SELECT (event_id % 997) AS event_id, date, latitude, longitude FROM {st.LANDSLIDES_SQL} AS l),
    known AS (SELECT event_id FROM s WHERE latitude < 48),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY date, latitude, longitude) AS rn FROM s
               WHERE event_id NOT IN (SELECT event_id FROM known))
    SELECT event_id, strftime(date, '%Y-%m-%d') AS date, round(latitude, 2) AS latitude FROM ranked WHERE rn = 1
    """,
)
def insert_by_event_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows by event id, into a table that holds the southern ones."""
    slides = st.landslides(spark, sf_dir).withColumn("event_id", F.col("event_id") % 997)
    found = import_landslides(slides, slides.where("latitude < 48"), ["date", "latitude", "longitude"])
    return found.select("event_id", F.date_format("date", "yyyy-MM-dd").alias("date"), F.round("latitude", 2).alias("latitude"))
