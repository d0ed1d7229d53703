"""Queries that link articles to hazards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.flows import enrich, ingest_news
from emberlink.functions.dense import encode_dense
from emberlink.functions.encode import encode_hashed
from emberlink.functions.grams import gram_counts, gram_counts_sql
from emberlink.functions.text import article_text, event_text
from emberlink.operators.classify import region_of
from emberlink.operators.hazards import hazard_counts, hazards_union
from emberlink.operators.nearest import link_space_time
from emberlink.operators.reports import dashboard_filter, dashboard_view, linked_only
from emberlink.operators.semantic import link_semantic
from emberlink.operators.window_link import event_window_plan, link_by_window
from emberlink.plans import standins as st
from emberlink.plans.articles import NAMES
from emberlink.plans.registry import query


def hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    union = hazards_union(st.wildfires(spark, sf_dir), st.landslides(spark, sf_dir))
    return union.withColumn("hazard_id", F.col("hazard_id").cast("long"))


@query(
    "hazards_union",
    f"SELECT hazard_id, disaster_type, round(latitude, 2) AS latitude, round(longitude, 2) AS longitude, strftime(event_date, '%Y-%m-%d') AS event_date FROM {st.HAZARDS_SQL} AS h",
)
def all_hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hazards(spark, sf_dir).select(
        "hazard_id", "disaster_type", F.round("latitude", 2).alias("latitude"), F.round("longitude", 2).alias("longitude"),
        F.col("event_date").cast("string").alias("event_date"),
    )


@query(
    "hazard_counts",
    f"""
    SELECT disaster_type, region, count(*) AS hazards
    FROM (SELECT *, {st.region_sql('latitude', 'longitude')} AS region FROM {st.HAZARDS_SQL} AS h)
    WHERE event_date >= DATE '{st.AS_OF}' - 30 GROUP BY ALL
    """,
)
def counts_of_hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hazards(spark, sf_dir).withColumn("region", region_of("latitude", "longitude", st.REGIONS))
    return hazard_counts(placed, st.AS_OF, by=("disaster_type", "region"))


@query(
    "event_window_plan",
    f"""
    SELECT hazard_id, disaster_type, strftime(event_date - 5, '%Y-%m-%d') AS from_date, strftime(event_date + 5, '%Y-%m-%d') AS to_date
    FROM {st.HAZARDS_SQL} AS h
    """,
)
def window_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = event_window_plan(hazards(spark, sf_dir))
    return plan.select(
        "hazard_id", "disaster_type", F.col("from_date").cast("string").alias("from_date"), F.col("to_date").cast("string").alias("to_date")
    )


_WINDOW_SQL = f"""
    WITH h AS (
        SELECT * FROM {st.HAZARDS_SQL} AS x WHERE event_date >= DATE '{st.AS_OF}' - 30),
    a AS (
        SELECT article_id, url, published_at::DATE AS day,
               {st.any_sql('description', st.TYPES['wildfire'])} AS fire, {st.any_sql('description', st.TYPES['landslide'])} AS slide
        FROM {st.ARTICLES_SQL} AS y WHERE {st.any_sql('description', st.PLACES)}),
    linked AS (
        SELECT article_id, url, disaster_type, hazard_id, event_date, row_number() OVER (
            PARTITION BY article_id ORDER BY CASE disaster_type WHEN 'wildfire' THEN 0 ELSE 1 END, hazard_id) AS rn
        FROM a JOIN h ON day BETWEEN event_date - 5 AND event_date + 5
            AND ((disaster_type = 'wildfire' AND fire) OR (disaster_type = 'landslide' AND slide)))
"""


@query(
    "event_window_join",
    _WINDOW_SQL
    + """
    SELECT article_id, disaster_type AS linked_disaster_type, hazard_id AS linked_disaster_id,
           strftime(event_date, '%Y-%m-%d') AS query_date
    FROM linked WHERE rn = 1
    """,
)
def event_window_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_by_window(
        st.articles(spark, sf_dir),
        hazards(spark, sf_dir),
        lexicon=st.TYPES,
        places=st.PLACES,
        fields="description",
        as_of=st.AS_OF,
    ).select(
        "article_id", "linked_disaster_type", "linked_disaster_id", F.col("query_date").cast("string").alias("query_date")
    )


@query(
    "news_ingest",
    _WINDOW_SQL
    + """
    SELECT article_id, url, disaster_type AS linked_disaster_type, hazard_id AS linked_disaster_id
    FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY article_id) AS first
          FROM linked WHERE rn = 1) WHERE first = 1
    """,
)
def news_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch import: link by date window, then keep the first article per url."""
    news = ingest_news(
        st.articles(spark, sf_dir), hazards(spark, sf_dir), lexicon=st.TYPES, places=st.PLACES, as_of=st.AS_OF
    )
    return news.select("article_id", "url", "linked_disaster_type", "linked_disaster_id")


def _space_time_sql(distance: str, extra: str, gate: str = "WHERE semantic_score >= 0.2") -> str:
    return f"""
    WITH a AS (
        SELECT article_id, published_at::DATE AS day, query_lat AS lat, query_lon AS lon{extra.format(lat='query_lat', lon='query_lon')}
        FROM {st.PLACED_ARTICLES_SQL} AS x {gate}),
    f AS (
        SELECT fire_id, acq_date AS day, latitude AS lat, longitude AS lon{extra.format(lat='latitude', lon='longitude')}
        FROM {st.WILDFIRES_SQL} AS y),
    pairs AS (
        SELECT article_id, fire_id, abs(date_diff('day', f.day, a.day)) AS apart, {distance} AS km
        FROM a JOIN f ON abs(date_diff('day', f.day, a.day)) <= 2 AND abs(a.lat - f.lat) <= 0.5),
    ranked AS (
        SELECT article_id, fire_id, km + 10 * apart AS cost, row_number() OVER (
            PARTITION BY article_id ORDER BY floor((km + 10 * apart) * 1e9 + 0.5), fire_id) AS rn
        FROM pairs WHERE km <= 50)
    SELECT article_id, fire_id AS linked_fire_id, round(cost, 2) AS match_score FROM ranked WHERE rn = 1
    """


_SPHERE = """2 * 6371.0088 * asin(sqrt(least(1.0,
    pow(sin(radians(f.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(f.lat)) * pow(sin(radians(f.lon - a.lon) / 2), 2))))"""

# The chord through the ellipsoid, bent by the turn of the surface normal along it.
_E2 = "0.0066943799901413165"
_UP = f""", cos(radians({{lat}})) * cos(radians({{lon}})) AS nx, cos(radians({{lat}})) * sin(radians({{lon}})) AS ny,
    sin(radians({{lat}})) AS nz, 6378.137 / sqrt(1 - {_E2} * pow(sin(radians({{lat}})), 2)) AS r"""
_CHORD = f"sqrt(pow(f.r * f.nx - a.r * a.nx, 2) + pow(f.r * f.ny - a.r * a.ny, 2) + pow((1 - {_E2}) * (f.r * f.nz - a.r * a.nz), 2))"
_TURN = f"""((f.nx - a.nx) * (f.r * f.nx - a.r * a.nx) + (f.ny - a.ny) * (f.r * f.ny - a.r * a.ny)
    + (f.nz - a.nz) * (1 - {_E2}) * (f.r * f.nz - a.r * a.nz))"""
_ELLIPSOID = f"""CASE WHEN {_CHORD} = 0 THEN 0 ELSE {_CHORD} * (1 + pow({_TURN} / {_CHORD}, 2) / 24
    + 3 * pow({_TURN} / {_CHORD}, 4) / 640) END"""


@query("link_space_time", _space_time_sql(_ELLIPSOID, _UP))
def space_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which fire does each article belong to? On the ellipsoid."""
    return link_space_time(st.placed_articles(spark, sf_dir), st.wildfires(spark, sf_dir))


@query("link_space_time_sphere", _space_time_sql(_SPHERE, "", ""))
def space_time_sphere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same on the sphere, and for all articles."""
    return link_space_time(
        st.placed_articles(spark, sf_dir), st.wildfires(spark, sf_dir), min_semantic=None, distance="sphere"
    )


@query("link_space_time_refined", _space_time_sql(_SPHERE, "", ""))
def space_time_refined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when cells are crowded: compare cells, drop losers, cut finer."""
    return link_space_time(
        st.placed_articles(spark, sf_dir), st.wildfires(spark, sf_dir), min_semantic=None, distance="sphere", max_per_cell=1
    )


def _semantic_sql(threshold: str, priority: bool) -> str:
    flag = (
        f""", CASE WHEN {st.any_sql("text", st.PRIORITY, case_sensitive=True)} THEN true END AS priority_match"""
        if priority
        else ""
    )
    return f"""
    WITH {st.VECTORS_SQL},
    pairs AS (
        SELECT a.vec_id AS article_id, e.vec_id AS event_id, e.disaster_type,
               round(list_cosine_similarity(a.vector, e.vector), 12) AS sim
        FROM typed AS a JOIN typed AS e ON a.disaster_type IS NULL AND e.disaster_type IS NOT NULL),
    best AS (
        SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY sim DESC, event_id) AS rn FROM pairs)
    SELECT article_id, round(sim, 4) AS semantic_score, event_id AS semantic_linked_disaster_id,
           disaster_type AS linked_disaster_type{flag}
    FROM best LEFT JOIN documents ON doc_id = article_id WHERE rn = 1 {threshold}
    """


def _vectors_with_text(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    articles, events = st.vectors(spark, sf_dir)
    texts = st.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("article_id"), "text")
    return articles.join(texts, "article_id", "left"), events


@query("semantic_link", _semantic_sql("AND sim >= 0.4", True))
def semantic_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles, events = _vectors_with_text(spark, sf_dir)
    return link_semantic(articles, events, text="text", priority_places=st.PRIORITY)


@query("semantic_top1", _semantic_sql("", False))
def semantic_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    articles, events = st.vectors(spark, sf_dir)
    return link_semantic(articles, events, threshold=None)


@query("semantic_top1_clustered", _semantic_sql("", False))
def semantic_top1_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the events are too many to broadcast."""
    articles, events = st.vectors(spark, sf_dir)
    return link_semantic(articles, events, threshold=None, max_broadcast_bytes=0, block_rows=64)


@query("semantic_bad_vectors", _semantic_sql("", False).replace("FROM pairs)", "FROM pairs WHERE article_id % 10 NOT IN (0, 3, 6) AND event_id % 10 NOT IN (0, 3, 6))"))
def semantic_bad_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three in ten vectors on both sides hold a NaN or a null, or are cut short: they are left out and touch nobody else."""

    def damaged(side: DataFrame, key: str) -> DataFrame:
        kind, v = F.col(key) % 10, F.col("vector").cast("array<double>")
        at_first = lambda x: F.concat(F.array(x.cast("double")), F.slice(v, F.lit(2), F.size(v) - 1))
        odd = F.when(kind == 0, at_first(F.lit("NaN"))).when(kind == 3, at_first(F.lit(None))).when(kind == 6, F.slice(v, 1, 3))
        return side.withColumn("vector", odd.otherwise(v))

    articles, events = st.vectors(spark, sf_dir)
    return link_semantic(damaged(articles, "article_id"), damaged(events, "event_id"), threshold=None)


_TEXT_VECTORS_SQL = f"""
    texts AS (
        SELECT 0 AS side, article_id AS id, NULL AS disaster_type, trim(concat_ws(' ', title, description)) AS text
        FROM {st.ARTICLES_SQL} AS a
        UNION ALL
        SELECT 1, hazard_id, disaster_type,
               disaster_type || ' in ' || latitude || ',' || longitude || ' on ' || strftime(event_date, '%Y-%m-%d')
        FROM {st.HAZARDS_SQL} AS h),
    counted AS (SELECT * FROM {gram_counts_sql('texts', 'side, id', 'text', 3, 64)}),
    seen AS (SELECT bucket, count(*) AS df FROM counted GROUP BY bucket),
    whole AS (SELECT count(*) AS m FROM texts WHERE length(text) > 0),
    weighted AS (
        SELECT side, id, bucket, n * ln((m + 1) / (df + 1)) AS w FROM counted JOIN seen USING (bucket) CROSS JOIN whole),
    listed AS (
        SELECT every.side AS side, every.id AS id, any_value(disaster_type) AS disaster_type, list(coalesce(w, 0) ORDER BY b) AS ws
        FROM (SELECT * FROM texts CROSS JOIN range(64) AS r(b) WHERE length(text) > 0) AS every
        LEFT JOIN weighted ON weighted.side = every.side AND weighted.id = every.id AND bucket = b
        GROUP BY every.side, every.id),
    vectors AS (
        SELECT side, id, disaster_type,
               list_transform(ws, lambda x: (x / sqrt(list_sum(list_transform(ws, lambda y: y * y))))::FLOAT::DOUBLE) AS v
        FROM listed)"""


def _texts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    news = st.articles(spark, sf_dir).withColumn("text", article_text())
    sentences = (
        hazards(spark, sf_dir)
        .withColumn("text", event_text())
        .select(F.col("hazard_id").alias("event_id"), "disaster_type", "text")
    )
    return news, sentences


@query(
    "text_grams",
    f"""
    SELECT doc_id, sum(n)::BIGINT AS grams, count(*) AS buckets, md5(string_agg(bucket || ':' || n, ',' ORDER BY bucket)) AS counts
    FROM {gram_counts_sql('documents', 'doc_id', 'text')} GROUP BY doc_id
    """,
)
def text_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The count stage of the encoders, over whole texts."""
    counted = st.table(spark, sf_dir, "documents").select("doc_id", gram_counts("text").alias("grams")).where(F.size("grams") > 0)
    shown = F.transform("grams", lambda g: F.concat_ws(":", g["bucket"].cast("string"), g["n"].cast("string")))
    return counted.select(
        "doc_id",
        F.aggregate("grams", F.lit(0).cast("long"), lambda s, g: s + g["n"]).alias("grams"),
        F.size("grams").cast("long").alias("buckets"),
        F.md5(F.concat_ws(",", shown)).alias("counts"),
    )


@query(
    "semantic_text",
    f"""
    WITH {_TEXT_VECTORS_SQL},
    pairs AS (
        SELECT a.id AS article_id, e.id AS event_id, e.disaster_type, round(list_cosine_similarity(a.v, e.v), 12) AS sim
        FROM vectors AS a JOIN vectors AS e ON a.side = 0 AND e.side = 1),
    best AS (SELECT *, row_number() OVER (PARTITION BY article_id ORDER BY sim DESC, event_id) AS rn FROM pairs)
    SELECT article_id, round(sim, 4) AS semantic_score, event_id AS semantic_linked_disaster_id,
           disaster_type AS linked_disaster_type
    FROM best WHERE rn = 1
    """,
)
def semantic_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles and hazard sentences through the built-in encoder."""
    news, sentences = _texts(spark, sf_dir)
    a, e = encode_hashed((news.select("article_id", "text"), "text"), (sentences, "text"), width=64, keep_text=False)
    return link_semantic(a, e, threshold=None)


@query("semantic_dense")
def semantic_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same through the dense encoder; singular vectors have no SQL form."""
    news, sentences = _texts(spark, sf_dir)
    a, e = encode_dense((news.select("article_id", "text"), "text"), (sentences, "text"), dims=32, width=4096, keep_text=False)
    return link_semantic(a, e, threshold=None)


@query(
    "linked_articles",
    f"""
    SELECT 'set' AS rule, article_id FROM {st.ENRICHED_SQL} AS a WHERE linked_fire_id IS NOT NULL
    UNION ALL
    SELECT 'exists', article_id FROM {st.ENRICHED_SQL} AS b
    WHERE linked_fire_id IN (SELECT fire_id FROM {st.WILDFIRES_SQL} AS w)
    """,
)
def linked_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.enriched(spark, sf_dir)
    named = linked_only(e).select(F.lit("set").alias("rule"), "article_id")
    known = linked_only(e, st.wildfires(spark, sf_dir)).select(F.lit("exists").alias("rule"), "article_id")
    return named.unionByName(known)


_CHAIN_LINKS = _space_time_sql(_ELLIPSOID, _UP).strip()


@query(
    "enrich_chain",
    f"""
    WITH links AS ({_CHAIN_LINKS}),
    scored AS (
        SELECT d.doc_id AS article_id, d.source AS title, d.text,
               ({st.any_sql('d.text', st.TYPES['wildfire'])}::INT + {st.any_sql('d.text', st.PLACES)}::INT) / 2.0::DOUBLE AS relevance_score
        FROM documents AS d)
    SELECT s.title AS "Title", {st.region_sql('p.query_lat', 'p.query_lon')} AS "Region", relevance_score AS "Relevance",
           round(p.semantic_score, 4) AS "Semantic", l.match_score AS "Match",
           array_to_string(list_filter(regexp_extract_all(s.text, '[\\p{{L}}\\p{{N}}]+'),
               lambda w: w IN ('The', 'Der', 'La', 'And', 'Und', 'El')), ', ') AS "Entities"
    FROM scored AS s JOIN {st.PLACED_ARTICLES_SQL} AS p ON p.article_id = s.article_id
    JOIN links AS l ON l.article_id = s.article_id
    WHERE relevance_score >= 0.5
    """,
)
def enrich_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichment end to end: relevance, link, entities, region, dashboard table."""
    placed = st.placed_articles(spark, sf_dir)
    news = st.articles(spark, sf_dir).drop("published_at").join(placed, "article_id")
    enriched = enrich(
        news,
        st.wildfires(spark, sf_dir),
        hazard_terms=st.TYPES["wildfire"],
        place_terms=st.PLACES,
        gazetteer=NAMES,
        regions=st.REGIONS,
    )
    view = dashboard_filter(dashboard_view(linked_only(enriched)), min_relevance=0.5)
    return view.select(
        "Title", "Region", "Relevance", F.round("Semantic", 4).alias("Semantic"), "Match", "Entities"
    )


_SEMANTIC_FOUND = _semantic_sql("AND sim >= 0.4", True).strip()
_WHOLE_LINKS = _CHAIN_LINKS.replace(st.PLACED_ARTICLES_SQL, "art")


@query(
    "enrich_whole",
    f"""
    WITH sem AS ({_SEMANTIC_FOUND}),
    art AS (
        SELECT d.doc_id AS article_id, d.text, p.published_at, p.query_lat, p.query_lon, coalesce(sem.semantic_score, p.semantic_score) AS semantic_score,
               sem.semantic_linked_disaster_id, sem.linked_disaster_type, sem.priority_match
        FROM documents AS d LEFT JOIN {st.PLACED_ARTICLES_SQL} AS p ON p.article_id = d.doc_id
        LEFT JOIN sem ON sem.article_id = d.doc_id AND length(trim(concat(d.source, ' ', d.text))) > 0),
    links AS ({_WHOLE_LINKS})
    SELECT art.article_id, ({st.any_sql('art.text', st.TYPES['wildfire'])}::INT + {st.any_sql('art.text', st.PLACES)}::INT) / 2.0::DOUBLE AS relevance,
           round(semantic_score, 4) AS semantic_score, semantic_linked_disaster_id, linked_disaster_type, priority_match, linked_fire_id, match_score
    FROM art LEFT JOIN links USING (article_id)
    """,
)
def enrich_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps over all articles, in order: the space-time link is gated by the score the semantic step has just set."""
    vectors, events = st.vectors(spark, sf_dir)
    news = st.articles(spark, sf_dir).drop("published_at").join(st.placed_articles(spark, sf_dir), "article_id", "left")
    enriched = enrich(
        news.join(vectors, "article_id", "left"),
        st.wildfires(spark, sf_dir),
        event_vectors=events,
        hazard_terms=st.TYPES["wildfire"],
        place_terms=st.PLACES,
        gazetteer=NAMES,
        semantic_options={"priority_places": st.PRIORITY},
    )
    return enriched.select(
        "article_id", F.col("relevance_score").alias("relevance"), F.round("semantic_score", 4).alias("semantic_score"), "semantic_linked_disaster_id",
        "linked_disaster_type", "priority_match", "linked_fire_id", "match_score",
    )
