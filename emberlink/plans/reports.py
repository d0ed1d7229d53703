"""Queries behind the dashboard and the run report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from emberlink.functions.text import match_any
from emberlink.operators import markers, reports
from emberlink.operators.classify import region_of
from emberlink.operators.entities import entities
from emberlink.plans import standins as st
from emberlink.plans.articles import NAMES
from emberlink.plans.registry import query


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.enriched(spark, sf_dir).join(
        st.placed_articles(spark, sf_dir).select("article_id", "query_lat", "query_lon"), "article_id", "left"
    )
    ready = e.withColumns(
        {
            "entities": F.when(F.col("linked_fire_id").isNotNull(), entities("description", NAMES)),
            "query_region": region_of("query_lat", "query_lon", st.REGIONS),
        }
    )
    return reports.dashboard_view(ready)


_VIEW_SQL = f"""
    view AS (
        SELECT title AS "Title", source AS "Source", strftime(published_at, '%Y-%m-%d') AS "Published",
               {st.region_sql('query_lat', 'query_lon')} AS "Region", url AS "URL", relevance_score AS "Relevance",
               semantic_score AS "Semantic", match_score AS "Match",
               round(query_lat, 4) AS "Lat", round(query_lon, 4) AS "Lon",
               CASE WHEN linked_fire_id IS NULL THEN '' ELSE array_to_string(list_filter(
                   regexp_extract_all(description, '[\\p{{L}}\\p{{N}}]+'),
                   lambda w: w IN ('The', 'Der', 'La', 'And', 'Und', 'El')), ', ') END AS "Entities"
        FROM (SELECT e.*, p.query_lat, p.query_lon FROM {st.ENRICHED_SQL} AS e
              LEFT JOIN {st.PLACED_ARTICLES_SQL} AS p ON p.article_id = e.article_id))"""


def _shown(view: DataFrame) -> DataFrame:
    changed = {
        "Published": F.date_format("Published", "yyyy-MM-dd"),
        "Lat": F.round("Lat", 4),
        "Lon": F.round("Lon", 4),
    }
    return view.withColumns({k: v for k, v in changed.items() if k in view.columns})


@query("dashboard_view", f"WITH {_VIEW_SQL} SELECT * FROM view")
def dashboard_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_view(spark, sf_dir))


@query(
    "dashboard_filter",
    f"""
    WITH {_VIEW_SQL}
    SELECT 'chosen' AS choice, "URL", "Region", "Relevance" FROM view
    WHERE "Region" IN ('Alpine', 'North') AND "Relevance" >= 0.5
    UNION ALL SELECT 'all', "URL", "Region", "Relevance" FROM view WHERE "Relevance" >= 0
    """,
)
def dashboard_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    view = _view(spark, sf_dir).select("URL", "Region", "Relevance")
    chosen = reports.dashboard_filter(view, ["Alpine", "North"], 0.5).withColumn("choice", F.lit("chosen"))
    everything = reports.dashboard_filter(view, [], 0.0).withColumn("choice", F.lit("all"))
    return chosen.unionByName(everything)


@query(
    "map_points",
    f"""WITH {_VIEW_SQL} SELECT "Title", "Published", "URL", "Lat", "Lon" FROM view WHERE "Lat" IS NOT NULL AND "Lon" IS NOT NULL""",
)
def map_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(reports.map_points(_view(spark, sf_dir)))


@query(
    "fire_points",
    f"""
    SELECT fire_id, round(latitude, 4) AS latitude, round(longitude, 4) AS longitude,
           'Fire: ' || strftime(acq_date, '%Y-%m-%d') AS label FROM {st.WILDFIRES_SQL} AS w
    """,
)
def fire_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = reports.fire_points(st.wildfires(spark, sf_dir))
    return points.withColumns({c: F.round(c, 4) for c in ("latitude", "longitude")})


@query(
    "region_options",
    f"""
    SELECT DISTINCT region FROM (SELECT {st.region_sql('query_lat', 'query_lon')} AS region FROM {st.PLACED_ARTICLES_SQL} AS a)
    WHERE region IS NOT NULL ORDER BY region
    """,
)
def region_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = st.placed_articles(spark, sf_dir).select(region_of("query_lat", "query_lon", st.REGIONS).alias("region"))
    return reports.region_options(placed, "region")


@query(
    "fire_density",
    f"""
    SELECT floor(latitude / 0.25)::BIGINT AS cell_lat, floor(longitude / 0.25)::BIGINT AS cell_lon,
           count(*) AS points, round(sum(frp), 4) AS weight
    FROM {st.WILDFIRES_SQL} AS w GROUP BY ALL
    """,
)
def fire_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = reports.density_grid(st.wildfires(spark, sf_dir), 0.25, "frp")
    return grid.withColumn("weight", F.round("weight", 4))


@query(
    "point_clusters",
    f"""
    SELECT zoom, floor(query_lat * 32 / 90 / pow(2, 5 - zoom))::BIGINT AS cell_lat,
           floor(query_lon * 32 / 90 / pow(2, 5 - zoom))::BIGINT AS cell_lon, count(*) AS points,
           round(avg(query_lat), 6) AS center_lat, round(avg(query_lon), 6) AS center_lon
    FROM {st.PLACED_ARTICLES_SQL} AS a, (VALUES (0), (2), (3), (5)) AS z(zoom) GROUP BY ALL
    """,
)
def point_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = reports.cluster_points(st.placed_articles(spark, sf_dir), [0, 2, 3, 5], "query_lat", "query_lon")
    return clusters.withColumns({c: F.round(c, 6) for c in ("center_lat", "center_lon")})


@query(
    "fire_heat",
    f"""
    WITH cells AS (
        SELECT floor(latitude / 0.25)::BIGINT AS y, floor(longitude / 0.25)::BIGINT AS x, sum(frp) AS weight
        FROM {st.WILDFIRES_SQL} AS w GROUP BY ALL),
    kernel AS (SELECT k, exp(-(k * k) / 4.5::DOUBLE) AS v FROM range(-4, 5) AS r(k)),
    shares AS (SELECT k, v / (SELECT sum(v) FROM kernel) AS share FROM kernel)
    SELECT y + a.k AS cell_lat, (x + b.k + 720 + 1440) % 1440 - 720 AS cell_lon, round(sum(weight * a.share * b.share), 6) AS heat
    FROM cells CROSS JOIN shares AS a CROSS JOIN shares AS b WHERE y + a.k BETWEEN -360 AND 360 GROUP BY ALL
    """,
)
def fire_heat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole kernel in the SQL, one axis after the other here."""
    heat = reports.heat_layer(st.wildfires(spark, sf_dir), 0.25, 1.5, 4, "frp")
    return heat.withColumn("heat", F.round("heat", 6))


@query("marker_clusters")
def marker_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy clusters as a map shows them; the greedy rule has no SQL form."""
    clusters = markers.marker_clusters(st.placed_articles(spark, sf_dir), [4, 6, 8], "query_lat", "query_lon")
    return clusters.withColumns({c: F.round(c, 6) for c in ("center_lat", "center_lon")})


@query(
    "ingest_counts",
    f"""
    SELECT source_type, kind AS type, grouping(source_type, kind)::INTEGER AS level, count(*) AS rows, count_if(kind IS NULL) AS skipped_no_keyword,
           count_if(NOT place) AS skipped_no_place
    FROM (SELECT source_type, {st.type_sql("body")} AS kind, {st.any_sql('body', st.PLACES)} AS place
          FROM (SELECT 'newsapi' AS source_type, text AS body FROM documents
                UNION ALL SELECT 'google_rss', html FROM pages
                UNION ALL SELECT 'reddit', text FROM conversations))
    GROUP BY ROLLUP (source_type, kind)
    """,
)
def ingest_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from emberlink.functions.text import first_type

    parts = [
        st.table(spark, sf_dir, name).select(F.lit(kind).alias("source_type"), F.col(body).alias("body"))
        for name, kind, body in (
            ("documents", "newsapi", "text"), ("pages", "google_rss", "html"), ("conversations", "reddit", "text"),
        )
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    typed = union.select("source_type", first_type("body", st.TYPES).alias("type"), match_any("body", st.PLACES).alias("place"))
    return reports.run_metrics(
        typed, ["source_type", "type"], {"no_keyword": F.col("type").isNull(), "no_place": ~F.col("place")}
    )


@query(
    "latest_per_group",
    """
    SELECT event_id, user_id, rank FROM (
        SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rank FROM events)
    WHERE rank <= 3
    """,
)
def latest_per_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = reports.latest_per_group(st.table(spark, sf_dir, "events"), "user_id", "ts", 3, "event_id")
    return latest.select("event_id", "user_id", F.col("rank").cast("long").alias("rank"))


@query(
    "latest_per_search",
    f"""
    SELECT article_id, language, keyword AS cell_keyword, rank FROM (
        SELECT article_id, language, keyword, row_number() OVER (
            PARTITION BY language, keyword ORDER BY published_at DESC, article_id) AS rank
        FROM {st.ARTICLES_SQL} AS a,
             (VALUES {', '.join(f"('{t}')" for terms in st.TYPES.values() for t in terms)}) AS k(keyword)
        WHERE contains(lower(description), keyword))
    WHERE rank <= 50
    """,
)
def latest_per_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest 50 articles of every search cell."""
    from emberlink.functions.text import matching_terms

    terms = [t for group in st.TYPES.values() for t in group]
    cells = st.articles(spark, sf_dir).select(
        "article_id", "language", "published_at", F.explode(matching_terms("description", terms)).alias("cell_keyword")
    )
    latest = reports.latest_per_group(cells, ["language", "cell_keyword"], "published_at", 50, "article_id")
    return latest.select("article_id", "language", "cell_keyword", F.col("rank").cast("long").alias("rank"))


@query(
    "sample_enriched",
    f"""
    SELECT article_id, relevance_score, semantic_score, match_score FROM {st.ENRICHED_SQL} AS e
    WHERE relevance_score IS NOT NULL AND semantic_score IS NOT NULL AND linked_fire_id IS NOT NULL
      AND match_score IS NOT NULL ORDER BY article_id LIMIT 3
    """,
)
def sample_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = st.enriched(spark, sf_dir).withColumn(
        "entities", F.when(F.col("linked_fire_id").isNotNull(), entities("description", NAMES))
    )
    return reports.sample_enriched(e).select("article_id", "relevance_score", "semantic_score", "match_score")
