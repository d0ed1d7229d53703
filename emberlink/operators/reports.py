"""Counts, samples and the tables behind the dashboard."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from emberlink.operators.filters import with_coordinates

ENRICHED_FIELDS = ("semantic_score", "relevance_score", "linked_fire_id", "match_score", "entities")


def run_metrics(
    df: DataFrame, by: Iterable[str], reasons: Mapping[str, Column] | None = None, totals: bool = True
) -> DataFrame:
    """Rows per group, and per skip reason.

    ``totals`` adds subtotals, whose group columns are null; ``level`` tells them from groups whose
    value is null: 0 for a group, and a bit for each column that is summed over, the last being 1.
    """
    by = list(by)
    counts = [F.count(F.lit(1)).alias("rows")] + [
        F.count_if(condition).alias(f"skipped_{name}") for name, condition in (reasons or {}).items()
    ]
    if not totals:
        return df.groupBy(*by).agg(*counts)
    return df.rollup(*by).agg(F.grouping_id().cast("int").alias("level"), *counts)


def latest_per_group(
    df: DataFrame, group: str | Iterable[str], ts: str, n: int, tie: str | Iterable[str]
) -> DataFrame:
    """The newest ``n`` rows per group. Every map task passes on at most ``n`` rows per group."""
    groups = [group] if isinstance(group, str) else list(group)
    ties = [tie] if isinstance(tie, str) else list(tie)
    newest = Window.partitionBy(*groups).orderBy(F.col(ts).desc(), *ties)
    return df.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n)


def linked_only(articles: DataFrame, fires: DataFrame | None = None) -> DataFrame:
    """Articles with a linked fire; given ``fires``, only where that fire exists."""
    linked = articles.where(F.col("linked_fire_id").isNotNull())
    if fires is None:
        return linked
    known = fires.select(F.col("fire_id").alias("linked_fire_id")).distinct()
    return linked.join(known, "linked_fire_id", "left_semi").select(*articles.columns)


def sample_enriched(
    df: DataFrame, n: int = 3, order: str = "article_id", fields: Iterable[str] = ENRICHED_FIELDS
) -> DataFrame:
    """The first ``n`` articles that went through every enrichment step."""
    for field in fields:
        df = df.where(F.col(field).isNotNull())
    return df.orderBy(order).limit(n)


def dashboard_view(articles: DataFrame) -> DataFrame:
    """The eleven columns the dashboard shows."""
    names = F.array_join(F.transform("entities", lambda e: e["text"]), ", ")
    return articles.select(
        F.col("title").alias("Title"),
        F.col("source").alias("Source"),
        F.col("published_at").alias("Published"),
        F.col("query_region").alias("Region"),
        F.col("url").alias("URL"),
        F.col("relevance_score").alias("Relevance"),
        F.col("semantic_score").alias("Semantic"),
        F.col("match_score").alias("Match"),
        F.col("query_lat").alias("Lat"),
        F.col("query_lon").alias("Lon"),
        F.coalesce(names, F.lit("")).alias("Entities"),
    )


def dashboard_filter(
    view: DataFrame, regions: Iterable[str] | None = None, min_relevance: float = 0.0
) -> DataFrame:
    """Chosen regions (none chosen means all) and a least relevance; unscored rows drop out."""
    regions = list(regions or [])
    if regions:
        view = view.where(F.col("Region").isin(*regions))
    return view.where(F.col("Relevance") >= F.lit(float(min_relevance)))


def region_options(view: DataFrame, column: str = "Region") -> DataFrame:
    """Distinct regions in order."""
    return view.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)


def fire_points(fires: DataFrame) -> DataFrame:
    """Fires as map points with a label."""
    return with_coordinates(fires, "latitude", "longitude").select(
        "fire_id",
        "latitude",
        "longitude",
        F.concat(F.lit("Fire: "), F.col("acq_date").cast("string")).alias("label"),
    )


def map_points(view: DataFrame) -> DataFrame:
    """Articles that can be placed on the map."""
    return with_coordinates(view, "Lat", "Lon").select("Title", "Published", "URL", "Lat", "Lon")


def density_grid(
    df: DataFrame, cell_deg: float, weight: str | None = None, latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Points, and the sum of ``weight``, per grid cell."""
    def index(column: str) -> Column:
        return F.floor(F.col(column) / F.lit(float(cell_deg))).cast("long")

    measures = [F.count(F.lit(1)).alias("points")]
    if weight:
        measures.append(F.sum(weight).alias("weight"))
    return (
        with_coordinates(df, latitude, longitude)
        .groupBy(index(latitude).alias("cell_lat"), index(longitude).alias("cell_lon"))
        .agg(*measures)
    )


def heat_layer(
    df: DataFrame, cell_deg: float, sigma: float, reach: int, weight: str | None = None,
    latitude: str = "latitude", longitude: str = "longitude",
) -> DataFrame:
    """``(cell_lat, cell_lon, heat)``: a Gaussian of ``sigma`` cells laid over the counts, or the sums of ``weight``, of a grid.

    The kernel is cut at ``reach`` cells and adds up to one. It is separable, so each cell is spread along one axis and then along the
    other: 2 * (2 * reach + 1) rows a cell and not the square, and the rows are cells, however many points there are. The world is
    round in longitude; what would fall beyond a pole is left out. Rows without a place, with one that is not finite, or
    without a weight add nothing; no rows give no cells.
    """
    columns = round(360.0 / cell_deg)
    if abs(columns * cell_deg - 360.0) > 1e-9:
        raise ValueError("a whole turn must be a whole number of cells")
    rows = columns // 2
    if 2 * reach + 1 > columns:
        raise ValueError("the kernel is wider than the world")
    raw = [math.exp(-(k * k) / (2.0 * sigma * sigma)) for k in range(-reach, reach + 1)]
    kernel = F.array(*[F.struct(F.lit(k).cast("long").alias("by"), F.lit(v / sum(raw)).alias("share")) for k, v in zip(range(-reach, reach + 1), raw)])

    def spread(cells: DataFrame, axis: str) -> DataFrame:
        moved = cells.withColumn("__k", F.explode(kernel)).withColumn(axis, F.col(axis) + F.col("__k.by"))
        if axis == "cell_lon":
            moved = moved.withColumn(axis, F.pmod(F.col(axis) + columns // 2, F.lit(columns)) - columns // 2)
        return moved.groupBy("cell_lat", "cell_lon").agg(F.sum(F.col("heat") * F.col("__k.share")).alias("heat"))

    placed = df.where((F.abs(latitude) <= 90) & (F.abs(longitude) <= 180))
    grid = density_grid(placed, cell_deg, weight, latitude, longitude)
    heat = (F.col("weight") if weight else F.col("points")).cast("double")
    cells = grid.select("cell_lat", "cell_lon", heat.alias("heat")).where("heat IS NOT NULL")
    along = spread(cells, "cell_lat").where((F.col("cell_lat") >= -((rows + 1) // 2)) & (F.col("cell_lat") <= rows // 2))
    return spread(along, "cell_lon")


def cluster_points(
    df: DataFrame, zooms: Iterable[int], latitude: str = "latitude", longitude: str = "longitude"
) -> DataFrame:
    """Marker clusters: per zoom level and cell, the number of points and their centre.

    A cell at zoom z is 90 / 2^z degrees. Cells nest, so points are counted once, at the finest
    zoom, and the coarser zooms add up those counts: raw rows are not multiplied by the zooms.
    """
    zooms = sorted(set(zooms))
    finest = zooms[-1]

    def index(column: str) -> Column:
        return F.floor(F.col(column) * F.lit(2.0**finest / 90.0)).cast("long")

    cells = (
        with_coordinates(df, latitude, longitude)
        .groupBy(index(latitude).alias("fine_lat"), index(longitude).alias("fine_lon"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(latitude).alias("lat_sum"), F.sum(longitude).alias("lon_sum"))
    )
    levels = F.explode(F.array(*[F.lit(z) for z in zooms]))
    up = F.pow(F.lit(2.0), F.lit(finest) - F.col("zoom"))
    return (
        cells.withColumn("zoom", levels)
        .groupBy(
            "zoom",
            F.floor(F.col("fine_lat") / up).cast("long").alias("cell_lat"),
            F.floor(F.col("fine_lon") / up).cast("long").alias("cell_lon"),
        )
        .agg(F.sum("n").alias("points"), F.sum("lat_sum").alias("lat_sum"), F.sum("lon_sum").alias("lon_sum"))
        .select(
            "zoom", "cell_lat", "cell_lon", "points",
            (F.col("lat_sum") / F.col("points")).alias("center_lat"),
            (F.col("lon_sum") / F.col("points")).alias("center_lon"),
        )
    )
