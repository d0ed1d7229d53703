"""Space-time nearest: link each article to the hazard that is closest in place and day.

Cost is ``km + day_weight * |days apart|`` within ``days`` and ``km``; the lowest cost wins and,
among equals, the first hazard in store order.

Two things keep this join linear. Copies collapse first: articles at one place and day share
one answer, hazards at one place and day are represented by the first of them. Then both sides
meet in grid cells, one equi-join on (day, cell). For the hazards of a cell that holds many on a day,
pairs are not built: cells are compared by their bounding boxes, pairs that cannot win are
dropped, and the rest is cut finer until few hazards are left per cell. The bounds are safe, so
the result is the exact minimum either way.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from emberlink import lexicons as lx
from emberlink.functions import geo
from emberlink.session import cut_lineage

MAX_PER_CELL = 64
_SPLIT = 4
_MAX_DEPTH = 9
_RANKS = Decimal(10) ** 19  # more than any long


def link_space_time(
    articles: DataFrame,
    fires: DataFrame,
    days: int = lx.LINK_DAYS,
    km: float = lx.LINK_KM,
    day_weight: float = lx.LINK_DAY_WEIGHT,
    min_semantic: float | None = lx.LINK_MIN_SEMANTIC,
    distance: str = "ellipsoid",
    order: str | Column = "fire_id",
    max_per_cell: int = MAX_PER_CELL,
) -> DataFrame:
    """``(article_id, linked_fire_id, match_score)`` for every article that has a fire in reach.

    Copies of an article at one place and day are one row of the result.
    ``articles``: article_id, published_at, query_lat, query_lon and, unless ``min_semantic``
    is None, semantic_score. ``fires``: fire_id, latitude, longitude, acq_date and ``order``.
    """
    order = F.col(order) if isinstance(order, str) else order
    wanted = articles
    if min_semantic is not None:
        wanted = wanted.where(F.col("semantic_score") >= F.lit(min_semantic))
    placed = wanted.select(
        "article_id",
        F.col("query_lat").alias("lat"),
        F.col("query_lon").alias("lon"),
        F.to_date("published_at").alias("day"),
    ).where("lat IS NOT NULL AND lon IS NOT NULL AND day IS NOT NULL").distinct()
    spots = (
        fires.select(
            F.col("latitude").alias("lat"),
            F.col("longitude").alias("lon"),
            F.col("acq_date").cast("date").alias("day"),
            order.alias("ord"),
            F.col("fire_id"),
        )
        .where("lat IS NOT NULL AND lon IS NOT NULL AND day IS NOT NULL")
        .groupBy("lat", "lon", "day")
        .agg(F.min(F.struct("ord", "fire_id")).alias("first"))
    )
    points = placed.select("lat", "lon", "day").distinct()
    best = nearest(points, spots, days, km, day_weight, distance, max_per_cell)
    return placed.join(best, ["lat", "lon", "day"]).select(
        "article_id",
        F.col("best.first.fire_id").alias("linked_fire_id"),
        F.round(F.col("best.cost") / F.lit(1e9), 2).alias("match_score"),
    )


def nearest(
    points: DataFrame,
    spots: DataFrame,
    days: int,
    km: float,
    day_weight: float,
    distance: str = "ellipsoid",
    max_per_cell: int = MAX_PER_CELL,
) -> DataFrame:
    """Lowest-cost spot per point: ``(lat, lon, day, best: struct<cost, first>)``, cost in 1e-9.

    ``points``: distinct (lat, lon, day). ``spots``: distinct (lat, lon, day) with ``first``,
    the struct that identifies the spot and breaks ties.
    """
    cell_deg = km / 100.0
    # Spots in the order of ``first``: ids that grow from one range partition to the next.
    ordered = spots.sort("first").withColumn("rank", F.monotonically_increasing_id())
    ordered = cut_lineage(ordered, "spots")
    spots = geo.add_place(ordered.drop("first"), "lat", "lon", "s_", distance)
    points = geo.add_place(points, "lat", "lon", "p_", distance)
    sparse, dense = _by_crowding(spots, cell_deg, max_per_cell)
    pairs = _pairs_by_cell(points, sparse, days, km, cell_deg)
    if dense is not None:
        columns = ["lat", "lon", "day", "rank", "apart", *geo.place_columns("p_", distance), *geo.place_columns("s_", distance)]
        refined = _pairs_by_refinement(points, dense, days, km, day_weight, cell_deg, distance, max_per_cell)
        pairs = pairs.select(*columns).unionByName(refined.select(*columns))
    measured = geo.add_km(pairs, "p_", "s_", distance, within=km)
    # In micrometres and whole, so that costs that differ only by rounding noise tie.
    cost = F.col("km") + F.lit(float(day_weight)) * F.col("apart")
    whole = F.floor(cost * F.lit(1e9) + F.lit(0.5)).cast("long")
    # Cost and rank in one number, so that the minimum is a hash aggregate. The limit is tested
    # inside it: as a filter it would be pushed below the projection, and the distance computed twice.
    packed = whole.cast("decimal(18,0)").cast("decimal(38,0)") * F.lit(_RANKS) + F.col("rank").cast("decimal(19,0)")
    near = F.when(F.col("km") <= F.lit(float(km)), packed.cast("decimal(38,0)"))
    best = measured.groupBy("lat", "lon", "day").agg(F.min(near).alias("packed")).where("packed is not null")
    rank = (F.col("packed") % F.lit(_RANKS)).cast("long")
    cost = ((F.col("packed") - F.col("packed") % F.lit(_RANKS)) / F.lit(_RANKS)).cast("long")
    named = best.select("lat", "lon", "day", rank.alias("rank"), cost.alias("cost")).join(ordered.select("rank", "first"), "rank")
    return named.select("lat", "lon", "day", F.struct("cost", "first").alias("best"))


def _by_crowding(spots: DataFrame, cell_deg: float, max_per_cell: int) -> tuple[DataFrame, DataFrame | None]:
    """Spots in cells that hold few of them on their day, and the others (None: there are none).

    A point's best spot is the better of its best in either part, so one crowded cell costs the
    points around it and no others.
    """
    placed = geo.add_cell(spots, "lat", "lon", cell_deg, "__row", "__col", 1)
    cell = ["day", "__row", "__col"]
    crowded = placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max_per_cell).select(*cell)
    if crowded.isEmpty():
        return spots, None
    return placed.join(crowded, cell, "left_anti").select(*spots.columns), placed.join(crowded, cell, "left_semi").select(*spots.columns)


def _fullest_cell(spots: DataFrame, cell_deg: float, splits: int) -> int:
    """Most spots that share a cell and a day; one number, whatever the data size."""
    counts = geo.add_cell(spots, "lat", "lon", cell_deg, "row", "col", splits).groupBy(
        "day", "row", "col"
    ).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def _nearby_days(day: Column, days: int) -> Column:
    return F.explode(F.sequence(F.date_sub(day, days), F.date_add(day, days)))


def _apart(one: str, other: str) -> Column:
    return F.abs(F.date_diff(F.col(one), F.col(other))).cast("double")


def _pairs_by_cell(
    points: DataFrame, spots: DataFrame, days: int, km: float, cell_deg: float
) -> DataFrame:
    """Every point with every spot that shares a reachable cell and a reachable day.

    A point spreads over days and a spot over cells; a pair meets exactly once. Points are few
    bytes but many pairs each, so they keep all shuffle partitions: by size alone, adaptive
    execution would put them into a handful of tasks. The final minimum reuses the partitioning.
    """
    tasks = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = points.repartition(tasks, "lat", "lon", "day")
    left = geo.add_cell(points, "lat", "lon", cell_deg, "row", "col").withColumn(
        "s_day", _nearby_days(F.col("day"), days)
    )
    right = geo.touched_cells(
        spots.withColumnsRenamed({"lat": "s_lat", "lon": "s_lon", "day": "s_day"}),
        "s_lat", "s_lat", "s_lon", "s_lon", km, cell_deg, "row", "col",
    )
    reach = geo.reach_degrees(km)
    return (
        left.join(right, ["s_day", "row", "col"])
        .where(F.abs(F.col("lat") - F.col("s_lat")) <= F.lit(reach))
        .withColumn("apart", _apart("day", "s_day"))
    )


def _boxes(df: DataFrame, cell_deg: float, splits: int, prefix: str) -> DataFrame:
    """Bounding box per occupied (day, cell)."""
    p = prefix
    placed = geo.add_cell(df, "lat", "lon", cell_deg, "row", "col", splits).selectExpr(
        "*", f"{geo.lon360_sql('lon')} AS lon360"
    )
    return (
        placed.groupBy("day", "row", "col")
        .agg(
            F.min("lat").alias(f"{p}_lat0"),
            F.max("lat").alias(f"{p}_lat1"),
            F.min("lon360").alias(f"{p}_lon0"),
            F.max("lon360").alias(f"{p}_lon1"),
        )
        .withColumnsRenamed({"day": f"{p}_day", "row": f"{p}_row", "col": f"{p}_col"})
    )


_BOX = ["lat0", "lat1", "lon0", "lon1"]
_CELL = ["day", "row", "col"]


def _drop_losers(
    pairs: DataFrame, km: float, day_weight: float, distance: str
) -> DataFrame:
    """Keep a pair of cells unless another spot cell is certainly better for all its points."""
    def middle(p: str, axis: str) -> str:
        return f"({p}_{axis}0 + {p}_{axis}1) / 2.0D"

    def radius(p: str) -> str:
        # Along the parallel to the corner's meridian, then along that meridian.
        return (
            f"radians({p}_lat1 - {p}_lat0) / 2.0D"
            f" + radians({p}_lon1 - {p}_lon0) / 2.0D * cos(radians({middle(p, 'lat')}))"
        )

    margin = geo.ELLIPSOID_MARGIN if distance == "ellipsoid" else 1e-9
    between = geo.sphere_km_sql(middle("a", "lat"), middle("a", "lon"), middle("s", "lat"), middle("s", "lon"))
    spread = f"{geo.EARTH_RADIUS_KM}D * ({radius('a')} + {radius('s')})"
    wait = F.lit(float(day_weight)) * _apart("a_day", "s_day")
    slack = "1e-6D"
    bounded = (
        pairs.selectExpr("*", f"{between} AS __between", f"{spread} AS __spread")
        .selectExpr(
            "*",
            f"greatest(0.0D, __between - __spread) * {1 - margin!r}D - {slack} AS __low",
            f"(__between + __spread) * {1 + margin!r}D + {slack} AS __high",
        )
        .where(F.col("__low") <= F.lit(float(km)))
    )
    # A cell pair promises a match only when even its far corners are within reach.
    promise = F.when(F.col("__high") <= F.lit(float(km)), F.col("__high") + wait)
    own_cell = Window.partitionBy(*[f"a_{k}" for k in _CELL])
    kept = bounded.withColumn("__limit", F.min(promise).over(own_cell)).where(
        F.col("__limit").isNull() | (F.col("__low") + wait <= F.col("__limit"))
    )
    return kept.select(*[f"{p}_{k}" for p in ("a", "s") for k in _CELL])


def _pairs_by_refinement(
    points: DataFrame,
    spots: DataFrame,
    days: int,
    km: float,
    day_weight: float,
    cell_deg: float,
    distance: str,
    max_per_cell: int,
) -> DataFrame:
    """Candidate pairs from cells that are compared and cut finer, level by level."""
    spots = cut_lineage(spots, "dense")
    # Only points that reach a crowded cell take part.
    reach = geo.touched_cells(
        _boxes(spots, cell_deg, 1, "s"), "s_lat0", "s_lat1", "s_lon0", "s_lon1", km, cell_deg, "__row", "__col"
    ).select("s_day", "__row", "__col").distinct()
    near = geo.add_cell(points, "lat", "lon", cell_deg, "__row", "__col").withColumn("s_day", _nearby_days(F.col("day"), days))
    points = cut_lineage(near.join(reach, ["s_day", "__row", "__col"], "left_semi").drop("s_day", "__row", "__col").distinct(), "points")

    a0 = _boxes(points, cell_deg, 1, "a")
    s0 = _boxes(spots, cell_deg, 1, "s")
    left = a0.withColumn("s_day", _nearby_days(F.col("a_day"), days))
    right = geo.touched_cells(
        s0, "s_lat0", "s_lat1", "s_lon0", "s_lon1", km, cell_deg, "a_row", "a_col"
    )
    pairs = _drop_losers(left.join(right, ["s_day", "a_row", "a_col"]), km, day_weight, distance)

    splits = 1
    for _ in range(_MAX_DEPTH):
        splits *= _SPLIT
        a = _boxes(points, cell_deg, splits, "a")
        s = _boxes(spots, cell_deg, splits, "s")
        finer = pairs
        for side, boxes in (("a", a), ("s", s)):
            keys = [f"{side}_{k}" for k in _CELL]
            children = boxes.withColumns(
                {
                    f"{side}_row_in": F.col(f"{side}_row"),
                    f"{side}_col_in": F.col(f"{side}_col"),
                    f"{side}_row": F.floor(F.col(f"{side}_row") / F.lit(_SPLIT)).cast("long"),
                    f"{side}_col": F.floor(F.col(f"{side}_col") / F.lit(_SPLIT)).cast("long"),
                }
            )
            finer = (
                finer.join(children, keys)
                .drop(f"{side}_row", f"{side}_col")
                .withColumnsRenamed({f"{side}_row_in": f"{side}_row", f"{side}_col_in": f"{side}_col"})
            )
        pairs = cut_lineage(_drop_losers(finer, km, day_weight, distance), "cells")
        if _fullest_cell(spots, cell_deg, splits) <= max_per_cell:
            break

    in_a = geo.add_cell(points, "lat", "lon", cell_deg, "a_row", "a_col", splits).withColumnRenamed(
        "day", "a_day"
    )
    in_s = geo.add_cell(
        spots.withColumnsRenamed({"lat": "s_lat", "lon": "s_lon", "day": "s_day"}),
        "s_lat", "s_lon", cell_deg, "s_row", "s_col", splits,
    )
    return (
        in_a.join(pairs, [f"a_{k}" for k in _CELL])
        .join(in_s, [f"s_{k}" for k in _CELL])
        .select(
            "lat", "lon", F.col("a_day").alias("day"), "rank",
            *geo.place_columns("p_", distance), *geo.place_columns("s_", distance),
            _apart("a_day", "s_day").alias("apart"),
        )
    )
