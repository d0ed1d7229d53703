"""Regions by outline: which polygon a point lies in.

Each outline is covered once by cells of a fixed grid. A cell that no edge comes near lies inside or outside as a whole;
a cell that an edge meets keeps the edges of its row of cells. Points meet the cover in an equi-join on their cell, and
only points in cells of the second kind are held against edges, by ray casting. A cell is one row of the cover, with all
its regions in order, so a point stays one row and is not shuffled where the cover is small enough to travel.

An outline is a list of rings of (latitude, longitude); a point is inside by the even-odd rule, so further rings are holes or
other parts, whatever their direction. Rings may cross the date line: the way between two vertices is the one that is less than half
a turn. Outlines around a pole are not supported. Rings may be closed or not; those of fewer than three
different vertices hold nothing. Of several regions around a point the one with the lowest rank wins, then the first name.
Points without a place, or outside all regions, get null, and so do latitudes beyond 90 and numbers that are not finite; such vertices are
passed over. Longitudes count by whole turns: 190 is -170.
A point on an edge belongs to the side that plain ray casting to the east gives it: of a box, the south and west edges belong.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from emberlink.session import cut_lineage

#: Cells along a whole turn; a quarter of a degree each.
COLUMNS = 1440
#: Up to so many cells and edges of the cover travel to every task.
MAX_BROADCAST = 200_000
_PARTS = 16
_NEAR = 1e-9  # degrees; more than rounding can move a crossing

Ring = Sequence[tuple[float, float]]


def outlines_frame(spark: SparkSession, outlines: Iterable[tuple[str, Sequence[Ring]]]) -> DataFrame:
    """``(name, rank, rings)`` from names and rings; rank is the order given."""
    rows = [(name, i, [[(float(a), float(b)) for a, b in ring] for ring in rings]) for i, (name, rings) in enumerate(outlines)]
    return spark.createDataFrame(rows, "name string, rank long, rings array<array<struct<lat double, lon double>>>")


def _latitude(lat: Column) -> Column:
    return F.when((lat >= -90) & (lat <= 90), lat)


def _base(lon: Column) -> Column:
    """A longitude in [-180, 180); one that is there already stays as it is, and one that is no place is null."""
    lon = F.when(F.abs(lon) <= 1e6, lon)
    return F.when((lon >= -180) & (lon < 180), lon).otherwise(lon - F.lit(360.0) * F.floor((lon + 180) / F.lit(360.0)))


def _crosses(e: Column, lat: Column, lon: Column) -> Column:
    """Whether a ray from the point to the east meets the edge."""
    at = (e["x2"] - e["x1"]) * (lat - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]
    return ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at)


def edges(outlines: DataFrame) -> DataFrame:
    """``(name, rank, x1, y1, x2, y2)``: the edges of all rings, without jumps at the date line.

    A ring that reaches over it appears a whole turn further as well, so both of its ends lie within [-180, 180].
    """
    spot = F.posexplode(F.concat("ring", F.slice("ring", 1, 1))).alias("at", "v")
    ring = ["name", "rank", "ring_no"]
    vertices = (
        outlines.select("name", "rank", F.posexplode("rings").alias("ring_no", "ring"))
        .select(*ring, spot)
        .select(*ring, "at", _latitude(F.col("v.lat")).alias("y"), _base(F.col("v.lon")).alias("x"))
        .where(F.col("y").isNotNull() & F.col("x").isNotNull())
    )
    along, whole = Window.partitionBy(*ring).orderBy("at"), Window.partitionBy(*ring)
    step = F.col("x") - F.lag("x").over(along)
    turn = F.when(step > 180, -1).when(step < -180, 1).otherwise(0)
    unrolled = (
        vertices.withColumn("turn", turn)
        .withColumn("x", F.col("x") + F.lit(360.0) * F.sum("turn").over(along))
        .withColumns({"west": F.min("x").over(whole), "east": F.max("x").over(whole)})
        .withColumns({"x2": F.lead("x").over(along), "y2": F.lead("y").over(along)})
        .where("x2 IS NOT NULL")
    )
    shift = F.lit(360.0) * F.col("k")
    return (
        unrolled.withColumn("k", F.explode(F.array(*[F.lit(k) for k in (-2, -1, 0, 1, 2)])))
        .where((F.col("east") + shift >= -180) & (F.col("west") + shift <= 180))
        .select("name", "rank", (F.col("x") + shift).alias("x1"), F.col("y").alias("y1"), (F.col("x2") + shift).alias("x2"), "y2")
    )


def cover(outlines: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """One row per cell that a region has a part of: ``(row, col, regions)``.

    ``regions``: ``array<struct<rank, name, edges>>`` by rank; ``edges`` is null where the whole cell is inside.
    """
    size = 360.0 / columns

    def cell(value: Column, zero: float) -> Column:
        return F.floor((value + F.lit(zero)) / F.lit(size)).cast("int")

    def cells(first: Column, last: Column) -> Column:
        first, last = F.greatest(first, F.lit(0)), F.least(last, F.lit(columns - 1))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    in_rows = edges(outlines).withColumn("row", F.explode(F.sequence(cell(low - _NEAR, 90.0), cell(high + _NEAR, 90.0))))
    south = F.col("row") * F.lit(size) - 90
    rise = F.col("y2") - F.col("y1")
    lean = (F.col("x2") - F.col("x1")) / rise

    def where_at(y: Column) -> Column:
        inside = F.col("x1") + (F.least(F.greatest(y, low), high) - F.col("y1")) * lean
        return F.least(F.greatest(inside, F.least("x1", "x2")), F.greatest("x1", "x2"))

    one, other = where_at(south - _NEAR), where_at(south + F.lit(size + _NEAR))
    flat = F.abs(rise) < 1e-6
    slack = F.when(flat, F.lit(_NEAR)).otherwise(F.lit(_NEAR) + F.lit(1e-12) * F.abs(lean))
    west = F.when(flat, F.least("x1", "x2")).otherwise(F.least(one, other)) - slack
    east = F.when(flat, F.greatest("x1", "x2")).otherwise(F.greatest(one, other)) + slack
    in_rows = cut_lineage(in_rows.withColumns({"first": cell(west, 180.0), "last": cell(east, 180.0)}), "edges")

    region = ["name", "rank"]
    met = in_rows.select(*region, "row", F.explode(cells(F.col("first"), F.col("last"))).alias("col"), F.lit(True).alias("met"))
    rows = in_rows.groupBy(*region, "row").agg(F.collect_list(F.struct("x1", "y1", "x2", "y2")).alias("edges"))

    # Along the middle of a row, cells between an odd crossing and the next are inside.
    middle = F.col("row") * F.lit(size) + F.lit(size / 2 - 90)
    crossing = F.filter("edges", lambda e: (e["y1"] > middle) != (e["y2"] > middle))
    meets = F.array_sort(F.transform(crossing, lambda e: (e["x2"] - e["x1"]) * (middle - e["y1"]) / (e["y2"] - e["y1"]) + e["x1"]))

    def nth(x: Column) -> Column:
        return F.ceil((x + 180) / F.lit(size) - F.lit(0.5)).cast("int")

    pairs = F.when(F.size("meets") > 1, F.sequence(F.lit(0), F.size("meets") - 2, F.lit(2))).otherwise(F.array().cast("array<int>"))
    spans = F.flatten(F.transform(pairs, lambda i: cells(nth(F.get("meets", i)), nth(F.get("meets", i + 1)) - 1)))
    within = rows.withColumn("meets", meets).select(*region, "row", F.explode(spans).alias("col"), F.lit(False).alias("met"))

    every = met.unionByName(within).groupBy(*region, "row", "col").agg(F.max("met").alias("met"))
    held = F.when(F.col("met"), F.col("edges"))
    return (
        every.join(rows, [*region, "row"], "left")
        .groupBy("row", "col")
        .agg(F.array_sort(F.collect_list(F.struct("rank", "name", held.alias("edges")))).alias("regions"))
    )


def regions_by_outline(
    points: DataFrame, outlines: DataFrame, latitude: str = "latitude", longitude: str = "longitude",
    out: str = "region", columns: int = COLUMNS, max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """``points`` with the name of the region each lies in, as ``out``; every row is kept.

    ``outlines``: name, rank and rings (:func:`outlines_frame`). A cover of more than ``max_broadcast`` cells and edges
    is joined by cell, each cell in sixteen parts, so that points in one cell are spread over tasks.
    """
    covered = cut_lineage(cover(outlines, columns), "cover")
    weight = covered.agg(F.sum(1 + F.aggregate("regions", F.lit(0), lambda n, r: n + 1 + F.coalesce(F.size(r["edges"]), F.lit(0))))).first()[0]
    size = F.lit(360.0 / columns)
    lat, lon = F.col("__lat"), F.col("__lon")
    placed = points.withColumns({"__lat": _latitude(F.col(latitude).cast("double")), "__lon": _base(F.col(longitude).cast("double"))}).withColumns(
        {"__row": F.floor((lat + 90) / size).cast("int"), "__col": F.floor((lon + 180) / size).cast("int") % columns}
    )
    cells = covered.select(F.col("row").alias("__row"), F.col("col").alias("__col"), F.col("regions").alias("__regions"))
    keys = ["__row", "__col"]
    if (weight or 0) <= max_broadcast:
        cells = F.broadcast(cells)
    else:
        placed = placed.withColumn("__part", (F.monotonically_increasing_id() % _PARTS).cast("int"))
        cells = cells.withColumn("__part", F.explode(F.array(*[F.lit(p) for p in range(_PARTS)])))
        keys.append("__part")

    def around(r: Column) -> Column:
        met = F.aggregate(r["edges"], F.lit(0), lambda n, e: n + F.when(_crosses(e, lat, lon), 1).otherwise(0))
        return r["edges"].isNull() | (met % 2 == 1)

    found = F.get(F.filter("__regions", around), F.lit(0))["name"]
    joined = placed.join(cells, keys, "left").withColumn(out, found)
    return joined.drop("__lat", "__lon", "__regions", *keys)
