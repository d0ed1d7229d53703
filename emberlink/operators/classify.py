"""Lexicon classifiers and tags. All are projections: no join, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from emberlink import lexicons as lx
from emberlink.functions.text import article_text, first_type, match_any

Fields = str | Iterable[str]


def classify_first(
    df: DataFrame,
    fields: Fields,
    lexicon: Mapping[str, Iterable[str]],
    out: str = "linked_disaster_type",
    keep_unmatched: bool = False,
) -> DataFrame:
    """The first type, in declared order, whose terms occur; rows without one are dropped."""
    typed = df.withColumn(out, first_type(fields, lexicon))
    return typed if keep_unmatched else typed.where(F.col(out).isNotNull())


def flag_any(df: DataFrame, fields: Fields, terms: Iterable[str], out: str = "location_match") -> DataFrame:
    """Whether any term occurs; every row is kept."""
    return df.withColumn(out, match_any(fields, terms))


def relevance(
    fields: Fields = ("title", "description"),
    hazard_terms: Iterable[str] = lx.RELEVANCE_FIRE,
    place_terms: Iterable[str] = lx.RELEVANCE_PLACES,
    as_written: bool = False,
) -> Column:
    """1.0 with hazard and place, 0.5 with either, else 0.0.

    ``as_written`` compares the terms as they are written with the lower-cased text, so a
    capitalised term never matches.
    """
    hazard = match_any(fields, hazard_terms, lower_terms=not as_written)
    place = match_any(fields, place_terms, lower_terms=not as_written)
    return (hazard.cast("double") + place.cast("double")) / F.lit(2.0)


def score_relevance(df: DataFrame, **options) -> DataFrame:
    """Fill ``relevance_score`` where it is still missing."""
    return df.withColumn("relevance_score", F.coalesce(F.col("relevance_score"), relevance(**options)))


def priority_flag(
    text: Column | None = None,
    linked: Column | None = None,
    places: Iterable[str] = lx.PRIORITY_PLACES,
) -> Column:
    """True for a linked article that names a priority place, letter case included; else null."""
    text = article_text() if text is None else text
    linked = F.col("semantic_linked_disaster_id").isNotNull() if linked is None else linked
    return F.when(linked & match_any(text, places, case_sensitive=True), F.lit(True))


def grid_cells(grid: Mapping) -> list[tuple[str | None, str, str, str]]:
    """All search cells (type, keyword, country, language) of a grid."""
    return [
        (kind, keyword, country, language)
        for kind, keywords in grid["types"].items()
        for keyword in keywords
        for country in grid["countries"]
        for language in grid["languages"]
    ]


def tag_grid(
    df: DataFrame,
    grid: Mapping,
    fields: Fields = ("title", "description"),
    language: str = "language",
    country: str = "country",
) -> DataFrame:
    """One row per article and search cell that would have found it.

    A cell finds an article in its language whose text has its keyword, and its country: a country
    named by a code of two letters is the outlet's, in column ``country``; one written out is looked
    up in the text. Each keyword and country is looked up once per row, and the hits are multiplied
    out, not the grid; a row grows at most by the size of the grid.
    """
    fields = [fields] if isinstance(fields, str) else list(fields)
    text = F.lower(F.concat_ws("\x00", *[F.col(f) for f in fields]))
    pairs = [(kind, keyword) for kind, keywords in grid["types"].items() for keyword in keywords]

    def found_in(place: str, bound: Column) -> Column:
        if len(place) != 2:
            return bound.contains(place.lower())
        return F.upper(F.col(country)) == place.upper() if country in df.columns else F.lit(False)

    def hits(bound: Column) -> Column:
        keywords = [
            F.when(
                bound.contains(keyword.lower()),
                F.struct(F.lit(kind).cast("string").alias("type"), F.lit(keyword).alias("keyword")),
            )
            for kind, keyword in pairs
        ]
        countries = [F.when(found_in(c, bound), F.lit(c)) for c in grid["countries"]]
        return F.struct(
            F.array_compact(F.array(*keywords)).alias("keywords"),
            F.array_compact(F.array(*countries)).alias("countries"),
        )

    return (
        df.where(F.col(language).isin(*grid["languages"]))
        .withColumn("__hits", F.element_at(F.transform(F.array(text), hits), 1))
        .withColumn("__keyword", F.explode("__hits.keywords"))
        .withColumn("cell_country", F.explode("__hits.countries"))
        .withColumns(
            {
                "cell_type": F.col("__keyword.type"),
                "cell_keyword": F.col("__keyword.keyword"),
                "cell_language": F.col(language),
                "query": F.concat_ws(" ", F.col("__keyword.keyword"), F.col("cell_country")),
            }
        )
        .drop("__hits", "__keyword")
    )


def region_of(
    latitude: str | Column,
    longitude: str | Column,
    boxes: Iterable[tuple[str, float, float, float, float]],
) -> Column:
    """Name of the first box (name, south, north, west, east) around a point; null outside.

    Lower edges belong to a box, upper edges do not. A box with west > east crosses the date line.
    """
    lat = F.col(latitude) if isinstance(latitude, str) else latitude
    lon = F.col(longitude) if isinstance(longitude, str) else longitude
    branches = []
    for name, south, north, west, east in boxes:
        across = (lon >= F.lit(float(west))) & (lon < F.lit(float(east)))
        if west > east:
            across = (lon >= F.lit(float(west))) | (lon < F.lit(float(east)))
        branches.append(
            F.when((lat >= F.lit(float(south))) & (lat < F.lit(float(north))) & across, F.lit(name))
        )
    return F.coalesce(*branches)
