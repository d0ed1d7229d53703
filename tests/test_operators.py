import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings, strategies as hs
from pyspark.sql import functions as F

from emberlink import lexicons as lx
from emberlink.functions.text import article_text, event_text, matching_terms
from emberlink.operators import classify, filters, reports
from emberlink.operators.dedup import dedup_first, insert_absent
from emberlink.operators.entities import entities, extract_entities
from emberlink.operators.hazards import hazard_counts, hazards_union
from emberlink.operators.overlay import overlay
from emberlink.operators.window_link import link_by_window

AS_OF = "2024-01-31 00:00:00"


def texts(spark, rows):
    return spark.createDataFrame(rows, "id string, title string, description string")


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_keywords_are_substrings_in_either_field(spark):
    df = texts(spark, [
        ("inside", "Großwaldbrandlage", None),
        ("upper", None, "EIN LÖSCHFLUGZEUG STARTET"),
        ("none", "Wetter", "sonnig"),
        ("null", None, None),
    ])
    assert ids(filters.keyword_filter(df, ["title", "description"], lx.NEWSAPI_TYPES["wildfire"])) == ["inside", "upper"]
    assert ids(filters.keyword_filter(df, "title", [])) == []
    found = {r.id: r.t for r in df.select("id", matching_terms(["title", "description"], ["Wetter", "Waldbrand"]).alias("t")).collect()}
    assert found == {"inside": ["Waldbrand"], "upper": [], "none": ["Wetter"], "null": []}


def test_search_needs_both_lists(spark):
    df = texts(spark, [("both", "Waldbrand in der Schweiz", ""), ("key", "Waldbrand", ""), ("place", "Schweiz", ""), ("split", "Waldbrand", "Valais")])
    assert ids(filters.search(df, ["title", "description"], ["Waldbrand"], ["Schweiz", "Valais"])) == ["both", "split"]
    assert ids(filters.search(df, ["title"], ["Waldbrand"])) == ["both", "key", "split"]


def test_first_type_in_declared_order(spark):
    df = texts(spark, [("both", "Erdrutsch nach Waldbrand", None), ("slide", "MUDSLIDE", None), ("none", "Bern", None)])
    got = {r.id: r.linked_disaster_type for r in classify.classify_first(df, "title", lx.RELIEFWEB_TYPES).collect()}
    assert got == {"both": "wildfire", "slide": "landslide"}
    assert classify.classify_first(df, "title", lx.RELIEFWEB_TYPES, keep_unmatched=True).count() == 3
    flags = {r.id: r.location_match for r in classify.flag_any(df, "title", lx.RELIEFWEB_PLACES).collect()}
    assert flags == {"both": False, "slide": False, "none": True}


def test_relevance(spark):
    df = texts(spark, [
        ("both", "Feuer in Bayern", None), ("fire", "Es brennt", None), ("place", None, "bei Bremen"), ("none", "x", "y"), ("capital", "Feuer", None),
    ]).withColumn("relevance_score", F.when(F.col("id") == "none", 0.7))
    got = {r.id: r.relevance_score for r in classify.score_relevance(df).collect()}
    assert got == {"both": 1.0, "fire": 0.5, "place": 0.5, "none": 0.7, "capital": 0.5}
    as_written = {r.id: r.s for r in df.select("id", classify.relevance(as_written=True).alias("s")).collect()}
    assert as_written["capital"] == 0.0 and as_written["fire"] == 0.5 and as_written["both"] == 0.5


def test_priority_keeps_letter_case(spark):
    df = texts(spark, [("yes", "Valais", None), ("lower", "valais", None), ("unlinked", "Valais", None)]).withColumn(
        "semantic_linked_disaster_id", F.when(F.col("id") != "unlinked", "e"))
    got = {r.id: r.p for r in df.select("id", classify.priority_flag().alias("p")).collect()}
    assert got == {"yes": True, "lower": None, "unlinked": None}


def test_grid_tags(spark):
    df = texts(spark, [("a", "Waldbrand und wildfire in Germany", "Switzerland"), ("b", "wildfire", None), ("c", "wildfire Germany", None)]).withColumn(
        "language", F.when(F.col("id") == "c", "fr").otherwise("de"))
    got = sorted((r.id, r.cell_type, r["query"]) for r in classify.tag_grid(df, lx.GNEWS_GRID).collect())
    assert got == [("a", "wildfire", "Waldbrand Germany"), ("a", "wildfire", "Waldbrand Switzerland"), ("a", "wildfire", "wildfire Germany"), ("a", "wildfire", "wildfire Switzerland")]
    cells = {name: len(classify.grid_cells(g)) for name, g in {"gnews": lx.GNEWS_GRID, "stream": lx.GNEWS_STREAM_GRID, "media": lx.MEDIASTACK_GRID, "media stream": lx.MEDIASTACK_STREAM_GRID}.items()}
    assert cells == {"gnews": 16, "stream": 64, "media": 48, "media stream": 24}
    plan = classify.tag_grid(df, lx.GNEWS_GRID)._jdf.queryExecution().toString()
    assert "Join" not in plan


def test_region(spark):
    df = spark.createDataFrame([("in", 47.0, 6.0), ("edge", 48.0, 6.0), ("far", 0.0, 0.0), ("line", -5.0, -179.0), ("null", None, 1.0)], "id string, lat double, lon double")
    boxes = [("Alps", 46, 48, 5, 10), ("Pacific", -10, 10, 170, -170)]
    got = {r.id: r.r for r in df.select("id", classify.region_of("lat", "lon", boxes).alias("r")).collect()}
    assert got == {"in": "Alps", "edge": None, "far": None, "line": "Pacific", "null": None}


def test_recency_keeps_the_boundary(spark):
    df = spark.createDataFrame([("at", "2024-01-21 00:00:00"), ("before", "2024-01-20 23:59:59"), ("null", None)], "id string, t string").withColumn("t", F.to_timestamp("t"))
    assert ids(filters.recent(df, "t", 10, AS_OF)) == ["at"]


def test_required_fields(spark):
    df = texts(spark, [("both", "t", "d"), ("blank", "", "d"), ("null", None, "d"), ("neither", None, "")])
    assert ids(filters.require_all(df, "title", "description")) == ["both"]
    assert ids(filters.require_any(df, "title", "description")) == ["blank", "both", "null"]
    assert ids(filters.pending(df, "title")) == ["neither", "null"] and filters.pending(df, "title", True).count() == 4


def test_restrict_includes_both_days(spark):
    rows = [("a", "de", "CH", "2024-01-05 00:00:00"), ("b", "de", "CH", "2024-01-10 23:59:59"), ("c", "de", "CH", "2024-01-11 00:00:00"), ("d", "en", "CH", "2024-01-06 00:00:00")]
    df = spark.createDataFrame(rows, "id string, language string, country string, p string").withColumn("published_at", F.to_timestamp("p"))
    assert ids(filters.restrict(df, ["de"], ["CH"], "2024-01-05", "2024-01-10")) == ["a", "b"]


def test_texts(spark):
    df = texts(spark, [("a", " t", "d "), ("b", None, "d"), ("c", None, None)])
    assert {r.id: r.x for r in df.select("id", article_text().alias("x")).collect()} == {"a": "t d", "b": "d", "c": ""}
    h = spark.createDataFrame([("wildfire", 46.5, 7.25, dt.date(2024, 1, 2))], "disaster_type string, latitude double, longitude double, event_date date")
    assert h.select(event_text()).first()[0] == "wildfire in 46.5,7.25 on 2024-01-02"


def test_entities_in_text_order(spark):
    df = texts(spark, [("a", "Die Feuerwehr aus Bern, nicht Berner. ÜBern 12 km² Bern", None), ("b", "nichts", None), ("c", None, None)])
    got = {r.id: r.e for r in df.select("id", entities("title", patterns={"NUM": r"\d+"}).alias("e")).collect()}
    assert [(e.text, e.label) for e in got["a"]] == [("Feuerwehr", "ORG"), ("Bern", "LOC"), ("12", "NUM"), ("Bern", "LOC")]
    assert got["b"] == [] and got["c"] is None
    marked = df.withColumns({"linked_fire_id": F.when(F.col("id") != "b", "f"), "entities": F.lit(None).cast("array<struct<text:string,label:string>>")})
    done = {r.id: r.entities for r in extract_entities(marked, article_text()).collect()}
    assert len(done["a"]) == 3 and done["b"] is None and done["c"] == []

    def make():
        return lambda batch: [[(t[:3], "X")] for t in batch]

    model = {r.id: r.entities for r in extract_entities(marked, article_text(), make_tagger=make).collect()}
    assert model["a"][0].text == "Die" and model["b"] is None


def test_first_writer_wins(spark):
    rows = [("u1", 3, "c"), ("u1", 1, "a"), (None, 5, "e"), (None, 4, "d"), ("u2", 9, "x")]
    df = spark.createDataFrame(rows, "url string, n int, v string").repartition(3)
    assert sorted((r.url or "", r.v) for r in dedup_first(df, "url", "n").collect()) == [("", "d"), ("u1", "a"), ("u2", "x")]
    target = spark.createDataFrame([("u2",), ("u2",), (None,)], "url string")
    assert [r.v for r in insert_absent(df, target, "url", "n").collect()] == ["a"]
    plan = dedup_first(df, "url", "n")._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2  # one before the shuffle


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(hs.lists(hs.tuples(hs.sampled_from([None, "a", "b", "c"]), hs.integers(0, 50)), min_size=1, max_size=12, unique_by=lambda r: r[1]))
def test_insert_absent_is_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k string, n int")
    once = insert_absent(df, df.limit(0), "k", "n")
    kept = sorted(((r.k or ""), r.n) for r in once.collect())
    want = {}
    for k, n in rows:
        want[k or ""] = min(n, want.get(k or "", n))
    assert kept == sorted(want.items())
    assert insert_absent(df, once, "k", "n").count() == 0


def test_overlay(spark):
    base = spark.createDataFrame([(1, "a", 0.1), (2, "b", 0.2), (3, "c", 0.3)], "id int, title string, score double")
    patch = spark.createDataFrame([(1, 0.9, "x", 1), (1, 0.8, "y", 2), (3, None, None, 1), (7, 1.0, "z", 1)], "id int, score double, tag string, o int")
    got = {r.id: (r.title, r.score, r.tag) for r in overlay(base, patch, "id", ["score", "tag"], patch_order="o").collect()}
    assert got == {1: ("a", 0.9, "x"), 2: ("b", 0.2, None), 3: ("c", None, None)}
    cleared = {r.id: r.score for r in overlay(base, patch, "id", ["score"], "o", missing_clears=True).collect()}
    assert cleared == {1: 0.9, 2: None, 3: None}


def test_window_link(spark):
    arts = spark.createDataFrame(
        [
            ("first fire", "Waldbrand Schweiz", "2024-01-10 23:00:00"),
            ("edge", "Waldbrand Valais", "2024-01-20 12:00:00"),
            ("outside", "Waldbrand Valais", "2024-01-21 00:00:00"),
            ("no place", "Waldbrand", "2024-01-10 00:00:00"),
            ("fire before slide", "Erdrutsch, Feuer, Schweiz", "2024-01-13 00:00:00"),
            ("slide only", "Erdrutsch Schweiz", "2024-01-13 00:00:00"),
            ("fire too late", "Erdrutsch und Feuer Schweiz", "2024-01-25 00:00:00"),
        ],
        "article_id string, title string, p string",
    ).withColumns({"published_at": F.to_timestamp("p"), "description": F.lit(None).cast("string")})
    hazards = spark.createDataFrame(
        [
            ("f2", "wildfire", 1.0, 1.0, "2024-01-12"), ("f1", "wildfire", 2.0, 2.0, "2024-01-15"), ("f0", "wildfire", 3.0, 3.0, "2023-12-01"),
            ("s1", "landslide", 4.0, 4.0, "2024-01-13"), ("s2", "landslide", 5.0, 5.0, "2024-01-24"), ("s0", "landslide", 5.0, 5.0, None),
        ],
        "hazard_id string, disaster_type string, latitude double, longitude double, d string",
    ).withColumn("event_date", F.to_date("d"))
    out = link_by_window(arts, hazards, as_of="2024-01-31")
    got = {r.article_id: r.linked_disaster_id for r in out.collect()}
    assert got == {"first fire": "f1", "edge": "f1", "fire before slide": "f1", "slide only": "s1", "fire too late": "s2"}
    row = out.where("article_id = 'edge'").first()
    assert (row.linked_disaster_type, row.query_lat, str(row.query_date)) == ("wildfire", 2.0, "2024-01-15")
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_hazards(spark):
    fires = spark.createDataFrame([("f", 1.0, 2.0, "2024-01-01"), ("old", 1.0, 2.0, "2023-12-31")], "fire_id string, latitude double, longitude double, acq_date string")
    slides = spark.createDataFrame([(7, 1.0, 2.0, "2024-01-05")], "event_id long, latitude double, longitude double, date string")
    both = hazards_union(fires, slides)
    assert both.columns == ["hazard_id", "disaster_type", "latitude", "longitude", "event_date"] and both.count() == 3
    assert {r.disaster_type: r.hazards for r in hazard_counts(both, "2024-01-31").collect()} == {"wildfire": 1, "landslide": 1}


def test_dashboard(spark):
    rows = [("T", "Alps", 0.0, 1.0, 2.0, [("Bern", "LOC"), ("Feuerwehr", "ORG")]), ("U", None, None, None, 2.0, None), ("V", "Alps", 0.5, 1.0, None, [])]
    df = spark.createDataFrame(rows, "title string, query_region string, relevance_score double, query_lat double, query_lon double, entities array<struct<text:string,label:string>>")
    for c in ("source", "published_at", "url", "semantic_score", "match_score"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    view = reports.dashboard_view(df)
    assert view.columns == ["Title", "Source", "Published", "Region", "URL", "Relevance", "Semantic", "Match", "Lat", "Lon", "Entities"]
    assert {r.Title: r.Entities for r in view.collect()} == {"T": "Bern, Feuerwehr", "U": "", "V": ""}
    assert ids(reports.dashboard_filter(view), "Title") == ["T", "V"]
    assert ids(reports.dashboard_filter(view, ["Alps"], 0.5), "Title") == ["V"]
    assert ids(reports.map_points(view), "Title") == ["T"]
    assert [r.Region for r in reports.region_options(view).collect()] == ["Alps"]


def test_clusters_and_density(spark):
    pts = [("a", 10.0, 10.0), ("b", 10.2, 10.4), ("c", -80.0, 170.0), ("n", None, 1.0)]
    df = spark.createDataFrame(pts, "id string, latitude double, longitude double")
    got = {(r.zoom, r.cell_lat, r.cell_lon): (r.points, round(r.center_lat, 6)) for r in reports.cluster_points(df, [0, 4]).collect()}
    assert got == {(0, 0, 0): (2, 10.1), (0, -1, 1): (1, -80.0), (4, 1, 1): (2, 10.1), (4, -15, 30): (1, -80.0)}
    assert sorted(r.points for r in reports.density_grid(df, 1.0).collect()) == [1, 2]


def test_latest_and_metrics(spark):
    df = spark.createDataFrame([("g", 1, 1), ("g", 2, 2), ("g", 2, 3), ("h", 1, 4)], "sub string, ts int, id int")
    assert ids(reports.latest_per_group(df, "sub", "ts", 2, "id")) == [2, 3, 4]
    got = {(r["sub"]): (r["rows"], r.skipped_late) for r in reports.run_metrics(df, ["sub"], {"late": F.col("ts") > 1}).collect()}
    assert got == {"g": (3, 2), "h": (1, 0), None: (4, 2)}


def test_sample_and_linked(spark):
    rows = [(i, 1.0, 1.0, f"f{i}", 1.0, [("x", "Y")]) if i % 2 else (i, None, 1.0, None, None, None) for i in range(9)]
    df = spark.createDataFrame(rows, "article_id int, semantic_score double, relevance_score double, linked_fire_id string, match_score double, entities array<struct<text:string,label:string>>")
    assert ids(reports.sample_enriched(df), "article_id") == [1, 3, 5]
    fires = spark.createDataFrame([("f1",), ("f1",)], "fire_id string")
    assert reports.linked_only(df).count() == 4
    assert ids(reports.linked_only(df, fires), "article_id") == [1]
