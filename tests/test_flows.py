import datetime as dt

from pyspark.sql import functions as F

from emberlink.flows import enrich, import_hazard_events, import_landslides, ingest_news, insert_articles
from emberlink.operators import filters
from emberlink.operators.window_link import link_by_window
from emberlink.sinks.tables import append_table, stored_keys


def test_enrich_end_to_end(spark):
    rows = [
        ("a", "Waldbrand in Bayern, Valais", [1.0, 0.0], 46.3, 7.8),
        ("b", "Feuer", [0.0, 1.0], 46.3, 7.8),
        ("c", "Feuerwehr in Hamburg", [0.9, 0.1], 10.0, 7.8),
        ("d", "", [1.0, 0.0], 46.3, 7.8),
    ]
    news = spark.createDataFrame(rows, "article_id string, title string, vector array<double>, query_lat double, query_lon double").withColumns(
        {"description": F.lit(None).cast("string"), "published_at": F.to_timestamp(F.lit("2024-01-05 10:00:00"))}
    )
    events = spark.createDataFrame([("e1", "wildfire", [1.0, 0.0])], "event_id string, disaster_type string, vector array<double>")
    fires = spark.createDataFrame([("f1", 46.3, 7.8, dt.date(2024, 1, 4))], "fire_id string, latitude double, longitude double, acq_date date")
    got = {r.article_id: r for r in enrich(news, fires, events, regions=[("Alps", 45, 48, 5, 12)]).collect()}
    a, b, c, d = (got[k] for k in "abcd")
    assert (a.relevance_score, a.semantic_score, a.semantic_linked_disaster_id, a.priority_match) == (1.0, 1.0, "e1", True)
    assert (a.linked_fire_id, a.match_score, a.query_region) == ("f1", 10.0, "Alps")
    assert [e.text for e in a.entities] == ["Bayern", "Valais"]
    assert b.relevance_score == 0.5 and b.semantic_score is None and b.linked_fire_id is None and b.entities is None
    assert c.linked_disaster_type == "wildfire" and c.linked_fire_id is None and c.query_region is None
    assert d.semantic_score is None


def test_ingest_skips_what_is_stored(spark):
    rows = [(1, "Waldbrand Schweiz", "u1"), (2, "Waldbrand Schweiz", "u1"), (3, "Waldbrand Schweiz", "u2"), (4, None, "u3")]
    news = spark.createDataFrame(rows, "article_id int, title string, url string").withColumns(
        {"description": F.lit(None).cast("string"), "published_at": F.to_timestamp(F.lit("2024-01-05 10:00:00"))}
    )
    hazards = spark.createDataFrame([("h", "wildfire", 1.0, 2.0, dt.date(2024, 1, 4))], "hazard_id string, disaster_type string, latitude double, longitude double, event_date date")
    assert sorted(r.article_id for r in ingest_news(news, hazards).collect()) == [1, 3]
    stored = spark.createDataFrame([("u2",)], "url string")
    assert [r.article_id for r in ingest_news(news, hazards, stored).collect()] == [1]


def test_filters_reach_the_scan_and_articles_are_not_shuffled(spark, tmp_path):
    rows = [(1, "Waldbrand Schweiz", "x", "de", "2024-01-05 10:00:00")]
    news = spark.createDataFrame(rows, "article_id int, title string, description string, language string, p string")
    news.withColumn("published_at", F.to_timestamp("p")).write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    plan = filters.restrict(table, ["de"], None, "2024-01-01", "2024-01-10").select("title")._jdf.queryExecution().toString()
    pushed = plan[plan.index("PushedFilters"):]
    assert "EqualTo(language,de)" in pushed or "In(language" in pushed
    assert "GreaterThanOrEqual(published" in pushed and "ReadSchema: struct<title:string,language:string,published_at:timestamp>" in plan
    hazards = spark.createDataFrame([("h", "wildfire", 1.0, 2.0, dt.date(2024, 1, 4))], "hazard_id string, disaster_type string, latitude double, longitude double, event_date date")
    linked = link_by_window(table, hazards)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in linked
    # the only shuffles are of the hazard side, by date
    assert all("covered" in line or "event_date" in line for line in linked.splitlines() if "Exchange hashpartitioning" in line)


def test_articles_without_url_stay_apart(spark):
    rows = [(1, None, "a", "s"), (2, None, "b", "s"), (3, "", "a", "s"), (4, "u", "a", "s"), (5, "u", "c", "t")]
    news = spark.createDataFrame(rows, "article_id long, url string, title string, source string")
    assert sorted(r.article_id for r in insert_articles(news, None, "article_id").collect()) == [1, 2, 4]
    stored = spark.createDataFrame([(0, None, "b", "s")], news.schema)
    kept = insert_articles(news, stored, "article_id")
    assert kept.columns == news.columns
    assert sorted(r.article_id for r in kept.collect()) == [1, 4]


def test_copies_of_an_article_stay_as_many(spark):
    row = [("a", "Feuer", 46.3, 7.8, 0.9)] * 20
    news = spark.createDataFrame(row, "article_id string, title string, query_lat double, query_lon double, semantic_score double").withColumns(
        {"description": F.lit(None).cast("string"), "published_at": F.to_timestamp(F.lit("2024-01-05 10:00:00"))}
    )
    fires = spark.createDataFrame([("f1", 46.3, 7.8, dt.date(2024, 1, 4))], "fire_id string, latitude double, longitude double, acq_date date")
    got = enrich(news, fires).collect()
    assert len(got) == 20 and {r.linked_fire_id for r in got} == {"f1"}


def test_events_without_guid_stay_apart(spark):
    rows = [(None, "Landslide A", "GDACS", 1), (None, "Landslide B", "GDACS", 2), ("", "Landslide A", "GDACS", 3), ("g", "Landslide C", "GDACS", 4), ("g", "Landslide D", "GDACS", 5)]
    events = spark.createDataFrame(rows, "guid string, title string, source string, n int")
    kept = lambda stored=None: sorted(r.n for r in import_hazard_events(events, stored, ["landslide"], "n").collect())
    assert kept() == [1, 2, 4]
    assert kept(events.where("n = 2")) == [1, 4]
    assert kept(spark.createDataFrame([("g",), (None,)], "guid string")) == [1, 2]
    slides = spark.createDataFrame([(None, 1.0, "2024-01-01"), (None, 2.0, "2024-01-01"), (None, 2.0, "2024-01-01"), ("e", 1.0, "2024-01-01")], "event_id string, latitude double, date string")
    assert import_landslides(slides).count() == 3


def test_reading_keys_leaves_the_frame_as_it_was(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    append_table(df, str(tmp_path / "t"))
    assert stored_keys(spark, str(tmp_path / "t"), "parquet", df).columns == df.columns == ["a"] and len(df.schema) == 1
