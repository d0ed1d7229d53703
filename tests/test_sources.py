import datetime as dt
import json

from pyspark.sql import functions as F

from emberlink.functions.times import parse_published
from emberlink.sources import exports, hazards, landed
from emberlink.sources.canonical import canonical_union
from emberlink import schemas

AS_OF = "2024-01-31 00:00:00"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path.parent)


def test_parse_published(spark):
    cases = {
        "Tue, 02 Jan 2024 10:20:30 GMT": dt.datetime(2024, 1, 2, 10, 20, 30),
        "Tue, 02 Jan 2024 10:20:30 +0200": dt.datetime(2024, 1, 2, 8, 20, 30),
        "Tue, 02 Jan 2024 10:20:30 +0000": dt.datetime(2024, 1, 2, 10, 20, 30),
        "2024-01-02T10:20:30Z": dt.datetime(2024, 1, 2, 10, 20, 30),
        "2024-01-02T10:20:30+01:00": dt.datetime(2024, 1, 2, 9, 20, 30),
        "2024-01-02T10:20:30": dt.datetime(2024, 1, 2, 10, 20, 30),
        "2024-01-02T10:20:30.250000": dt.datetime(2024, 1, 2, 10, 20, 30, 250000),
        "2024-01-02 10:20:30.123456": dt.datetime(2024, 1, 2, 10, 20, 30, 123456),
        "2024-01-02": dt.datetime(2024, 1, 2),
        "1704190830": dt.datetime(2024, 1, 2, 10, 20, 30),
        "1704190830.5": dt.datetime(2024, 1, 2, 10, 20, 30, 500000),
        "next Tuesday": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    got = {r.raw: r.t for r in df.select("raw", F.to_timestamp_ntz(parse_published("raw").cast("string")).alias("t")).collect()}
    assert got == cases


def test_newsapi(spark, tmp_path):
    body = {"articles": [
        {"source": {"name": "Blick"}, "title": "T", "description": "D", "url": "u1", "publishedAt": "2024-01-02T10:20:30Z"},
        {"source": None, "title": None, "description": None, "url": None, "publishedAt": None},
    ]}
    put(tmp_path / "in/language=de/a.json", json.dumps(body, indent=1))
    put(tmp_path / "in/language=en/b.json", '{"articles": [{"title": ')
    put(tmp_path / "in/language=en/c.json", '{"articles": []}')
    rows = landed.read_newsapi(spark, str(tmp_path / "in")).orderBy("url").collect()
    assert [(r.source, r.url, r.language) for r in rows] == [("", None, "de"), ("Blick", "u1", "de")]
    raw = landed.read_json(spark, str(tmp_path / "in"), schemas.NEWSAPI_RESPONSE)
    assert landed.malformed(raw).count() == 1


def test_gnews_and_mediastack(spark, tmp_path):
    art = {"source": {"name": "N"}, "title": "T", "description": "D", "content": "C", "url": "u", "publishedAt": "2024-01-02T10:20:30Z"}
    d = put(tmp_path / "g/a.json", json.dumps({"articles": [art]}) + "\n" + json.dumps({"articles": [art, art]}))
    batch = landed.read_gnews(spark, d, lines=True)
    assert batch.count() == 3 and batch.first().source == "GNews" and batch.first().content == "C"
    stream = landed.read_gnews(spark, d, lines=True, shape="stream").first()
    assert stream.source == "N" and stream.description == "D"
    rows = [{"title": t, "description": None, "url": u, "published_at": "x", "source": "s"} for t, u in [("a", "u"), ("", "u"), (None, "u"), ("b", None), ("b", "")]]
    put(tmp_path / "m/country=ch/a.json", json.dumps({"data": rows}))
    got = landed.read_mediastack(spark, str(tmp_path / "m")).collect()
    assert [(r.title, r.country, r.published_at) for r in got] == [("a", "CH", None)]


def test_reddit(spark, tmp_path):
    rows = [
        {"subreddit": "de", "title": "T", "selftext": None, "url": "u", "created_utc": 1704190830.0},
        {"subreddit": "news", "title": "T2", "selftext": "S", "url": "u2", "created_utc": 1704190830.5},
    ]
    d = put(tmp_path / "r/a.jsonl", "\n".join(json.dumps(r) for r in rows) + "\n{broken\n")
    got = landed.read_reddit(spark, d).orderBy("url").collect()
    assert [(r.source, r.description) for r in got] == [("r/de", ""), ("r/news", "S")]
    assert got[0].published_at.replace(tzinfo=None) == dt.datetime.fromtimestamp(1704190830)


FEED = """<?xml version="1.0" encoding="UTF-8"?>
<rss version="2.0"><channel><title>Feed</title>
<item><title>Landslide &amp; flood</title><link>http://l/1</link><description>
 <![CDATA[ <b>bold</b> ]]></description><pubDate>Tue, 02 Jan 2024 10:20:30 GMT</pubDate><guid isPermaLink="false"> g1 </guid></item>
<item><title>Bergsturz LANDSLIDE</title><link>http://l/2</link></item>
<item><title>Flood</title><link>http://l/3</link><description>x</description><pubDate>soon</pubDate></item>
</channel></rss>"""


def test_feeds(spark, tmp_path):
    put(tmp_path / "x/a.xml", FEED)
    put(tmp_path / "x/broken.xml", FEED[: len(FEED) // 2])
    d = put(tmp_path / "x/empty.xml", "<rss><channel><title>none</title></channel></rss>")
    got = landed.read_rss(spark, d, "google_rss", as_of=AS_OF).orderBy("url").collect()
    assert [r.url for r in got] == ["http://l/1", "http://l/2", "http://l/3"]
    assert got[0].title == "Landslide & flood" and got[0].description == "<b>bold</b>"
    assert got[0].source == "Google News RSS"
    assert str(got[1].published_at).startswith("2024-01-31") and got[2].published_at is None
    events = landed.read_gdacs(spark, d, AS_OF).orderBy("link").collect()
    assert [(e.guid, e.description) for e in events] == [("g1", events[0].description), ("http://l/2", "")]
    assert landed.malformed(landed.read_feeds(spark, d)).count() == 1


def test_hazards(spark, tmp_path):
    d = put(tmp_path / "f/a.csv", "country_id,latitude,longitude,bright_ti4,confidence,acq_date,acq_time,satellite,instrument,frp,daynight\nCHE,46.4,7.8,301.5,n,2024-01-02,34,N,VIIRS,1.5,D\n,46.4,7.8,301.5,n,2024-01-02,1234,N,VIIRS,,N\n")
    rows = hazards.read_firms_csv(spark, d, AS_OF).orderBy("acq_time").collect()
    assert [(r.country, r.acq_time, r.frp) for r in rows] == [("CHE", "0034", 1.5), (None, "1234", None)]
    assert len({r.fire_id for r in rows}) == 2
    d = put(tmp_path / "g/a.csv", "latitude,longitude,bright_ti4,confidence,acq_date,acq_time,satellite,instrument,frp,daynight\n46.4,7.8,301.5,n,2024-01-02,34,N,VIIRS,1.5,D\n")
    assert hazards.read_firms_csv(spark, d, AS_OF).first().country == "DEU"
    body = [
        {"event_id": "1", "date": "2024-01-02T00:00:00.000", "latitude": "46.4", "longitude": "0"},
        {"event_id": "2", "latitude": "abc", "longitude": "7"},
        {"event_id": "", "latitude": "1", "longitude": "7"},
        {"event_id": "4", "latitude": None, "longitude": "7"},
    ]
    d = put(tmp_path / "l/a.json", json.dumps(body))
    got = hazards.read_landslides(spark, d, AS_OF).collect()
    assert [(r.event_id, str(r.date), r.longitude) for r in got] == [("1", "2024-01-02", 0.0)]


def test_fire_files_with_different_headers(spark, tmp_path):
    put(tmp_path / "h/a.csv", "latitude,longitude,acq_date,acq_time,frp\n51.0,9.0,2024-01-02,34,1.5\n")
    put(tmp_path / "h/b.csv", "longitude,latitude,frp,acq_time,acq_date,extra\n9.0,51.0,1.5,34,2024-01-02,x\n\n9.1,51.1,2,7\n")
    put(tmp_path / "h/c.csv", '\ufeffcountry_id,"latitude",longitude,acq_date,acq_time,frp\nCHE,46.0,8.0,2024-01-03,1234,"2.5"\n')
    put(tmp_path / "h/d.csv", "")
    d = str(tmp_path / "h")
    rows = sorted((r.country, r.latitude, r.longitude, str(r.acq_date), r.acq_time, r.frp) for r in hazards.read_firms_csv(spark, d, AS_OF).collect())
    assert rows == [("CHE", 46.0, 8.0, "2024-01-03", "1234", 2.5), *[("DEU", 51.0, 9.0, "2024-01-02", "0034", 1.5)] * 2]
    _, bad = hazards.split_firms(hazards.read_firms_raw(spark, d))
    assert [(r.reason, r._corrupt) for r in bad.collect()] == [("broken", "9.1,51.1,2,7")]


def test_exports_and_union(spark, tmp_path):
    put(tmp_path / "e/news.json", json.dumps([{"title": "a", "url": "u", "publishedAt": "2024-01-02T00:00:00Z", "relevance_score": 0.5, "entities": [{"text": "Bern", "label": "LOC"}]}]))
    put(tmp_path / "e/gnews_articles.json", json.dumps([{"title": "b", "url": "v", "content": "c", "disaster_type": "wildfire"}]))
    put(tmp_path / "e/fires.json", json.dumps([{"latitude": 1.0, "longitude": 2.0, "acq_date": "2024-01-02", "timestamp": "2024-01-03T00:00:00"}]))
    d = put(tmp_path / "e/slides.json", json.dumps([{"type": "landslide", "event_id": "9", "date": "2024-01-02", "latitude": 1.5}]))
    tables = exports.load_exports(spark, d)
    arts = {r.title: r for r in tables["articles"].collect()}
    assert tables["articles"].schema == schemas.ARTICLES
    assert arts["a"].relevance_score == 0.5 and arts["a"].published_at is not None and arts["a"].entities[0].text == "Bern"
    assert arts["b"].linked_disaster_type == "wildfire" and arts["b"].content == "c"
    assert str(tables["wildfires"].first().acq_date) == "2024-01-02"
    assert tables["landslides"].first().latitude == 1.5
    one = spark.createDataFrame([("t", "u")], "title string, url string")
    two = spark.createDataFrame([("t2", "s", 1.0)], "title string, source string, query_lat double")
    union = canonical_union(one, two, as_of=AS_OF)
    assert union.schema == schemas.ARTICLES and union.count() == 2
    assert all(r.article_id for r in union.collect())
