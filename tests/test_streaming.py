import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from emberlink.sinks.tables import append_absent, append_table, make_sink
from emberlink.sinks.topics import json_value, publish
from emberlink.streaming import unified as un


def land(path, name, messages):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(m) for m in messages) + "\n", encoding="utf-8")


def message(url, title="t", topic="gnews_articles", day=1, **more):
    body = {"title": title, "url": url, "publishedAt": "2024-01-02T10:00:00Z", "source": "s", **more}
    return {"topic": topic, "value": json.dumps(body), "timestamp": f"2024-01-{day:02d}T00:00:00Z"}


def config(tmp_path, **more):
    return un.StreamConfig(str(tmp_path / "ckpt"), str(tmp_path / "table"), str(tmp_path / "bad"), as_of="2024-01-31 00:00:00", **more)


def test_unified_restarts_where_it_ended(spark, tmp_path):
    land(tmp_path / "in", "a.json", [message("u1"), message(None, "no url"), {"topic": "x", "value": '{"title": ', "timestamp": "2024-01-01T00:00:00Z"}])
    land(tmp_path / "in", "b.json", [message("u1"), message("u2", topic="unknown", disaster_type="wildfire"), {"topic": "x", "value": None, "timestamp": "2024-01-01T00:00:00Z"}])
    cfg = config(tmp_path)
    un.run_unified(un.read_topic_files(spark, str(tmp_path / "in"), 1), cfg)
    assert spark.read.parquet(cfg.table).count() == 4
    assert spark.read.parquet(cfg.quarantine).count() == 2
    land(tmp_path / "in", "c.json", [message("u3")])
    un.run_unified(un.read_topic_files(spark, str(tmp_path / "in"), 1), cfg)
    got = spark.read.parquet(cfg.table)
    assert sorted(r.url or "-" for r in got.collect()) == ["-", "u1", "u1", "u2", "u3"]
    row = got.where("url = 'u2'").first()
    assert row.topic == "unknown" and row.linked_disaster_type == "wildfire" and row.published_at is not None
    # the batch twin sees the same
    files = spark.read.schema(un.ENVELOPE).json(str(tmp_path / "in"))
    good, bad = un.split_batch(files)
    assert good.count() == 5 and bad.count() == 2
    assert good.exceptAll(got.select(*good.columns)).count() == 0


def test_a_batch_that_runs_again_is_not_doubled(spark, tmp_path):
    sink = make_sink("parquet", str(tmp_path / "t"), writer="w")
    df = spark.range(3)
    sink(df, 0)
    sink(df, 0)
    sink(df, 1)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 6


def test_unknown_backend_fails_at_start(tmp_path):
    with pytest.raises(ValueError, match="unknown storage backend"):
        make_sink("tape", str(tmp_path))


def test_dedup_stream(spark, tmp_path):
    land(tmp_path / "in", "a.json", [message("u1", f"t{i}") for i in range(40)] + [message("u2"), message(None, "a"), message(None, "b")])
    cfg = config(tmp_path)
    un.run_dedup(un.read_topic_files(spark, str(tmp_path / "in"), 1), cfg)
    land(tmp_path / "in", "b.json", [message("u1", day=3), message("u4", day=3), {"topic": "x", "value": "{", "timestamp": None}])
    un.run_dedup(un.read_topic_files(spark, str(tmp_path / "in"), 1), cfg)
    got = sorted((r.url or "-" + r.title) for r in spark.read.parquet(cfg.table).collect())
    assert got == ["-a", "-b", "u1", "u2", "u4"]
    assert spark.read.parquet(cfg.quarantine).count() == 1


def test_older_files_after_newer_ones_are_stored(spark, tmp_path):
    cfg = config(tmp_path)
    for name, day, urls in (("a.json", 30, ["u1"]), ("b.json", 29, ["u2", "u1"]), ("c.json", 1, ["u3", "u4", "u2"])):
        land(tmp_path / "in", name, [message(u, day=day) for u in urls])
        un.run_dedup(un.read_topic_files(spark, str(tmp_path / "in"), 1), cfg)
    assert sorted(r.url for r in spark.read.parquet(cfg.table).collect()) == ["u1", "u2", "u3", "u4"]


def test_two_checkpoints_share_a_table(spark, tmp_path):
    land(tmp_path / "in1", "a.json", [message("u1"), message("u2")])
    land(tmp_path / "in2", "a.json", [message("u9"), message("u1")])
    for k in (1, 2):
        cfg = un.StreamConfig(str(tmp_path / f"ck{k}"), str(tmp_path / "table"), str(tmp_path / "bad"))
        un.run_unified(un.read_topic_files(spark, str(tmp_path / f"in{k}")), cfg)
    assert sorted(r.url for r in spark.read.parquet(str(tmp_path / "table")).collect()) == ["u1", "u1", "u2", "u9"]


def test_batch_after_stream_is_read_with_it(spark, tmp_path):
    land(tmp_path / "in", "a.json", [message("u1"), message("u2")])
    cfg = config(tmp_path)
    un.run_dedup(un.read_topic_files(spark, str(tmp_path / "in")), cfg)
    new = spark.read.parquet(cfg.table).drop("writer", "batch_id", "ingested_at")
    more = new.unionByName(new.limit(1).withColumns({"url": F.lit("u3"), "article_id": F.lit("id3")}))
    append_absent(more, cfg.table, "article_id", "url")
    append_absent(more, cfg.table, "article_id", "url")
    assert sorted(r.url for r in spark.read.parquet(cfg.table).collect()) == ["u1", "u2", "u3"]


def test_a_batch_that_runs_again_does_not_meet_itself(spark, tmp_path):
    sink = make_sink("parquet", str(tmp_path / "t"), writer="w", absent=("id", "id"))
    sink(spark.range(3), 0)
    sink(spark.range(3), 0)
    sink(spark.range(5), 1)
    assert sorted(r.id for r in spark.read.parquet(str(tmp_path / "t")).collect()) == [0, 1, 2, 3, 4]


def test_copies_stay_as_many_when_linked(spark, tmp_path):
    row = [("a1", dt.datetime(2024, 1, 5), 47.0, 7.0)] * 5 + [("a1", dt.datetime(2024, 1, 5), 47.2, 7.0)]
    src = spark.createDataFrame(row, "article_id string, published_at timestamp, query_lat double, query_lon double")
    src.write.parquet(str(tmp_path / "in"))
    fires = spark.createDataFrame([("f1", 47.1, 7.0, dt.date(2024, 1, 6)), ("f2", 47.1, 7.0, dt.date(2023, 1, 6))], "fire_id string, latitude double, longitude double, acq_date date")
    un.run_links(spark.readStream.schema(src.schema).parquet(str(tmp_path / "in")), fires, str(tmp_path / "out"), str(tmp_path / "ck"), min_semantic=None)
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(got) == 6 and {r.linked_fire_id for r in got} == {"f1"}


def test_stream_links_equal_batch(spark, tmp_path):
    rows = [("a1", "2024-01-05T00:00:00Z", 47.0, 7.0), ("a2", "2024-01-05T00:00:00Z", 10.0, 7.0)]
    src = spark.createDataFrame(rows, "article_id string, p string, query_lat double, query_lon double")
    src.write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema(src.schema).json(str(tmp_path / "in")).withColumn("published_at", F.to_timestamp("p"))
    fires = spark.createDataFrame([("f1", 47.1, 7.0, dt.date(2024, 1, 6))], "fire_id string, latitude double, longitude double, acq_date date")
    un.run_links(stream, fires, str(tmp_path / "out"), str(tmp_path / "ck"), min_semantic=None)
    got = {r.article_id: r.linked_fire_id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"a1": "f1", "a2": None}


def test_publish_and_append(spark, tmp_path):
    df = spark.createDataFrame([("ü", 1), (None, 2)], "title string, n int")
    assert [r.value for r in json_value(df).orderBy("value").collect()] == ['{"n":2}', '{"title":"ü","n":1}']
    publish(df, "gnews_articles", {"path": str(tmp_path / "topic")}, fmt="json")
    assert spark.read.json(str(tmp_path / "topic")).where("topic = 'gnews_articles'").count() == 2
    path = str(tmp_path / "t")
    append_table(df, path, as_of="2024-01-31 00:00:00", as_text=True)
    append_table(df, path, as_of="2024-01-31 00:00:00", as_text=True)
    got = spark.read.parquet(path)
    assert got.count() == 4 and got.first().ingested_at == "2024-01-31 00:00:00"
    target = str(tmp_path / "first")
    append_absent(df, target, "n", "title", as_of="2024-01-31 00:00:00")
    append_absent(df.unionByName(df.withColumn("n", F.lit(7))), target, "n", F.col("title").asc_nulls_last())
    assert sorted((r.n, r.title or "") for r in spark.read.parquet(target).collect()) == [(1, "ü"), (2, ""), (7, "ü")]
