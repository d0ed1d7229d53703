from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from emberlink.operators.overlay import overlay
from emberlink.sinks import months as mo

SCHEMA = (
    T.StructType().add("id", T.LongType()).add("published", T.DateType()).add("title", T.StringType())
    .add("score", T.DoubleType()).add("tag", T.StringType())
)


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("*.parquet")}


@pytest.fixture
def table(spark, tmp_path):
    rows = [(i, f"2024-{1 + i % 6:02d}-{1 + i % 28:02d}" if i % 10 else None, f"t{i}", 1.0) for i in range(200)] + [(None, "2024-01-05", "no key", 1.0)]
    base = spark.createDataFrame(rows, "id long, published string, title string, score double").withColumn("published", F.to_date("published"))
    path = str(tmp_path / "by-month")
    mo.write_months(base, path, "published")
    return base, path


def test_only_touched_months_are_rewritten(spark, table):
    base, path = table
    before = files(path)
    # Keys of months 3 and 4, one without a date, one that the table lacks, none, and one twice.
    patch = spark.createDataFrame([(2, 5.0, "a"), (3, None, "b"), (10, 7.0, None), (999, 1.0, "z"), (None, 1.0, "z"), (2, 4.0, "c")], "id long, score double, tag string")
    want = {tuple(r) for r in overlay(base, patch, "id", ["score", "tag"]).collect()}
    done = mo.update_months(spark, path, SCHEMA, patch, "id", ["score", "tag"])
    assert done == ["2024-03", "2024-04", mo.NO_DATE]
    after = files(path)
    inside = lambda names, those: {f for f in names if f.split("/")[0].removeprefix("month=") in those}
    assert before - inside(before, done) == after - inside(after, done)
    assert not inside(before, done) & inside(after, done)
    read = mo.read_months(spark, path, SCHEMA)
    assert {tuple(r)[:5] for r in read.collect()} == want and read.count() == base.count()
    assert read.where("id = 3").first()["score"] is None


def test_a_second_run_gives_the_same(spark, table):
    _, path = table
    patch = spark.createDataFrame([(i, float(i), "x") for i in range(0, 200, 7)], "id long, score double, tag string")
    rows = []
    for _ in range(2):
        mo.update_months(spark, path, SCHEMA, patch, "id", ["score", "tag"])
        rows.append(sorted(map(str, mo.read_months(spark, path, SCHEMA).collect())))
    assert rows[0] == rows[1] and len(rows[0]) == 201


def test_nothing_to_change(spark, table):
    _, path = table
    before = files(path)
    patch = spark.createDataFrame([(999, 1.0)], "id long, score double")
    assert mo.update_months(spark, path, SCHEMA, patch, "id", ["score"]) == []
    assert mo.update_months(spark, path, SCHEMA, patch.where("false"), "id", ["score"]) == []
    assert files(path) == before


def test_what_is_refused(spark, table):
    base, path = table
    patch = spark.createDataFrame([(1, 1.0)], "id long, other double")
    with pytest.raises(ValueError, match="other"):
        mo.update_months(spark, path, SCHEMA, patch, "id", ["other"])
    with pytest.raises(ValueError, match="layout"):
        mo.write_months(base.withColumnRenamed("title", "month"), path + "2", "published")
