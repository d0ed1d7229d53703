"""Every registered query next to its SQL; those without SQL are held to a plain version elsewhere."""

from pathlib import Path

import duckdb
import pytest

from emberlink.llm import queries
from tests.llm.test_urls import PAGES
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
WITHOUT_SQL = {"op1_language", "op2_bpe_round_trip", "op3_pack", "op4_secrets", "op5_main_text", "op9_rabitq_search"}


def test_names():
    assert set(queries.QUERIES) - set(queries.ORACLES) == WITHOUT_SQL


@pytest.mark.skipif(not Path(SF).exists(), reason="test tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_against_sql(spark, name):
    assert compare(name, spark, connect(SF), SF, queries.QUERIES, queries.ORACLES) is None


def test_url_sql_follows_aliases(spark, tmp_path):
    rows = [(i, u, h) for i, (u, h) in enumerate(PAGES)]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(queries.ORACLES["op6_url_verdicts"]).fetchall(), key=repr)
    got = [tuple(r) for r in queries.QUERIES["op6_url_verdicts"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == want
