"""Every registered query against the SQL that must give the same rows."""

from pathlib import Path

import pytest

import __spark_entry__ as entry_module
from emberlink.plans import ORACLES, QUERIES
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(name, spark, con, SF_DIR, entry_module.queries(), entry_module.oracle_sql()) is None


def test_entry(spark):
    assert entry_module.entry(spark).columns == ["article_id", "linked_fire_id", "match_score"]


def test_only_what_is_learned_or_greedy_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"semantic_dense", "entities_trained", "entities_held_out", "marker_clusters"}
