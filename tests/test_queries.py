import pytest
from oracle import compare, connect

import __spark_entry__ as entry_points
from pagestrata import catalog
from pagestrata.schema import COLUMNS

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.QUERIES, catalog.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, con, name):
    ours, theirs, differences = compare(QUERIES[name](spark, SF), con, ORACLE[name])
    assert differences == [] and ours == theirs


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == COLUMNS and df.count() > 0


def test_listing_articles_read_the_documents_once(spark):
    plan = QUERIES["q39_listing_articles"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
