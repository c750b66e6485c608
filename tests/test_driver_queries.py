"""Every registered query against its SQL twin in DuckDB, and the plans that matter."""

import re

import pytest

import __spark_entry__ as contract
import table_queries
from tests.helpers import plan
from tests.oracle import compare, connect

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = table_queries.QUERIES, table_queries.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    problem, _, _ = compare(spark, con, name, QUERIES[name], ORACLE[name], SF)
    assert problem == ""


def test_entry(spark):
    df = contract.entry(spark)
    assert set(df.columns) == {"nationkey", "dt", "o_orderkey", "year_x", "l_partkey", "l_suppkey",
                               "year_y"}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


def test_no_plan_uses_python_or_cross_joins(spark):
    for name in ("mart_two_key", "clean_historical_weather", "city_sentiment", "median_impute",
                 "histogram_bins", "gazetteer_mentions", "clean_happiness", "backup_for_empty"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["range_filter"](spark, SF))
    assert re.search(r"PushedFilters: .*GreaterThanOrEqual\(p_size,5\)", text)
    assert re.search(r"ReadSchema: struct<p_partkey:bigint,p_size:int,p_retailprice:double>", text)
    mart = plan(QUERIES["mart_two_key"](spark, SF))
    assert re.search(r"PushedFilters: .*o_orderdate,1996", mart)
    assert re.search(r"PushedFilters: .*l_shipdate,1996", mart)
