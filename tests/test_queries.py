"""Every registered query against its DuckDB twin, which is written another way."""

import os

import pytest
from conftest import rows_of

import __spark_entry__
from tidemark.plans import registry


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = registry.QUERIES[name](spark, sf_dir).toPandas()
    want = duck.execute(registry.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).limit(5).count() == 5


def test_all_queries_are_named_once(spark):
    names = __spark_entry__.queries()
    assert len(names) >= 130 and set(__spark_entry__.oracle_sql()) <= set(names)


def test_filters_reach_the_scan(spark, sf_dir):
    from tidemark.sources.partitioning import select_source

    lines = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet"))
    plan = select_source(lines, ["l_orderkey"], "l_quantity >= 45")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,45.0)]" in plan and "l_extendedprice" not in plan
