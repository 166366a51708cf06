"""Physical plans that must not get worse."""

from pyspark.sql import functions as F

from tidemark.operators import consolidated as con
from tidemark.operators import series as ser
from tidemark.plans.bed import Bed
from tidemark.plans.registry import CARRIED, HI, LO, START


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def literal(spark, b):
    """The inputs of the flagship operators without what makes the test bed."""
    rows = b.closing.select("id_operation", "rubro", "date", *CARRIED, "amount_mo", "amount_mn")
    table = spark.createDataFrame(rows.limit(5).collect(), rows.schema)
    return table, spark.createDataFrame(b.calendar.collect(), b.calendar.schema)


def test_operating_balances_deal_rows_once(spark, sf_dir):
    table, calendar = literal(spark, Bed(spark, sf_dir))
    text = plan(ser.operating_balances(table, calendar, LO, HI, START))
    assert text.count("Exchange hashpartitioning(") - text.count("Exchange hashpartitioning(cod_calendar") == 2  # of rows that are combined before, and of their copies
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text and "Python" not in text


def test_consolidated_table_deals_rows_once(spark, sf_dir):
    b = Bed(spark, sf_dir)
    _, calendar = literal(spark, b)
    rows = b.sdc.select("date", *con.LONG, *con.MEASURES)
    table = spark.createDataFrame(rows.limit(5).collect(), rows.schema)
    text = plan(con.daily_consolidated(table, calendar, HI, 400))
    assert text.count("Exchange hashpartitioning(company") == 1 and "SortMergeJoin" not in text and "CartesianProduct" not in text and "Python" not in text


def test_closing_balances_read_their_source_once(spark, sf_dir):
    b = Bed(spark, sf_dir)
    _, calendar = literal(spark, b)
    rows = b.raw.withColumnRenamed("ship", "date").drop("id_operation", "id_balance", "id_cross")
    assert plan(ser.closing_balances(rows, calendar, START, HI)).count("FileScan parquet") == 2  # lines and orders


def test_series_queries_use_no_python(spark, sf_dir):
    from __spark_entry__ import registry

    for name in ("b2_fill_month", "b6_balance_grid", "b8_account_average", "v2_variation_range_4", "o3_operation_master", "s6_cut_partition"):
        text = plan(registry.QUERIES[name](spark, sf_dir))
        assert "Python" not in text and "CartesianProduct" not in text, name


def test_calendar_joins_are_hash_joins(spark, sf_dir):
    b = Bed(spark, sf_dir)
    text = plan(ser.propagate_business_days(b.closing, b.calendar, LO, HI).filter(F.col("account") == 3))
    assert "BroadcastNestedLoopJoin" not in text and "BroadcastHashJoin" in text


def test_balances_of_a_day_are_summed_once(spark, sf_dir):
    """Consolidated queries and reports read their rows up to ten times; lines and orders are joined and summed for the first alone."""
    from tidemark.plans.series_queries import _source

    b = Bed(spark, sf_dir)
    text = plan(_source(b).unionByName(_source(b)))
    assert "l_orderkey" not in text and "Join" not in text and text.count("FileScan") == 2 and "/sdc-" in b.sdc.inputFiles()[0]
