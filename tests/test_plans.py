"""What the physical plans must and must not hold."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from shelfmark.operators import aggregate as ag
from shelfmark.operators import rank as rk
from shelfmark.plans import bindings as b


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark, folder):
    lines = b.table(spark, folder, "lineitem").where(F.col("l_quantity") > 40)
    text = lines.groupBy("l_returnflag").agg(F.avg("l_tax"))._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,40.0)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_tax:double,l_returnflag:string>" in text


def test_counts_are_combined_before_the_shuffle(spark, folder):
    assert "partial_count" in plan(ag.count_by(b.table(spark, folder, "part"), "p_brand"))


def test_top_n_keeps_n_rows_per_task(spark, folder):
    df = rk.top_n(b.table(spark, folder, "part"), [F.col("p_size").desc(), F.col("p_partkey")], 10)
    assert "TakeOrderedAndProject" in plan(df)


def test_top_n_per_group_limits_before_the_shuffle(spark, folder):
    df = rk.top_n_per_group(b.table(spark, folder, "orders"), ["o_custkey"], [F.col("o_orderkey")], 3)
    text = plan(df)
    assert "WindowGroupLimit" in text and "Partial" in text


def test_dedup_is_combined_before_the_shuffle(spark, folder):
    assert "partial_min" in plan(entry.queries()["dedup_lineitem"](spark, folder))


def test_clean_scans_its_input_once(spark, folder):
    df = b.clean_entity(spark, folder)
    df.collect()
    final = plan(df)
    assert final.count("ReusedExchange") >= 3
    assert "Subquery" in final
