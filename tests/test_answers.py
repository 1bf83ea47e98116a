import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmark.operators import aggregate as ag
from shelfmark.operators import charts as ch
from shelfmark.operators import rank as rk
from shelfmark.plans import analyses as an
from shelfmark.plans import bindings as b

from conftest import rows


def test_null_is_a_group_unless_skipped(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), (None,), ("b",)], "k string")
    assert rows(ag.count_by(df, "k")) == [(None, 3), ("a", 2), ("b", 1)]
    assert rows(ag.count_by(df, "k", skip_null=True)) == [("a", 2), ("b", 1)]


def test_avg_by_orders_and_counts_all_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 2.0), ("c", None)], "k string, v double")
    assert rows(ag.avg_by(df, "k", "v", "m")) == [("b", 2.0, 1), ("a", 1.0, 2), ("c", None, 1)]


def test_means_do_not_depend_on_the_order_of_rows(spark):
    # Their mean is 3.0625 exactly, but sums of these doubles differ in the last bit.
    data = [("a", v) for v in [2.7, 2.9, 3.1, 3.3, 2.6, 3.2, 3.4, 3.3]]
    for turn in range(8):
        df = spark.createDataFrame(data[turn:] + data[:turn], "k string, v double").coalesce(1)
        assert rows(ag.avg_by(df, "k", "v", "m", 3)) == [("a", 3.063, 8)]


def test_correlation(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9), (None, 100.0), (9.0, None)], "x double, y double")
    wanted = np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]
    assert rows(ag.correlation(df, "x", "y")) == [(pytest.approx(wanted, abs=1e-6),)]
    assert rows(ag.correlation(df.withColumn("y", F.lit(3.0)), "x", "y")) == [(None,)]
    assert rows(ag.correlation(df.where("x > 99"), "x", "y")) == [(None,)]


def test_top_groups_and_distincts(spark):
    df = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("a", 2), ("c", None)], "k string, v int")
    assert rows(ag.top_groups(df, F.col("v").isNotNull(), "k", 1)) == [("a", 2)]
    assert rows(ag.distinct_count(df, "v")) == [(2,)]
    assert rows(ag.distinct_count(df, "v", approx=True)) == [(2,)]
    assert rows(ag.mean_distinct_per_group(df, "k", "v")) == [(1.3333,)]


def test_ranks(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "a", 9), (4, "b", 1)], "id int, k string, v int")
    order = [F.col("v").desc(), F.col("id")]
    assert rows(rk.top_n(df, order, 2, ["id"])) == [(3,), (1,)]
    assert rows(rk.top_n_min_support(df, [F.col("id")], 5, "v", 5, ["id"])) == [(1,), (2,), (3,)]
    assert sorted(rows(rk.top_n_per_group(df, ["k"], order, 2).select("k", "id", "rank"))) == [
        ("a", 1, 2), ("a", 3, 1), ("b", 4, 1)]
    assert rows(rk.lookup_top(df, "k", "zzz", order)) == []
    assert [r[0] for r in rows(rk.total_sort(df, order))] == [3, 1, 2, 4]
    assert rk.total_sort(df, order, whole=False).count() == 4


def test_share_sums_to_all(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    assert rows(ch.share(df, "k")) == [("a", 2, 66.7), ("b", 1, 33.3)]


def test_box_stats_by_hand(spark):
    data = [("a", float(v)) for v in [1, 2, 3, 4, 5, 100]] + [("b", 7.0), (None, 1.0), (None, 3.0), ("c", None)]
    df = spark.createDataFrame(data, "g string, v double")
    got = {r["g"]: tuple(r[1:]) for r in ch.box_stats(df, "g", "v").collect()}
    assert got["a"] == (6, 2.25, 3.5, 4.75, 1.0, 5.0, 1)
    assert got["b"] == (1, 7.0, 7.0, 7.0, 7.0, 7.0, 0)
    assert got[None] == (2, 1.5, 2.0, 2.5, 1.0, 3.0, 0)
    assert "c" not in got
    assert rows(ch.box_outliers(df, "g", "v")) == [("a", 100.0, 1)]


def test_scatter_points(spark):
    df = spark.createDataFrame([(0, 1.0, "a"), (2, 2.0, "b"), (3, None, "c")], "x int, y double, l string")
    assert rows(ch.scatter_points(df, "x", "y", "l")) == [(2, 2.0, "b")]
    assert ch.scatter_points(df, "x", "y", "l", log_x=False).count() == 2


def test_pivot_mean_keeps_columns_filled_in_two_rows(spark):
    df = spark.createDataFrame(
        [("r1", "x", 1.0), ("r1", "x", 2.0), ("r2", "x", 4.0), ("r1", "y", 9.0), ("r3", "y", None), ("r4", "y2", 1.0)],
        "r string, c string, v double")
    wide = ch.pivot_mean(df, "r", "c", "v", ["x", "y", "y2"], min_rows=2)
    assert wide.columns == ["r", "x"]
    assert sorted(rows(wide)) == [("r1", 1.5), ("r2", 4.0), ("r4", None)]
    assert ch.pivot_mean(df, "r", "c", "v", ["y", "z"]).columns == ["r", "y", "z"]


def test_histogram_like_numpy(spark):
    data = [float(x) for x in [0, 1, 1, 2, 5, 9.99, 10]]
    df = spark.createDataFrame([(x,) for x in data] + [(None,), (math.nan,)], "v double")
    counts, edges = np.histogram(data, bins=5)
    got = rows(ch.histogram(df, "v", 5).orderBy("bin"))
    assert [r[3] for r in got] == list(counts)
    assert [r[1] for r in got] + [got[-1][2]] == pytest.approx(list(edges))


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,)] * 4, "v double")
    got = rows(ch.histogram(df, "v", 4).orderBy("bin"))
    assert [r[3] for r in got] == [0, 0, 4, 0] and got[0][1] == 2.5 and got[-1][2] == 3.5


def test_density_like_the_formula(spark):
    data = np.array([1.0, 2.0, 2.0, 4.5, 7.0])
    df = spark.createDataFrame([(float(x),) for x in data], "v double")
    bw = len(data) ** -0.2 * data.std(ddof=1)
    got = rows(ch.density(df, "v", 11).orderBy("point"))
    for (_, x, d), grid in zip(got, np.linspace(1, 7, 11), strict=True):
        assert x == pytest.approx(grid)
        assert d == pytest.approx(np.exp(-0.5 * ((grid - data) / bw) ** 2).sum() / (5 * bw * math.sqrt(2 * math.pi)))


def test_density_of_far_values_and_of_one_value(spark):
    # Between two far groups lie grid points that no value reaches.
    data = np.concatenate([np.arange(300) / 300, 1000 + np.arange(300) / 300])
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (math.nan,)], "v double").repartition(4)
    got = {r[0]: r[1:] for r in rows(ch.density(df, "v", 500))}
    bw = len(data) ** -0.2 * data.std(ddof=1)
    for p, grid in enumerate(np.linspace(data.min(), data.max(), 500)):
        wanted = np.exp(-0.5 * ((grid - data) / bw) ** 2).sum() / (len(data) * bw * math.sqrt(2 * math.pi))
        assert got[p] == (pytest.approx(grid), pytest.approx(wanted, abs=1e-15))
    same = spark.createDataFrame([(2.0,)] * 3, "v double")
    assert {r[2] for r in rows(ch.density(same, "v", 5))} == {None}
    assert rows(ch.density(df.where("v > 1e9"), "v", 5)) == []


def test_density_of_many_rows_touches_few_points(spark, monkeypatch):
    monkeypatch.setattr(ch, "KERNEL_REACH", 3.0)
    df = spark.range(20_000).selectExpr("cast(id as double) as v")
    plan = ch.density(df, "v", 200)._jdf.queryExecution().executedPlan().toString()
    assert "sequence" in plan.lower()
    assert ch.density(df, "v", 200).count() == 200


def test_ordered_counts_and_marks(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("other",)], "k string")
    assert rows(ch.ordered_counts(df, F.col("k"), ["b", "zzz", "a"])) == [(1, "b", 2), (3, "a", 1)]
    numbers = spark.createDataFrame([(1.0,), (2.0,), (6.0,), (None,)], "v double")
    assert rows(ch.marks(numbers, "v")) == [(3.0, 2.0)]


def test_differing_rows_are_those_of_except_all_both_ways(spark):
    one = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, None), (None, None)], "k int, v string")
    other = spark.createDataFrame([("a", 1), (None, 2), (None, None), ("b", 3), ("b", 3)], "v string, k int")
    both = one.exceptAll(other.select("k", "v")).unionByName(other.select("k", "v").exceptAll(one))
    assert rows(ag.differing_rows(one, other)) == [(both.count(),)] == [(4,)]
    assert rows(ag.differing_rows(one, one)) == rows(ag.differing_rows(one.limit(0), one.limit(0))) == [(0,)]


def test_sets_of_results(spark, folder):
    df = b.entity(spark, folder)
    assert len(an.analyses(df)) == 15 and len(an.chart_tables(df)) == 10
    assert rows(an.analyses(df)["category_count"])[0][1] >= rows(an.analyses(df)["category_count"])[-1][1]
    ascending = [r["total_ratings"] for r in an.chart_tables(df)["bars_top10_reviewed"].collect()]
    assert ascending == sorted(ascending) and len(ascending) == 10
