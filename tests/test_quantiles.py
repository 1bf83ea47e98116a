import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.operators.quantiles import approx_quantiles, quantiles

from conftest import rows

PROBS = [0.0, 0.1, 0.5, 0.75, 1.0]


def wanted(data):
    return tuple(np.quantile(np.array(data, dtype=float), PROBS)) if data else None


@pytest.mark.parametrize("data", [
    [1.0], [1, 2], list(range(1, 11)), [5.0] * 9, [0.0, -0.0, 1e-300, -1e-300],
    [1e300, -1e300, 1.0, 2.0, 3.0], [1 + i * 2**-52 for i in range(50)],
    [-3.5, -3.25, 0, 7, 7, 7, 1e6, 1e-6],
])
def test_exact_on_awkward_values(spark, data):
    df = spark.createDataFrame([(float(x),) for x in data] + [(None,), (math.nan,)], "v double")
    assert rows(quantiles(df, "v", PROBS))[0] == pytest.approx(wanted(data), rel=1e-12, abs=0)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(
    st.none(), st.floats(-1e12, 1e12), st.integers(-3, 3).map(float))), min_size=1, max_size=60))
def test_grouped_like_numpy(spark, data):
    df = spark.createDataFrame(data, "g string, v double").repartition(3)
    got = {r[0]: tuple(r[1:]) for r in rows(quantiles(df, "v", PROBS, by=["g"]))}
    groups = {g: [v for gg, v in data if gg == g and v is not None] for g in {g for g, _ in data}}
    assert got == {g: pytest.approx(wanted(v), rel=1e-9, abs=1e-9) for g, v in groups.items() if v}


def test_many_distinct_values_in_one_interval(spark):
    # All values share the coarse interval, and a third of the rows is one value.
    df = spark.range(60000).selectExpr("if(id % 3 = 0, 1000.0D, 1000.0D + id * 1e-9) as v")
    data = np.array([1000.0 if i % 3 == 0 else 1000.0 + i * 1e-9 for i in range(60000)])
    assert rows(quantiles(df, "v", PROBS))[0] == pytest.approx(tuple(np.quantile(data, PROBS)), rel=1e-15)


def test_infinite_values(spark):
    data = [-math.inf, -math.inf, 1.0, math.inf, math.inf]
    df = spark.createDataFrame([(x,) for x in data], "v double")
    assert rows(quantiles(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0])) == [tuple(data)]


def test_lower_rank_and_no_values(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    assert rows(quantiles(df, "v", [0.5], interpolate=False)) == [(5.0,)]
    assert rows(quantiles(df.where("v > 99"), "v", [0.5])) == []


def test_approx_rank_error(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    [(found,)] = rows(approx_quantiles(df, "l_extendedprice", [0.5], accuracy=1000))
    below = df.where(df.l_extendedprice <= found).count()
    assert abs(below / df.count() - 0.5) <= 2 / 1000


@pytest.mark.parametrize("values", [
    "id * 1e-12", "1e18 + id * 86400.0", "1.0 + id / 200000.0", "exp((id - 100000) / 300.0)"])
def test_last_intervals_are_small(spark, values):
    from shelfmark.operators import quantiles as q

    df = spark.range(200_000).selectExpr(f"cast({values} as double) as v")
    part = F.shiftright(q._code(F.col("v")), q._SHIFTS[-1])
    sizes = df.distinct().groupBy(part.alias("p")).agg(F.count("*").alias("n"))
    assert sizes.agg(F.max("n")).first()[0] <= 4000


def test_tables_are_read_anew(spark, tmp_path):
    from shelfmark.plans import bindings as b

    folder = str(tmp_path / "tables")
    counts = []
    for take in (50, 120):
        for name in ("part", "lineitem"):
            df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
            if name == "part":
                df = df.where(F.col("p_partkey") <= take)
            df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        counts.append(b.entity(spark, folder).count())
    assert counts[0] < counts[1]


def _shuffled(df):
    """Rows written by each shuffle of a query that was run."""
    plan = df._jdf.queryExecution().executedPlan()
    found, stack = [], [plan.finalPhysicalPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(i) for i in range(children.size())]
        if "QueryStage" in node.nodeName():
            stack.append(node.plan())
    return found


def test_large_groups_shuffle_few_values(spark):
    df = spark.range(400_000).selectExpr("if(id % 4 = 0, 'b', 'a') as g", "cast(hash(id) as double) as v").cache()
    df.count()
    found = quantiles(df, "v", [0.25, 0.5], by=["g"], few_groups=True)
    got = {r[0]: tuple(r[1:]) for r in rows(found)}
    exact = df.groupBy("g").agg(F.expr("percentile(v, array(0.25, 0.5))").alias("p")).collect()
    assert got == {r[0]: pytest.approx(tuple(r[1])) for r in exact}
    assert max(_shuffled(found)) < 0.1 * 400_000


@pytest.mark.parametrize("n", [4095, 4096, 4097, 30_000])
def test_brackets_at_the_border_of_small_groups(spark, n):
    rng = np.random.default_rng(n)
    data = rng.choice([rng.normal(size=n), np.round(rng.normal(size=n), 1)], axis=0)
    df = spark.createDataFrame([(float(x),) for x in data], "v double").repartition(5)
    assert rows(quantiles(df, "v", PROBS))[0] == pytest.approx(tuple(np.quantile(data, PROBS)), rel=1e-12)


def test_a_missed_bracket_is_an_error(spark, monkeypatch):
    from shelfmark.operators import quantiles as q

    monkeypatch.setattr(q, "SMALL", 0)
    monkeypatch.setattr(q, "MARGIN", -0.2)
    df = spark.range(1000).selectExpr("cast(id as double) as v")
    got = quantiles(df, "v", [0.5])
    # Without any value inside there is no row; with some, no wrong value is given.
    try:
        assert rows(got) == []
    except Exception as e:
        assert "outside its bracket" in str(e)
