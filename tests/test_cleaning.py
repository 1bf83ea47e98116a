import random

import pytest
from pyspark.sql import functions as F

from shelfmark.operators import cleaning as cl
from shelfmark.operators import project as pr
from shelfmark.operators import quality as ql
from shelfmark.plans import bindings as b
from shelfmark.plans.cleaning import clean

from conftest import rows


def test_dedup_first_and_last(spark):
    df = spark.createDataFrame(
        [(1, 3, "c"), (1, None, "z"), (1, 2, "b"), (2, 5, "a"), (None, 1, "n"), (None, 0, "m")],
        "k int, o int, v string")
    assert set(rows(cl.dedup(df, ["k"], ["o"]))) == {(1, None, "z"), (2, 5, "a"), (None, 0, "m")}
    assert set(rows(cl.dedup(df, ["k"], ["o"], keep="last"))) == {(1, 3, "c"), (2, 5, "a"), (None, 1, "n")}
    with pytest.raises(ValueError):
        cl.dedup(df, ["k"], keep="any")


def test_dedup_is_the_same_for_any_partitioning(spark):
    data = [(i % 5, i % 3, f"v{i % 7}") for i in range(200)]
    random.Random(1).shuffle(data)
    df = spark.createDataFrame(data, "k int, o int, v string")
    wanted = {k: min((o, v) for kk, o, v in data if kk == k) for k in range(5)}
    for parts in (1, 4, 9):
        got = rows(cl.dedup(df.repartition(parts), ["k"], ["o"]))
        assert {k: (o, v) for k, o, v in got} == wanted


def test_dedup_keeps_types_that_do_not_compare(spark):
    df = spark.createDataFrame([(1, 2, {"a": 1}), (1, 1, {"b": 2})], "k int, o int, m map<string, int>")
    assert rows(cl.dedup(df, ["k"], ["o"])) == [(1, 1, {"b": 2})]
    assert cl.dedup(df, ["k"], ["o"]).schema == df.schema


def test_dedup_on_all_columns(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert sorted(rows(cl.dedup(df, ["k"]))) == [(1,), (2,)]


def test_median_and_mode(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(1, 11)], "a int, b int")
    assert rows(cl.median(df, "a")) == [(5.5,)]
    assert rows(cl.median(df, "a", approx=True)) == [(5.0,)]
    assert rows(cl.mode_value(df, "b")) == [(1,)]
    nothing = df.withColumn("a", F.lit(None).cast("int"))
    assert rows(cl.median(nothing, "a")) == [(None,)]
    assert rows(cl.mode_value(nothing, "a")) == [(None,)]
    tied = spark.createDataFrame([("b",), ("a",), (None,), (None,), (None,)], "a string")
    assert rows(cl.mode_value(tied, "a")) == [("a",)]


def test_impute(spark):
    df = spark.createDataFrame(
        [(1.0, 2, None, None), (None, 2, 5, None), (4.0, None, None, "x")], "a double, b int, c int, d string")
    filled = cl.impute(df, {"a": cl.Median(), "b": cl.Mode(1), "c": 0, "d": ""})
    assert set(rows(filled)) == {(1.0, 2, 0, ""), (2.5, 2, 5, ""), (4.0, 2, 0, "x")}
    assert filled.schema.simpleString() == df.schema.simpleString()


def test_impute_fallbacks_and_zero_medians(spark):
    df = spark.createDataFrame([(None, None, 0.0), (None, None, None)], "a double, b int, z double")
    filled = cl.impute(df, {"a": cl.Median(4.0), "b": cl.Mode(1), "z": cl.Median(9.0)})
    assert rows(filled) == [(4.0, 1, 0.0), (4.0, 1, 0.0)]
    left = cl.impute(df, {"a": cl.Median(), "b": cl.Mode()})
    assert rows(left.select("a", "b")) == [(None, None)] * 2


def test_impute_over_an_empty_table(spark):
    empty = spark.createDataFrame([], "a double, b int")
    assert rows(cl.impute(empty, {"a": cl.Median(), "b": cl.Mode()})) == []


def test_drop_all_null(spark):
    df = spark.createDataFrame([(None, None, 1), (1, None, 2), (None, 1, 3)], "a int, b int, c int")
    assert {r[2] for r in rows(pr.drop_all_null(df, ["a", "b"]))} == {2, 3}


def test_cast_columns(spark):
    df = spark.createDataFrame([("2.0", "True", "1.5"), ("x", "maybe", ""), (None, "false", "2")], "a string, b string, c string")
    cast = pr.cast_columns(df, {"a": "int", "b": "boolean", "c": "double", "absent": "int"})
    assert rows(cast) == [(2, True, 1.5), (None, None, None), (None, False, 2.0)]
    big = spark.createDataFrame([(str(2**60 + 1),)], "a string")
    assert rows(pr.cast_columns(big, {"a": "bigint"})) == [(2**60 + 1,)]


def test_select_existing(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert pr.select_existing(df, ["b", "x", "a"]).columns == ["b", "a"]


def test_require_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert ql.require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match=r"\['x'\].*\['a', 'b'\]"):
        ql.require_columns(df, ["a", "x"])


def test_null_audit(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(ql.null_audit(df)) == [("a", "int", 3, 1, 33.3), ("b", "string", 3, 2, 66.7)]
    empty = spark.createDataFrame([], "a int")
    assert rows(ql.null_audit(empty)) == [("a", "int", 0, 0, None)]
    with pytest.raises(ValueError, match="absent"):
        ql.null_audit(df, ["a", "absent"])


def test_describe(spark):
    df = spark.createDataFrame([(1, 2.0), (3, None)], "a int, b double")
    assert rows(ql.describe(df, ["a", "b"])) == [
        ("a", 2, 2.0, pytest.approx(2**0.5), 1.0, 3.0), ("b", 1, 2.0, None, 2.0, 2.0)]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert rows(ql.schema_report(df)) == [(0, "a", "int"), (1, "b", "string")]


def test_step_counts(spark):
    df = spark.range(10)
    steps = [("in", df), ("even", df.where("id % 2 = 0")), ("big", df.where("id % 2 = 0 and id > 4"))]
    assert rows(ql.step_counts(steps)) == [(1, "even", 10, 5, 5), (2, "big", 5, 2, 3)]


def test_observe_rows(spark, tmp_path):
    df, seen = ql.observe_rows(spark.range(7), "loaded")
    df.write.parquet(str(tmp_path / "out"))
    assert seen.get == {"rows": 7}


def test_staged_clean_gives_the_same_rows(spark, folder):
    lazy = clean(b.raw(spark, folder), b.entity_spec())
    staged = clean(b.raw(spark, folder), b.entity_spec(), staged=True)
    assert lazy.schema == staged.schema
    assert sorted(rows(lazy)) == sorted(rows(staged))
    assert lazy.count() == 197
    audit = {r["column"]: r["nulls"] for r in ql.null_audit(lazy).collect()}
    assert {c for c, n in audit.items() if n} == {"open_now"}
