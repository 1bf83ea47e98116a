import pytest
from pyspark.sql import functions as F

from shelfmark.operators.joins import hot_keys, skew_join

from conftest import rows

LOW = {"part_share": 0.01, "sample_min": 20}


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows has key 7, some have none."""
    key = F.when(F.col("id") % 11 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500)
    return spark.range(30000).select("id", key.alias("k"))


@pytest.fixture(scope="module")
def other(spark):
    return spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_a_plain_join(facts, other, how):
    got = sorted(rows(skew_join(facts, other, ["k"], how, **LOW)), key=repr)
    assert got == sorted(rows(facts.join(other, "k", how)), key=repr)


def test_hot_key_is_spread(spark, facts, other):
    codes = spark.range(1).select(F.inline(hot_keys(facts, ["k"], 0.01, 1 / 16, 20)))
    found = {r["code"]: r["parts"] for r in codes.collect()}
    code_of = dict(rows(spark.createDataFrame([(7,), (None,)], "k long").select("k", F.xxhash64("k"))))
    assert set(found) == set(code_of.values())
    assert 20 <= found[code_of[7]] <= 45
    assert sum(found.values()) <= 200


def test_several_rows_per_key_on_the_other_side(spark, facts):
    doubled = spark.range(20).select((F.col("id") % 10).alias("k"), F.col("id").alias("v"))
    got = skew_join(facts, doubled, ["k"], "inner", **LOW)
    plain = facts.join(doubled, "k")
    assert sorted(rows(got)) == sorted(rows(plain))


def test_struct_keys_join_nulls(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "g string, v int").select(F.struct("g").alias("k"), "v")
    assert skew_join(df, df.withColumnRenamed("v", "w"), ["k"], "inner").count() == 2


def test_refuses_what_it_cannot_do(spark, facts, other):
    with pytest.raises(ValueError, match="inner and left"):
        skew_join(facts, other, ["k"], "outer")
    with pytest.raises(ValueError, match="different types"):
        skew_join(facts, other.withColumn("k", F.col("k").cast("int")), ["k"])
