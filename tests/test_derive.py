import hashlib
import math

import pytest
from pyspark.sql import functions as F

from shelfmark.functions import derive as dv
from shelfmark.functions import nested as ns
from shelfmark.functions import presets

from conftest import rows


def values(spark, data, schema, col):
    return [r[0] for r in spark.createDataFrame([(d,) for d in data], schema).select(col).collect()]


def test_extract_code(spark):
    texts = ["1 x, Ward 03, SL", "ward7", "WARD 10", "Ward 100", "Ward 0", "Ward 00", "Old town, SL", None]
    got = values(spark, texts, "a string", dv.extract_code("a", "Ward"))
    assert got == ["Ward 3", "Ward 7", "Ward 10", "Ward 10", "Ward 0", "Ward 0", "Ward", "Ward"]


def test_extract_code_takes_names_literally(spark):
    assert values(spark, ["aXb 1", "a.b 1"], "a string", dv.extract_code("a", "a.b", "none")) == ["none", "a.b 1"]


def test_primary_tag(spark):
    tags = ["cafe, restaurant, food", "food,establishment", "", None, "food, food, bar, cafe"]
    got = values(spark, tags, "a string", dv.primary_tag("a", "restaurant", presets.GENERIC_TAGS))
    assert got == ["cafe", "restaurant", "", "restaurant", "bar"]
    assert values(spark, ["x y"], "a string", dv.primary_tag("a", "d", sep=" ")) == ["x"]
    spaced = ["  cafe  ,bar", "food ,  bar ,x", ",cafe", "food, ", "ice cream, bar"]
    got = values(spark, spaced, "a string", dv.primary_tag("a", "d", presets.GENERIC_TAGS))
    assert got == ["cafe", "bar", "", "", "ice cream"]


def test_map_values(spark):
    col = dv.map_values("a", presets.TAG_CATEGORIES, "Other")
    assert values(spark, ["night_club", "buffet", None], "a string", col) == ["Bar", "Other", "Other"]
    assert values(spark, ["x"], "a string", dv.map_values("a", {}, "Other")) == ["Other"]


def test_ordinal_label(spark):
    got = values(spark, [0, 4, 5, None], "a int", dv.ordinal_label("a", presets.PRICE_LABELS))
    assert got == ["Free", "Luxury", "Unknown", "Unknown"]


def test_bucketize_edges(spark):
    data = [0.5, 1.0, 1.99, 2.0, 3.0, 4.0, 5.0, 5.1, None, float("nan")]
    poor, average, good, excellent = presets.RATING_LABELS
    strict = values(spark, data, "a double", dv.bucketize("a", presets.RATING_EDGES, presets.RATING_LABELS))
    assert strict == ["Unknown", poor, poor, average, good, excellent, excellent] + ["Unknown"] * 3
    clipped = values(spark, data, "a double", dv.bucketize("a", presets.RATING_EDGES, presets.RATING_LABELS, clip=True))
    assert clipped == [poor, poor, poor, average, good, excellent, excellent, excellent] + ["Unknown"] * 2
    fine = dv.bucketize("a", presets.FINE_RATING_EDGES, presets.FINE_RATING_LABELS, closed_last=False)
    assert values(spark, [0.0, 3.5, 4.49, 5.0, 5.01], "a double", fine) == [
        "Poor", "Average", "Good", "Excellent", "Unknown"]
    with pytest.raises(ValueError):
        dv.bucketize("a", [1, 2], ["x", "y"])


def test_popularity(spark):
    df = spark.createDataFrame([(0, 4.0), (99, 4.5), (None, 4.0), (5, None)], "n int, r double")
    got = [r[0] for r in df.select(dv.popularity("n", "r")).collect()]
    assert got == [0.0, round(math.log1p(99) * 4.5, 4), None, None]


@pytest.mark.parametrize("weights,digits,spread,centre,per,places", [
    (presets.HOUR_WEIGHTS, 8, 15, 7, 100, 1),
    ([p / 100 for p in presets.HOUR_PERCENT], 4, 140, 70, 1000, 2),
])
def test_load_score(spark, weights, digits, spread, centre, per, places):
    data = [(f"key{i}", n, f"2024-01-01 {h:02d}:30:00")
            for i, (n, h) in enumerate([(0, 0), (12, 5), (4500, 13), (10**7, 19), (None, 23)])]
    df = spark.createDataFrame(data, "k string, n long, t string").withColumn("t", F.to_timestamp("t"))
    col = dv.load_score("k", "n", "t", weights, digits, spread, centre, per, places)
    for (key, n, t), (got,) in zip(data, df.select(col).collect(), strict=True):
        offset = (int(hashlib.md5(key.encode()).hexdigest()[:digits], 16) % spread - centre) / per
        raw = 0.6 * min(math.log1p(n or 0) / math.log1p(5000), 1.0) + 0.4 * weights[int(t[11:13])] + offset
        assert got == pytest.approx(min(max(raw * 100, 0), 100), abs=0.51 * 10**-places)
        assert 0 <= got <= 100


def test_surrogate_key(spark):
    wanted = "ID" + hashlib.md5(b"a-1").hexdigest()[:20].upper()
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    assert rows(df.select(dv.surrogate_key(["x", "y"], "ID"))) == [(wanted,)]


def test_assign_bucket_ignores_partitioning(spark):
    df = spark.range(1000)
    one = rows(df.repartition(1).select("id", dv.assign_bucket("id", 200)))
    many = rows(df.repartition(7).select("id", dv.assign_bucket("id", 200)))
    assert sorted(one) == sorted(many)
    assert {b for _, b in one} <= set(range(1, 201))


def test_rescale_to_int(spark):
    got = values(spark, [0.0, 0.124, 0.125, 0.5, 1.0, 1.7, -3.0, None], "a double", dv.rescale_to_int("a"))
    assert got == [1, 1, 2, 3, 5, 5, 1, None]


RECORDS = [
    '{"id": "p1", "name": "A", "geo": {"location": {"lat": 6.9}}, "hours": {"open_now": true},'
    ' "types": ["cafe", "food"], "reviews": [{"text": "good", "rating": 4}, {"rating": 5}, {"text": "x"}]}',
    '{"name": "B", "geo": {}, "reviews": []}',
    "{}",
    "broken",
    None,
]
SCHEMA = ("id string, name string, geo struct<location: struct<lat: double>>, hours struct<open_now: boolean>, "
          "types array<string>, reviews array<struct<text: string, rating: double>>")


def test_flatten_details(spark):
    df = spark.createDataFrame([(f"k{i}", r) for i, r in enumerate(RECORDS)], "k string, payload string")
    flat = ns.flatten_details(
        df, "payload", SCHEMA,
        {"id": "id", "name": "name", "lat": "geo.location.lat", "open_now": "hours.open_now"}, ("id", "k"))
    assert sorted(rows(flat)) == [("k1", "B", None, None), ("p1", "A", 6.9, True)]


def test_flatten_details_on_structs(spark):
    df = spark.createDataFrame([(((1,),),), ((None,),)], "r struct<a: struct<b: int>>")
    assert rows(ns.flatten_details(df, "r", "", {"b": "a.b"})) == [(1,)]


def test_rollup_nested(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "payload string").select(
        F.from_json("payload", SCHEMA).alias("r"))
    known = df.where("r.name is not null").orderBy("r.name")
    assert rows(known.select(*ns.rollup_nested("r.reviews", "text", "rating", missing_as=0))) == [
        (3, "good |  | x", 3.0), (0, "", None)]
    assert rows(known.select(*ns.rollup_nested("r.reviews", "text", "rating"))) == [
        (3, "good |  | x", 4.5), (0, "", None)]
    assert rows(known.select(ns.joined_tags(F.col("r.types")))) == [("cafe, food",), ("",)]
