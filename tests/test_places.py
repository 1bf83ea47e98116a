"""The whole run on a small raw CSV written by hand."""

import random

import pytest

from shelfmark.plans import places
from shelfmark.sources import readers as rd

from conftest import rows


@pytest.fixture(scope="module")
def csv(tmp_path_factory):
    rnd = random.Random(5)
    head = [c.split()[0] for c in places.RAW_COLUMNS.split(", ")]
    lines = [",".join(head)]

    def line(i, rating, n, price, day=2, text="good"):
        where = f"{i} High Street, Ward 0{i % 4}" if i % 5 else f"{i} High Street, Old Town"
        kind = ["cafe", "bar", "buffet_place", "food"][i % 4]
        return (f'p{i},Place {i},"{where}",6.9,79.8,{rating},{n},{price},{i % 100}.5,"{kind}, food, establishment",'
                f',,{["True", "False", ""][i % 3]},2,"{text}",{rating},2024-01-0{day}T00:00:00+00:00')

    for i in range(60):
        lines.append(line(i, round(rnd.uniform(3, 5), 1), f"{rnd.randint(10, 900)}.0", i % 5))
    lines.append(line(3, 1.0, 1, 0, day=1, text="older row"))
    lines.append(line(60, "", "", 2))
    lines.append(line(61, "", 70, "", text='said ""fine"",\nthen left'))
    path = tmp_path_factory.mktemp("csv") / "raw.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def done(spark, csv, tmp_path_factory):
    return places.run(spark, csv, str(tmp_path_factory.mktemp("out")), "Ward", users=20)


def test_load_and_report(spark, csv, done):
    raw = spark.read.parquet(done["raw"])
    assert raw.count() == 63
    report = places.load_report(raw)
    nulls = {r["column"]: r["nulls"] for r in report["nulls"].collect()}
    assert (nulls["rating"], nulls["total_ratings"], nulls["price_level"], nulls["website"]) == (2, 1, 1, 63)
    assert report["schema"].count() == 17 and report["statistics"].count() == 4
    assert all(r["total_ratings"] >= 50 for r in report["top_rated"].collect())
    assert report["busiest"].first()["place_id"] == "p61"
    assert {r["label"] for r in report["price_levels"].collect()} == {
        "Budget", "Inexpensive", "Moderate", "Expensive", "Very Expensive", "Unknown"}


def test_clean(spark, done):
    df = spark.read.parquet(done["clean"])
    by = {r["place_id"]: r for r in df.collect()}
    assert len(by) == 61 and "p60" not in by
    assert by["p3"]["review_texts"] == "good"
    assert by["p61"]["rating"] is not None and by["p61"]["review_texts"] == 'said "fine",\nthen left'
    assert (by["p1"]["district"], by["p4"]["district"], by["p5"]["district"]) == ("Ward 1", "Ward 0", "Ward")
    assert [by[f"p{i}"]["cuisine_category"] for i in range(4)] == ["Cafe", "Bar", "Other", "Restaurant"]
    assert by["p2"]["price_label"] == "Moderate"


def test_results_are_written(spark, done):
    counts = rd.read_csv(spark, done["analyses"] + "/category_count", "category string, n long")
    assert sum(r["n"] for r in counts.collect()) == 61
    wide = rd.read_csv_inferred(spark, done["charts"] + "/heat_rating_wide")
    assert set(wide.columns) == {"district", "Cafe", "Bar", "Other", "Restaurant"}


def test_features_and_models(spark, done):
    df = spark.read.parquet(done["features"])
    assert df.columns == [*places.FEATURES_KEPT, "cuisine_index", "district_index", "user_id", "interaction_score",
                          "item_index"]
    assert sorted(r[0] for r in rows(df.select("item_index"))) == list(range(61))
    rd.load_features(done["feature_model"])
    model = rd.load_als(done["als_model"])
    assert model.rank == 10


def test_recommendations_and_metrics(spark, done):
    recs = spark.read.parquet(done["recommendations"])
    assert recs.groupBy("user_id").count().where("count > 10").count() == 0
    assert recs.where("name is null").count() == 0
    [m] = spark.read.json(done["metrics"]).collect()
    # One row per place: no test place is known, so there is no error to measure.
    assert "rmse" not in m.asDict() and 0 < m["coverage_percent"] <= 100


def test_missing_columns_are_named(spark, done):
    df = spark.read.parquet(done["clean"]).drop("rating")
    with pytest.raises(ValueError, match="rating"):
        places.ql.require_columns(df, places.REQUIRED)
