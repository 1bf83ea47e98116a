import time

import numpy as np
import pytest
from pyspark.ml.recommendation import ALS
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfmark.operators import evaluate as ev
from shelfmark.operators import features as fe
from shelfmark.operators import recommend as rc
from shelfmark.plans import bindings as b
from shelfmark.plans import queries_recommend  # noqa: F401
from shelfmark.plans.registry import QUERIES
from shelfmark.sources import readers as rd
from shelfmark.sources import writers as wr
from shelfmark.sources.staging import free_unreferenced

from conftest import rows


def test_label_codes_over_many_tasks(spark):
    data = [("b",), ("a",), ("c",), ("c",), (None,)] + [(f"x{i:04d}",) for i in range(2000)]
    df = spark.createDataFrame(data, "l string").repartition(5)
    got = rows(fe.label_codes(df, "l").orderBy("code"))
    assert [r[0] for r in got] == ["c", "a", "b"] + [f"x{i:04d}" for i in range(2000)]
    assert [r[2] for r in got] == list(range(2003))


def test_index_labels_like_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(i, v) for i, v in enumerate(["b", "a", "c", "c", None])], "id int, l string")
    ours = {r["id"]: r["code"] for r in fe.index_labels(df, "l", "code").collect()}
    assert ours == {0: 2, 1: 1, 2: 0, 3: 0, 4: 3}
    model = StringIndexer(inputCol="l", outputCol="code", handleInvalid="keep").fit(df)
    assert {r["id"]: int(r["code"]) for r in model.transform(df).collect()} == ours


def test_min_max(spark):
    df = spark.createDataFrame([(1.0, 5), (3.0, 5), (None, 5)], "a double, b int")
    got = fe.min_max(df, {"a": "ua", "b": "ub"})
    assert sorted(rows(got.select("ua", "ub")), key=repr) == [(0.0, 0.5), (1.0, 0.5), (None, 0.5)]


def test_feature_model_reload(spark, folder, tmp_path):
    df = b.entity(spark, folder)
    model = fe.fit_features(df, {"category": "ci"}, {"rating": "ru"}, ["price_level"])
    wr.save_model(model, str(tmp_path / "m"))
    again = rd.load_features(str(tmp_path / "m"))
    keep = ["item_id", "features"]
    assert sorted(rows(model.transform(df).select(keep))) == sorted(rows(again.transform(df).select(keep)))


def test_feature_table_columns(spark, folder):
    out = fe.feature_table(
        b.entity(spark, folder), "item_id", {"category": "category_index"}, "rating", ["item_id", "absent", "rating"])
    assert out.columns == ["item_id", "rating", "category_index", "user_id", "interaction_score"]
    assert {r[0] for r in rows(out.select("interaction_score"))} <= {1, 2, 3, 4, 5}


def test_split_is_disjoint_complete_and_stable(spark, folder):
    df = b.interactions(spark, folder).select("user_id", "item_id", "score")
    train, test = rc.split(df, ["user_id", "item_id"])
    moved, _ = rc.split(df.repartition(7), ["user_id", "item_id"])
    assert sorted(rows(train)) == sorted(rows(moved))
    assert sorted(rows(train) + rows(test)) == sorted(rows(df))
    assert 0.75 < train.count() / df.count() < 0.85


def test_recommender_run(spark, folder, tmp_path):
    run = b.als_run(spark, folder)
    inter = b.interactions(spark, folder)
    recs = run.recommendations
    per_user = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.countDistinct("item_id").alias("d"))
    assert per_user.where("n > 10 or d < n").count() == 0
    assert recs.join(inter.select("item_id").distinct(), "item_id", "left_anti").count() == 0
    assert recs.where("name is null or category is null").count() == 0
    assert recs.columns == ["user_id", "item_id", "predicted_score", "name", "category", "brand"]

    wr.save_model(run.model, str(tmp_path / "als"))
    before, after = rc.recommend_all(run.model), rc.recommend_all(rd.load_als(str(tmp_path / "als")))
    assert sorted(rows(before)) == sorted(rows(after))

    [m] = run.metrics.collect()
    assert 0 < m["mae"] <= m["rmse"] < 4 and 0 < m["coverage_percent"] <= 100
    assert 1 <= m["avg_diversity"] <= 6
    assert m["als_params"].asDict() == {"rank": 10, "maxIter": 10, "regParam": 0.1}
    path = str(tmp_path / "metrics")
    wr.write_metrics(run.metrics, path)
    [back] = spark.read.json(path).collect()
    assert back["als_params"]["rank"] == 10 and back["rmse"] == m["rmse"]


def test_lists_are_sparks_own_and_no_pairs_are_joined(spark):
    rng = np.random.default_rng(5)
    train = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.choice(90, 12, replace=False)]
    model = rc.train_als(spark.createDataFrame(train, "user int, item int, score double"), "user", "item", "score")
    own = model.recommendForAllUsers(7).select("user", F.posexplode("recommendations").alias("at", "r"))
    wanted = {(r.user, r.at): r.score for r in own.select("user", "at", F.col("r.rating").alias("score")).collect()}
    for every in (False, True):
        lists = rc.recommend_all(model, 7, every=every)
        text = lists._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        places = Window.partitionBy("user").orderBy(F.desc("predicted_score"), "item")
        placed = lists.select("user", (F.row_number().over(places) - 1).alias("at"), "predicted_score")
        found = {(r.user, r.at): r.predicted_score for r in placed.collect()}
        assert found.keys() == wanted.keys() and all(abs(found[k] - wanted[k]) < 2e-4 for k in wanted)
    some = spark.createDataFrame([(3,), (3,), (2**40,)], "user long")
    assert sorted(rows(rc.recommend_for(model, some, 7))) == sorted(rows(rc.recommend_all(model, 7).where("user = 3")))


def test_training_leaves_no_shuffles(spark):
    rng = np.random.default_rng(6)
    train = [(int(u), int(i), float(rng.integers(1, 6))) for u in range(40) for i in rng.choice(90, 12, replace=False)]
    manager = spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker()
    free_unreferenced(spark)
    time.sleep(3)
    before = manager.shuffleStatuses().size()
    most, made = [], ALS._fit

    def fit(self, df):
        model = made(self, df)
        most.append(manager.shuffleStatuses().size() - before)
        return model

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(ALS, "_fit", fit)
        model = rc.train_als(spark.createDataFrame(train, "user int, item int, score double"), "user", "item", "score")
    # The ratings are dealt out in three shuffles; ten iterations of two each were 23 in all.
    assert most[0] < 10
    until = time.time() + 20
    while manager.shuffleStatuses().size() > before and time.time() < until:
        time.sleep(0.2)
    assert manager.shuffleStatuses().size() <= before
    assert model.userFactors.count() == 40 and model.getColdStartStrategy() == "drop" and model.rank == 10


def test_metrics_build_the_interactions_once(spark, folder, monkeypatch):
    made, built = b.interactions, []
    monkeypatch.setattr(b, "interactions", lambda *a: built.append(a) or made(*a))
    assert QUERIES["metrics_row_whole"](spark, folder).count() == 1
    assert len(built) == 1


@pytest.mark.parametrize("left", [0, 1, 2])
def test_a_lost_list_shows_in_the_subset_check(spark, folder, monkeypatch, left):
    made = rc.recommend_for
    monkeypatch.setattr(rc, "recommend_for", lambda model, users, *a: made(model, users, *a).where(F.col("user_id") % 3 != left))
    assert rows(QUERIES["als_subset_check"](spark, folder))[0][0] > 0


def test_the_checks_of_lists_read_each_table_once(spark, folder):
    for name, tables in (("als_reload_check", ["best-", "best-"]), ("als_subset_check", ["best-", "best-", "users-"])):
        df = QUERIES[name](spark, folder)
        plan = df._jdf.queryExecution().optimizedPlan()
        leaves = plan.collectLeaves()
        assert leaves.size() == len(tables)
        assert not any("/interactions-" in f for f in df.inputFiles())
        assert rows(df) == [(0,)]


def test_ids_beyond_int_are_refused(spark):
    big = spark.createDataFrame([(2**40, 1, 3.0)], "u long, i int, s double")
    with pytest.raises(Exception, match="Integer range|CAST_OVERFLOW"):
        rc.train_als(big, "u", "i", "s")


def test_recommendations_table_is_sorted(spark, folder):
    run = b.als_run(spark, folder)
    got = rows(rc.recommendations_table(run.model, b.parts_metadata(spark, folder), ["name"], 3))
    assert [(-r[0], r[2]) for r in got] == sorted([(-r[0], r[2]) for r in got], reverse=True)


def test_predictions_drop_the_unseen(spark, folder):
    run = b.als_run(spark, folder)
    unseen = spark.createDataFrame([(10**6, 10**6, 3)], "user_id int, item_id int, score int")
    assert rc.predict(run.model, unseen).count() == 0
    assert run.predictions.where("prediction is null").count() == 0


def test_metrics_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "user int, item int, score int, prediction float")
    assert rows(ev.rating_error(empty, "score")) == [(None, None)]
    assert rows(ev.coverage(empty, empty, "item").select("coverage_percent")) == [(None,)]
    df = spark.createDataFrame([(1, 3, 5.0), (1, 4, 4.0)], "user int, score int, prediction double")
    assert rows(ev.rating_error(df, "score")) == [(pytest.approx(2**0.5, abs=1e-6), 1.0)]


def test_a_swapped_metric_shows_in_a_query(spark, folder, monkeypatch):
    def found():
        return [rows(QUERIES[q](spark, folder)) for q in sorted(QUERIES) if q.startswith("metrics_row")]

    right, made = found(), ev.metrics_row

    def swapped(error, covered, diverse, params):
        as_covered = diverse.select(F.col("avg_diversity").alias("coverage_percent"))
        return made(error, as_covered, covered.select(F.col("coverage_percent").alias("avg_diversity")), params)

    monkeypatch.setattr(ev, "metrics_row", swapped)
    assert found() != right


def test_item_metadata_keeps_one_row_per_index(spark):
    items = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("zz", 2)], "key string, idx int")
    details = spark.createDataFrame([("a", "A", 1), ("b", "B", 2)], "key string, name string, extra int")
    got = rc.item_metadata(items, "idx", "key", details, ["name", "absent"])
    assert sorted(rows(got.select("idx", "name"))) == [(0, "A"), (1, "B"), (2, None)]


def test_diversity_ignores_unknown_attributes(spark):
    recs = spark.createDataFrame([(1, 1), (1, 2), (1, 9), (2, 1)], "user int, item int")
    meta = spark.createDataFrame([(1, "x"), (2, "y")], "item int, kind string")
    assert rows(ev.diversity(recs, meta, "user", "item", "kind")) == [(1.5,)]


def test_label_model_keeps_its_labels_in_a_table(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame(
        [("b", 1, "x"), ("a", 1, None), ("b", 2, "y"), (None, 3, "y"), ("c`d", 3, "z")], "l string, m int, o string").repartition(3)
    labels = {"l": "lc", "m": "mc", "o": "oc"}
    model = fe.fit_features(df, labels, {"m": "unit"}, ["m"])
    new = df.unionByName(spark.createDataFrame([("new", 9, "x")], df.schema))
    indexer = StringIndexer(inputCols=list(labels), outputCols=list(labels.values()), handleInvalid="keep").fit(df)
    wanted = sorted(rows(indexer.transform(new).select("l", "m", "o", *labels.values())), key=repr)
    assert sorted(rows(model.transform(new).select("l", "m", "o", *labels.values())), key=repr) == wanted
    path = str(tmp_path / "model")
    wr.save_model(model, path)
    wr.save_model(model, path)
    again = PipelineModel.load(path)
    assert sorted(rows(again.transform(new).select("features")), key=repr) == sorted(rows(model.transform(new).select("features")), key=repr)
    # The labels are in the model's folder as a table, not in its metadata.
    metadata = "".join(p.read_text() for p in (tmp_path / "model").rglob("metadata/part-*"))
    assert "c`d" not in metadata and list((tmp_path / "model").rglob("codes/*.parquet"))
    copied = model.copy()
    assert copied.transform(new).count() == 6


def test_many_labels_are_joined_and_not_collected(spark):
    df = spark.range(20_000).selectExpr("concat('item ', id) as l", "cast(id as double) as v")
    model = fe.fit_features(df, {"l": "code"}, {"v": "unit"})
    out = model.transform(df)
    assert out.agg({"code": "max"}).first()[0] == 19_999 and out.select("code").distinct().count() == 20_000
    assert all(len(str(p)) < 5000 for s in model.stages for p in s.extractParamMap().values())
