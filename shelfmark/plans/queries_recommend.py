"""Queries that build features, recommend and evaluate."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.functions.derive import vector_element
from shelfmark.operators import evaluate as ev
from shelfmark.operators import features as fe
from shelfmark.operators import rank as rk
from shelfmark.operators import recommend as rc
from shelfmark.operators.aggregate import differing_rows, mean_distinct_per_group
from shelfmark.operators.best_items import best_items
from shelfmark.plans import bindings as b
from shelfmark.plans.oracle_tables import BASELINE_RECS, BIAS, ENTITY, INTERACTIONS, SPLIT, on
from shelfmark.plans.registry import ORACLES, query
from shelfmark.sources.bucketed import write_bucketed
from shelfmark.sources.readers import load_als, load_features
from shelfmark.sources.staging import scratch_path, stage
from shelfmark.sources.writers import save_model


@query("label_codes", """
select p_brand as label, count(*) as n, row_number() over (order by count(*) desc, p_brand) - 1 as code
from part group by p_brand""")
def _(spark, folder):
    return fe.label_codes(b.table(spark, folder, "part"), "p_brand")


@query("index_labels", """
select p_partkey, p_brand, code::bigint as brand_code from part join (
  select p_brand, row_number() over (order by count(*) desc, p_brand) - 1 as code from part group by p_brand
) using (p_brand)""")
def _(spark, folder):
    part = b.table(spark, folder, "part").select("p_partkey", "p_brand")
    return fe.index_labels(part, "p_brand", "brand_code")


@query("index_items", """
select c_custkey, c_name, (row_number() over (order by c_name) - 1)::bigint as item_index from customer""")
def _(spark, folder):
    customers = b.table(spark, folder, "customer").select("c_custkey", "c_name")
    return fe.index_labels(customers, "c_name", "item_index")


@query("min_max", """
select p_partkey, round((p_retailprice - lo) / (hi - lo), 6) as price_unit from part,
  (select min(p_retailprice) as lo, max(p_retailprice) as hi from part)""")
def _(spark, folder):
    scaled = fe.min_max(b.table(spark, folder, "part"), {"p_retailprice": "price_unit"})
    return scaled.select("p_partkey", F.round("price_unit", 6).alias("price_unit"))


_CODES = ENTITY + """,
category_codes as (
  select category, row_number() over (order by count(*) desc, category) - 1 as category_index from entity group by category),
district_codes as (
  select district, row_number() over (order by count(*) desc, district) - 1 as district_index from entity group by district),
ranges as (select min(rating) as r0, max(rating) as r1, min(popularity) as p0, max(popularity) as p1 from entity)
"""

_VECTOR_SQL = on(_CODES, """
select item_id, round((rating - r0) / (r1 - r0), 6) as f0, round((popularity - p0) / (p1 - p0), 6) as f1,
  category_index::double as f2, district_index::double as f3, price_level::double as f4
from entity join category_codes using (category) join district_codes using (district), ranges""")


def _fit(df: DataFrame):
    return fe.fit_features(
        df, {"category": "category_index", "district": "district_index"},
        {"rating": "rating_unit", "popularity": "popularity_unit"}, ["price_level"])


def _vector_columns(df: DataFrame) -> DataFrame:
    return df.select("item_id", *[F.round(vector_element("features", i), 6).alias(f"f{i}") for i in range(5)])


@query("feature_vectors", _VECTOR_SQL)
def _(spark, folder):
    df = b.entity(spark, folder)
    return _vector_columns(_fit(df).transform(df))


@query("feature_model_reload", _VECTOR_SQL)
def _(spark, folder):
    df = b.entity(spark, folder)
    path = scratch_path(spark, "feature-model")
    save_model(_fit(df), path)
    return _vector_columns(load_features(path).transform(df))


@query("assemble", "select p_partkey, p_size::double as a, round(p_retailprice, 6) as b from part")
def _(spark, folder):
    df = fe.assemble(b.table(spark, folder, "part"), ["p_size", "p_retailprice"])
    return df.select("p_partkey", vector_element("features", 0).alias("a"),
                     F.round(vector_element("features", 1), 6).alias("b"))


@query("feature_table", on(_CODES, """
select item_id, name, category, district, rating, total_ratings, price_level, price_label, popularity,
  category_index::double as category_index, district_index::double as district_index,
  (('0x' || substr(md5(item_id::varchar), 1, 8))::bigint % 200 + 1)::int as user_id,
  greatest(1, least(5, round((rating - r0) / (r1 - r0) * 4 + 1)::int)) as interaction_score
from entity join category_codes using (category) join district_codes using (district), ranges"""))
def _(spark, folder):
    return fe.feature_table(
        b.entity(spark, folder), "item_id", {"category": "category_index", "district": "district_index"}, "rating",
        ["item_id", "name", "category", "district", "rating", "total_ratings", "price_level", "price_label",
         "popularity"])


@query("interactions", on(INTERACTIONS, "select * from interactions"))
def _(spark, folder):
    return b.interactions(spark, folder)


@query("split", on(SPLIT, "select user_id, item_id, score, train from flagged"))
def _(spark, folder):
    train, test = rc.split(b.interactions(spark, folder).select("user_id", "item_id", "score"), ["user_id", "item_id"])
    return train.withColumn("train", F.lit(True)).unionByName(test.withColumn("train", F.lit(False)))


@query("baseline_recs", on(BASELINE_RECS, "select * from baseline_recs"))
def _(spark, folder):
    return b.baseline_recs(spark, folder)


_ENRICHED = BASELINE_RECS + """,
enriched as (
  select user_id, item_id, rank, p_name as name, p_type as category, p_brand as brand
  from baseline_recs left join part on item_id = p_partkey)
"""


def _enriched(spark, folder):
    return rc.enrich(
        b.baseline_recs(spark, folder), b.parts_metadata(spark, folder), "item_id",
        ["user_id", "item_id", "rank", "name", "category", "brand"])


@query("enrich", on(_ENRICHED, "select * from enriched"))
def _(spark, folder):
    return _enriched(spark, folder)


@query("item_metadata", on(INTERACTIONS, """
select item_id, any_value(p_name) as name, any_value(p_type) as category
from interactions left join part on item_id = p_partkey group by item_id"""))
def _(spark, folder):
    items = b.interactions(spark, folder).select(F.col("item_id").alias("key"), "item_id")
    details = b.parts_metadata(spark, folder).withColumnRenamed("item_id", "key")
    return rc.item_metadata(items, "item_id", "key", details, ["name", "category"]).select(
        "item_id", "name", "category")


@query("lookup_top", on(_ENRICHED, """
select name, category, brand, rank, item_id from enriched
where user_id = (select min(user_id) from interactions)"""))
def _(spark, folder):
    first = b.interactions(spark, folder).agg(F.min("user_id")).scalar()
    recs = _enriched(spark, folder)
    return recs.where(F.col("user_id") == first).orderBy("rank").select("name", "category", "brand", "rank", "item_id")


@query("lookup_customer", "select o_orderkey, o_totalprice from orders where o_custkey = 7")
def _(spark, folder):
    return rk.lookup_top(
        b.table(spark, folder, "orders"), "o_custkey", 7, [F.col("o_totalprice").desc(), F.col("o_orderkey")],
    ).select("o_orderkey", "o_totalprice")


@query("rating_error", on(BIAS, """
select round(sqrt(avg((prediction - score) * (prediction - score))), 6) as rmse,
  round(avg(abs(prediction - score)), 6) as mae from predictions"""))
def _(spark, folder):
    return ev.rating_error(b.bias_predictions(spark, folder), "score")


@query("coverage", on(BASELINE_RECS, """
select covered, total, round(covered * 100.0::double / total, 2) as coverage_percent from
 (select count(distinct item_id) as covered from baseline_recs), (select count(distinct item_id) as total from interactions)"""))
def _(spark, folder):
    pairs = b.pairs_of(spark, folder)
    return ev.coverage(b.baseline_recs(spark, folder, pairs), pairs, "item_id")


_DIVERSITY = "select round(avg(d), 4) as avg_diversity from " \
    "(select user_id, count(distinct category) as d from enriched group by user_id)"


@query("diversity", on(_ENRICHED, _DIVERSITY))
def _(spark, folder):
    return ev.diversity(
        b.baseline_recs(spark, folder), b.parts_metadata(spark, folder), "user_id", "item_id", "category")


@query("categories_per_user", on(_ENRICHED, _DIVERSITY.replace("avg_diversity", "mean_distinct")))
def _(spark, folder):
    return mean_distinct_per_group(_enriched(spark, folder), "user_id", "category")


@query("als_recommend")
def _(spark, folder):
    return b.als_run(spark, folder).recommendations


@query("als_predictions")
def _(spark, folder):
    return b.als_run(spark, folder).predictions


@query("als_metrics")
def _(spark, folder):
    return b.als_run(spark, folder).metrics


@query("als_model_reload")
def _(spark, folder):
    path = scratch_path(spark, "als-model")
    save_model(b.als_run(spark, folder).model, path)
    return rc.recommend_all(load_als(path))


@query("als_prediction_keys", on(SPLIT, """
select user_id, item_id, score from flagged where not train
  and user_id in (select user_id from flagged where train) and item_id in (select item_id from flagged where train)"""))
def _(spark, folder):
    return b.als_run(spark, folder).predictions.select("user_id", "item_id", "score")


@query("als_prediction_check", "select 0::bigint as differing")
def _(spark, folder):
    # A prediction is the product of the user's and the item's factors.
    run = b.als_run(spark, folder)
    users = run.model.userFactors.select(F.col("id").cast("bigint").alias("user_id"), F.col("features").alias("u"))
    items = run.model.itemFactors.select(F.col("id").cast("bigint").alias("item_id"), F.col("features").alias("i"))
    product = F.aggregate(F.zip_with("u", "i", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    both = run.predictions.join(users, "user_id").join(items, "item_id")
    return both.agg(F.count_if(F.abs(product - F.col("prediction")) > 1e-3).alias("differing"))


@query("als_reload_check", "select 0::bigint as differing")
def _(spark, folder):
    path = scratch_path(spark, "als-model")
    model = b.als_run(spark, folder).model
    save_model(model, path)
    before, after = rc.recommend_all(model), rc.recommend_all(load_als(path))
    return differing_rows(before, after)


@query("als_subset_check", "select 0::bigint as differing")
def _(spark, folder):
    # The lists of the users in the test split alone are those that they have among all.
    run = b.als_run(spark, folder)
    users = stage(run.predictions.select("user_id").distinct(), "users")
    some = rc.recommend_for(run.model, users)
    every = rc.recommend_all(run.model).join(users, "user_id", "left_semi")
    return differing_rows(some, every)


@query("recommendations_order", "select 0::bigint as misplaced")
def _(spark, folder):
    table = rc.recommendations_table(b.als_run(spark, folder).model, b.parts_metadata(spark, folder), ["name", "category"])
    placed = table.withColumn("at", F.monotonically_increasing_id())
    wanted = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("predicted_score"), "item_id"))
    found = F.row_number().over(Window.partitionBy("user_id").orderBy("at"))
    both = placed.select("user_id", wanted.alias("wanted"), found.alias("found"))
    return both.agg(F.count_if(F.col("wanted") != F.col("found")).alias("misplaced"))


@query("metrics_row", on(BIAS, """
select round(sqrt(avg((prediction - score) * (prediction - score))), 6) as rmse,
  round(avg(abs(prediction - score)), 6) as mae, 10 as rank, 10 as max_iter, 0.1::double as reg_param from predictions"""))
def _(spark, folder):
    error = ev.rating_error(b.bias_predictions(spark, folder), "score")
    one = spark.range(1)
    row = ev.metrics_row(error, one.select(F.lit(1.0).alias("coverage_percent")), one.select(
        F.lit(1.0).alias("avg_diversity")), {"rank": 10, "maxIter": 10, "regParam": 0.1})
    return row.select("rmse", "mae", "als_params.rank", F.col("als_params.maxIter").alias("max_iter"),
                      F.col("als_params.regParam").alias("reg_param"))


@query("metrics_row_whole", f"""
select rmse, mae, coverage_percent, avg_diversity, 12 as rank, 7 as max_iter, 0.05::double as reg_param
from ({ORACLES["rating_error"]}), ({ORACLES["coverage"]}), ({ORACLES["diversity"]})""")
def _(spark, folder):
    # Lists, their coverage and the predictions are all made of one copy of the interactions.
    rows = b.flagged(spark, folder)
    pairs = rows.select("user_id", "item_id")
    recs = stage(b.baseline_recs(spark, folder, pairs), "recs")
    row = ev.metrics_row(
        ev.rating_error(b.bias_predictions(spark, folder, rows), "score"),
        ev.coverage(recs, pairs, "item_id"),
        ev.diversity(recs, b.parts_metadata(spark, folder), "user_id", "item_id", "category"),
        {"rank": 12, "maxIter": 7, "regParam": 0.05})
    return row.select("rmse", "mae", "coverage_percent", "avg_diversity", "als_params.rank",
                      F.col("als_params.maxIter").alias("max_iter"), F.col("als_params.regParam").alias("reg_param"))


@query("als_list_lengths", on(SPLIT, """
select user_id, least(10, (select count(distinct item_id) from flagged where train)) as items
from flagged where train group by user_id"""))
def _(spark, folder):
    recs = b.als_run(spark, folder).recommendations
    return recs.groupBy("user_id").agg(F.countDistinct("item_id").alias("items"))


_USER_VECTOR = ["c_nationkey", "c_custkey % 13 - 6", "c_custkey % 7 - 3"]
_ITEM_VECTOR = ["p_size - 20", "p_partkey % 11 - 5", "(p_partkey % 5 - 2) * (1 + p_size % 4)"]


def _vector(cols: list[str]):
    return F.array(*[F.expr(c).cast("double") for c in cols]).alias("features")


@query("best_items", f"""
with s as (
  select c_custkey as user_id, p_partkey as item_id,
    ({" + ".join(f"({u}) * ({i})" for u, i in zip(_USER_VECTOR, _ITEM_VECTOR, strict=True))})::double as score
  from customer, part),
r as (select *, row_number() over (partition by user_id order by score desc, item_id) as rank from s)
select user_id, rank::int as rank, item_id, score from r where rank <= 10""")
def _(spark, folder):
    users = b.table(spark, folder, "customer").select(F.col("c_custkey").alias("id"), _vector(_USER_VECTOR))
    items = b.table(spark, folder, "part").select(F.col("p_partkey").alias("id"), _vector(_ITEM_VECTOR))
    return best_items(users, items, 10).select(
        F.col("user").alias("user_id"), "rank", F.col("item").alias("item_id"), "score")


@query("als_best_check", "select 0::bigint as differing")
def _(spark, folder):
    # The scores are, place by place, those of the lists that all pairs give, and each is the product of its factors.
    model = b.als_run(spark, folder).model
    best = stage(rc.recommend_best(model), "best")
    place = F.row_number().over(Window.partitionBy("user_id").orderBy(F.desc("predicted_score"), "item_id"))

    def placed(lists, name):
        return lists.select("user_id", place.alias("place"), F.col("predicted_score").alias(name))

    scores = placed(best, "here").join(placed(rc.recommend_all(model, every=True), "there"), ["user_id", "place"], "full")
    apart = scores.agg(F.count_if(~F.coalesce(F.abs(F.col("here") - F.col("there")) < 1e-3, F.lit(False))).alias("n"))
    users = model.userFactors.select(F.col("id").cast("bigint").alias("user_id"), F.col("features").alias("u"))
    items = model.itemFactors.select(F.col("id").cast("bigint").alias("item_id"), F.col("features").alias("i"))
    product = F.aggregate(F.zip_with("u", "i", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    wrong = best.join(users, "user_id").join(items, "item_id").agg(
        F.count_if(F.abs(product - F.col("predicted_score")) > 1e-3).alias("n"))
    return apart.unionByName(wrong).agg(F.sum("n").alias("differing"))


@query("enrich_bucketed", on(_ENRICHED, "select * from enriched"))
def _(spark, folder):
    # Both tables lie in buckets by item, so the join moves no row.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def placed(df, name):
        path = scratch_path(spark, name)
        return write_bucketed(df, path.rpartition("/")[2].replace("-", "_"), "item_id", buckets, path)

    recs, details = placed(b.baseline_recs(spark, folder), "recs"), placed(b.parts_metadata(spark, folder), "details")
    return rc.enrich_bucketed(recs, details, "item_id", ["user_id", "item_id", "rank", "name", "category", "brand"])
