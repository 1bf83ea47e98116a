"""The given tables seen as a catalogue, as interactions and as a history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.derive import (
    extract_code, in_unit, map_values, ordinal_label, popularity, primary_tag, rescale_to_int,
)
from shelfmark.functions.presets import PRICE_LABELS
from shelfmark.operators.cleaning import Median, Mode
from shelfmark.operators.joins import skew_join
from shelfmark.operators.rank import top_n_per_group
from shelfmark.operators.recommend import in_training
from shelfmark.plans.cleaning import CleanSpec, clean
from shelfmark.sources.staging import stage

GENERAL_TAGS = ["small", "large", "red", "blue", "old", "new", "hot", "cold"]
CATEGORIES = {
    "ring": "Jewellery", "bolt": "Fasteners", "rod": "Fasteners", "gear": "Machinery",
    "widget": "Gadgets", "gizmo": "Gadgets", "plate": "Tableware",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _null_if(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def raw(spark: SparkSession, folder: str) -> DataFrame:
    """Parts as catalogue items, rated by their order lines.

    The tables hold no nulls, so some are induced by key. Every fifth item was
    collected in two runs.
    """
    key, runs = F.col("p_partkey"), F.col("_run")
    lines = (
        table(spark, folder, "lineitem").groupBy("l_partkey")
        .agg(
            F.round(1 + 4 * (F.avg("l_quantity") - 1) / 49, 1).alias("_rating"),
            F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col("l_returnflag") == "R").alias("_returned"),
            F.sum(F.round(F.col("l_tax") * 100).cast("bigint")).alias("_tax"),
        )
    )
    # One row per item on both sides.
    items = table(spark, folder, "part").join(lines, F.col("p_partkey") == F.col("l_partkey"), "left")
    seen = items.withColumn("_run", F.explode(
        F.when(key % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(2)))))
    return seen.select(
        key.alias("item_id"),
        F.col("p_name").alias("name"),
        F.when(key % 9 == 0, F.concat(key.cast("string"), F.lit(" Main Street")))
        .otherwise(F.concat(key.cast("string"), F.lit(" Main Street, "), F.col("p_brand"))).alias("address"),
        F.concat(F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit(", "), F.lower("p_type")).alias("tags"),
        _null_if(key % 7 == 0, F.col("_rating")).alias("rating"),
        _null_if(key % 11 == 0, F.when(runs == 2, F.col("_n")).otherwise(F.floor(F.col("_n") / 2))).alias(
            "total_ratings"),
        _null_if(key % 13 == 0, F.col("p_size") % 5).alias("price_level"),
        F.when(key % 3 == 0, True).when(key % 3 == 1, False).alias("open_now"),
        _null_if(key % 17 == 0, F.col("_returned")).alias("review_count"),
        _null_if(key % 4 == 0, F.concat_ws(" | ", "p_name", "p_type")).alias("review_texts"),
        _null_if(key % 19 == 0, F.round(1 + 4 * (F.col("_tax") / F.col("_n")) / 8, 1)).alias("avg_review_rating"),
        F.when(runs == 2, F.lit("2024-01-02 00:00:00")).otherwise(F.lit("2024-01-01 00:00:00"))
        .cast("timestamp_ntz").alias("collected_at"),
    )


def entity_spec() -> CleanSpec:
    return CleanSpec(
        keys=["item_id"],
        order=["collected_at"],
        need_any=["rating", "total_ratings"],
        fill={
            "rating": Median(), "avg_review_rating": Median(), "price_level": Mode(fallback=1),
            "total_ratings": 0, "review_count": 0, "review_texts": "",
        },
        derive=[
            {
                "district": extract_code("address", "Brand#", fallback="No brand", label="Brand"),
                "primary_type": primary_tag("tags", default="thing", stop=GENERAL_TAGS),
                "popularity": popularity("total_ratings", "rating"),
                "price_label": ordinal_label("price_level", PRICE_LABELS),
            },
            {"category": map_values("primary_type", CATEGORIES, "Other")},
        ],
        types={"rating": "double", "total_ratings": "bigint", "price_level": "int"},
    )


def clean_entity(spark: SparkSession, folder: str) -> DataFrame:
    return clean(raw(spark, folder), entity_spec())


def entity(spark: SparkSession, folder: str) -> DataFrame:
    """The cleaned catalogue, as a plan over the tables that are there now."""
    return clean_entity(spark, folder)


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    """Who bought what: customers as users, parts as items, 1..5 by mean quantity."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber", "l_quantity")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return (
        skew_join(lines, orders, ["o_orderkey"], how="inner")
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.avg("l_quantity").alias("_q"), F.count(F.lit(1)).alias("n"))
        .select("user_id", "item_id", rescale_to_int(in_unit("_q", 1, 50)).alias("score"), "n")
    )


def pairs_of(spark: SparkSession, folder: str) -> DataFrame:
    """The pairs of user and item alone, written."""
    return stage(interactions(spark, folder).select("user_id", "item_id"), "pairs")


def baseline_recs(spark: SparkSession, folder: str, pairs: DataFrame | None = None) -> DataFrame:
    """Each user's ten items that most users have, ties by item."""
    pairs = pairs_of(spark, folder) if pairs is None else pairs
    users = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("users"))
    return top_n_per_group(
        skew_join(pairs, users, ["item_id"]), ["user_id"], [F.col("users").desc(), F.col("item_id")], 10)


def flagged(spark: SparkSession, folder: str) -> DataFrame:
    """The interactions with whether they train, written."""
    return stage(interactions(spark, folder).withColumn("_train", in_training(["user_id", "item_id"])), "interactions")


def bias_predictions(spark: SparkSession, folder: str, rows: DataFrame | None = None) -> DataFrame:
    """Test pairs predicted as user mean + item mean - overall mean of the training pairs."""
    rows = flagged(spark, folder) if rows is None else rows
    train, test = rows.where("_train"), rows.where("not _train").drop("_train")
    users = train.groupBy("user_id").agg(F.avg("score").alias("_u"))
    items = train.groupBy("item_id").agg(F.avg("score").alias("_i"))
    pair = ["user_id", "item_id"]
    with_users = skew_join(test, users, ["user_id"], "inner", spread_by=pair)
    known = skew_join(with_users, items, ["item_id"], "inner", spread_by=pair, counted=test)
    overall = train.agg(F.avg("score")).scalar()
    return known.select(
        "user_id", "item_id", "score", (F.col("_u") + F.col("_i") - overall).alias("prediction"))


def parts_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Item details: one row per part."""
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"))


def als_run(spark: SparkSession, folder: str):
    """One recommender run over all interactions, which are written first as training reads them often."""
    from shelfmark.plans.recommending import recommend

    return recommend(
        stage(interactions(spark, folder), "interactions"), parts_metadata(spark, folder), "user_id", "item_id", "score",
        attribute="category", cols=["name", "category", "brand"])
