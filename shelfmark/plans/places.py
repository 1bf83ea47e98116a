"""A catalogue of rated places from its raw CSV to recommendations and metrics.

Each step is a function from DataFrame to DataFrame; ``run`` chains them and
writes every result. Steps hand over Parquet, so a later one reads only the
columns it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions import presets
from shelfmark.functions.derive import extract_code, map_values, ordinal_label, popularity, primary_tag
from shelfmark.operators import charts as ch
from shelfmark.operators import features as fe
from shelfmark.operators import quality as ql
from shelfmark.operators import rank as rk
from shelfmark.operators import recommend as rc
from shelfmark.operators.cleaning import Median, Mode, impute
from shelfmark.plans import analyses as an
from shelfmark.plans.cleaning import CleanSpec, clean
from shelfmark.plans.recommending import Recommendation, recommend
from shelfmark.sources import readers as rd
from shelfmark.sources import writers as wr

# Columns of the raw table.
RAW_COLUMNS = (
    "place_id string, name string, address string, lat double, lng double, rating double, total_ratings int, "
    "price_level int, busyness_score double, types string, phone string, website string, open_now boolean, "
    "review_count int, review_texts string, avg_review_rating double, collected_at string"
)

# Columns that recommending needs.
REQUIRED = ["place_id", "name", "cuisine_category", "district", "rating", "price_level", "popularity_score",
            "total_ratings"]

# Columns of the feature table that are taken over.
FEATURES_KEPT = ["place_id", "name", "cuisine_category", "district", "rating", "total_ratings", "price_level",
                 "price_label", "popularity_score"]


def load(spark: SparkSession, csv: str) -> DataFrame:
    """The raw CSV under its schema, the collection time as a timestamp."""
    df = rd.read_csv(spark, csv, RAW_COLUMNS, multiline=True, escape='"')
    return df.withColumn("collected_at", F.col("collected_at").try_cast("timestamp"))


def load_report(df: DataFrame) -> dict[str, DataFrame]:
    """Schema, nulls, statistics and first insights of a raw table."""
    shown = ["place_id", "name", "address"]
    return {
        "schema": ql.schema_report(df),
        "nulls": ql.null_audit(df),
        "statistics": ql.describe(df, ["rating", "total_ratings", "busyness_score", "price_level"]),
        "top_rated": rk.top_n_min_support(
            df, [F.col("rating").desc(), F.col("place_id")], 5, "total_ratings", 50,
            [*shown, "rating", "total_ratings"]),
        "busiest": rk.top_n(df, [F.col("busyness_score").desc(), F.col("place_id")], 5, [*shown, "busyness_score"]),
        "price_levels": an.price_report(df, presets.PRICE_REPORT_LABELS),
    }


def clean_spec(area: str) -> CleanSpec:
    """How to clean; ``area`` is the name that stands before district numbers in addresses."""
    return CleanSpec(
        keys=["place_id"],
        order=["collected_at"],
        need_any=["rating", "total_ratings"],
        fill={
            "rating": Median(), "avg_review_rating": Median(), "price_level": Mode(fallback=1),
            "total_ratings": 0, "review_count": 0, "review_texts": "",
        },
        derive=[
            {
                "district": extract_code("address", area),
                "primary_type": primary_tag("types", "restaurant", presets.GENERIC_TAGS),
                "popularity_score": popularity("total_ratings", "rating"),
                "price_label": ordinal_label("price_level", presets.PRICE_LABELS),
            },
            {"cuisine_category": map_values("primary_type", presets.TAG_CATEGORIES, "Other")},
        ],
    )


def for_analysis(df: DataFrame) -> DataFrame:
    """The column names that the standard analyses use."""
    return df.withColumnsRenamed(
        {"place_id": "item_id", "cuisine_category": "category", "popularity_score": "popularity"})


def features(df: DataFrame, users: int = 200) -> DataFrame:
    """The feature table; what is still null is filled first."""
    filled = impute(df, {"rating": Median(4.0), "popularity_score": Median(0.0), "price_level": 1})
    return fe.feature_table(
        filled, "place_id", {"cuisine_category": "cuisine_index", "district": "district_index"}, "rating",
        FEATURES_KEPT, users)


def item_index(df: DataFrame) -> DataFrame:
    """The feature table with an integer per place; saved once and used by all later steps."""
    return fe.index_labels(df, "place_id", "item_index")


def metadata(indexed: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Details per item index."""
    return rc.item_metadata(
        indexed, "item_index", "place_id", cleaned, ["name", "cuisine_category", "district", "rating", "price_label"])


def recommend_places(indexed: DataFrame, cleaned: DataFrame, n: int = 10) -> Recommendation:
    """Train on the indexed feature table and recommend ``n`` places to every user.

    If every place has one row only, no test place was seen in training; the
    errors are then null. Pass a table of real interactions to measure them.
    """
    return recommend(
        indexed.select("user_id", "item_index", "interaction_score"), metadata(indexed, cleaned),
        "user_id", "item_index", "interaction_score", attribute="cuisine_category",
        cols=["name", "cuisine_category", "district", "rating", "price_label"], n=n)


def run(spark: SparkSession, csv: str, folder: str, area: str, users: int = 200) -> dict[str, str]:
    """All steps, each result written below ``folder``; returns where."""
    at = {name: f"{folder}/{name}" for name in (
        "raw", "report", "clean", "analyses", "charts", "final", "features", "feature_model", "als_model",
        "recommendations", "metrics")}

    def written(df: DataFrame, name: str) -> DataFrame:
        wr.write_parquet(df, at[name])
        return spark.read.parquet(at[name])

    raw = written(load(spark, csv), "raw")
    wr.write_results(load_report(raw), at["report"], fmt="parquet")
    cleaned = written(clean(raw, clean_spec(area), staged=True), "clean")
    named = for_analysis(cleaned)
    wr.write_results(an.analyses(named), at["analyses"])
    heat = ch.pivot_mean(
        named, "district", "category", "rating", [*dict.fromkeys(presets.TAG_CATEGORIES.values()), "Other"], min_rows=2)
    wr.write_results({**an.chart_tables(named), "heat_rating_wide": heat}, at["charts"])
    final = written(ql.require_columns(cleaned, REQUIRED), "final")

    indexed = written(item_index(features(final, users)), "features")
    wr.save_model(fe.fit_features(
        final, {"cuisine_category": "cuisine_index", "district": "district_index"},
        {"rating": "rating_normalized", "popularity_score": "popularity_normalized"}, ["price_level"],
    ), at["feature_model"])
    found = recommend_places(indexed, cleaned)
    wr.save_model(found.model, at["als_model"])
    wr.write_parquet(found.recommendations, at["recommendations"])
    wr.write_metrics(found.metrics, at["metrics"])
    return at
