"""The standard set of analyses and chart tables of a cleaned catalogue."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import bucketize, ordinal_label
from shelfmark.functions.presets import PRICE_LABELS, RATING_EDGES, RATING_LABELS
from shelfmark.operators import aggregate as ag
from shelfmark.operators import charts as ch
from shelfmark.operators import rank as rk

KEY = "item_id"
Answer = Callable[[DataFrame], DataFrame]


def rating_bucket(clip: bool = False):
    return bucketize("rating", RATING_EDGES, RATING_LABELS, clip=clip)


def _luxury(df: DataFrame) -> DataFrame:
    return ag.top_groups(df, F.col("price_label") == "Luxury", "district", 5)


def _priced(df: DataFrame) -> DataFrame:
    return df.where(F.col("price_level").isNotNull())


# Fifteen analyses of a cleaned table by name.
ANALYSES: dict[str, Answer] = {
    "category_count": lambda df: ag.count_by(df, "category"),
    "district_count": lambda df: ag.count_by(df, "district"),
    "avg_rating_by_category": lambda df: ag.avg_by(df, "category", "rating", "avg_rating", 3),
    "avg_rating_by_district": lambda df: ag.avg_by(df, "district", "rating", "avg_rating", 3),
    "avg_price_by_category": lambda df: ag.avg_by(
        _priced(df), "category", "price_level", "avg_price_level", 2, None),
    "price_label_count": lambda df: ag.count_by(df, "price_label"),
    "top10_rated": lambda df: rk.top_n(
        df, [F.col("rating").desc(), F.col("total_ratings").desc(), F.col(KEY)], 10,
        [KEY, "name", "category", "district", "rating", "total_ratings", "price_label"]),
    "top10_reviewed": lambda df: rk.top_n(
        df, [F.col("total_ratings").desc(), F.col(KEY)], 10,
        [KEY, "name", "category", "district", "rating", "total_ratings"]),
    "corr_count_rating": lambda df: ag.correlation(df, "total_ratings", "rating"),
    "corr_price_rating": lambda df: ag.correlation(_priced(df), "price_level", "rating"),
    "open_now_count": lambda df: ag.count_by(df, "open_now"),
    "avg_popularity_by_district": lambda df: ag.avg_by(df, "district", "popularity", "avg_popularity"),
    "avg_popularity_by_category": lambda df: ag.avg_by(df, "category", "popularity", "avg_popularity"),
    "rating_bucket_count": lambda df: ag.distribution(df, rating_bucket(), "rating_bucket"),
    "luxury_top5_districts": _luxury,
}


def _top_reviewed_bars(df: DataFrame) -> DataFrame:
    top = rk.top_n(df, [F.col("total_ratings").desc(), F.col(KEY)], 10, [KEY, "name", "total_ratings"])
    return top.orderBy("total_ratings", F.col(KEY).desc())


# The tables behind ten charts by name. The heat map is in (row, column, mean)
# form; ``charts.pivot_mean`` gives the wide one.
CHARTS: dict[str, Answer] = {
    "bars_category": lambda df: ch.bars(df, "category"),
    "bars_district": lambda df: ch.bars(df, "district"),
    "bars_top10_reviewed": _top_reviewed_bars,
    "box_rating_by_category": lambda df: ch.box_stats(df, "category", "rating"),
    "scatter_count_rating": lambda df: ch.scatter_points(df, "total_ratings", "rating", "price_label"),
    "price_share": lambda df: ch.share(df, "price_label"),
    "heat_rating": lambda df: ch.mean_cells(df, "district", "category", "rating"),
    "histogram_rating": lambda df: ch.histogram(df, "rating", 20),
    "bars_popularity_by_district": lambda df: ag.avg_by(
        df, "district", "popularity", "avg_popularity", None, None),
    "rating_bucket_bars": lambda df: ch.ordered_counts(
        df, rating_bucket(clip=True), [*RATING_LABELS, "Unknown"]),
}


def analyses(df: DataFrame) -> dict[str, DataFrame]:
    """All analyses of a table; each is lazy and runs when it is read or written."""
    return {name: answer(df) for name, answer in ANALYSES.items()}


def chart_tables(df: DataFrame) -> dict[str, DataFrame]:
    """All chart tables of a table, lazy as well."""
    return {name: answer(df) for name, answer in CHARTS.items()}


def sql_summary(df: DataFrame, view: str = "catalogue") -> dict[str, DataFrame]:
    """The confirmation queries as SQL text on a temporary view."""
    df.createOrReplaceTempView(view)
    sql = df.sparkSession.sql
    by = "select {c}, count(*) as n from {v} group by {c} order by n desc, {c}"
    return {
        "category_count": sql(by.format(c="category", v=view)),
        "district_count": sql(by.format(c="district", v=view)),
        "overall": sql(
            "select round(avg(rating), 4) as overall_avg_rating, "
            f"round(avg(popularity), 4) as overall_avg_popularity from {view}"),
    }


def price_report(df: DataFrame, labels=None) -> DataFrame:
    """Rows per price level in level order, with the level's name."""
    counts = df.groupBy("price_level").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("label", ordinal_label("price_level", labels or PRICE_LABELS)).orderBy("price_level")
