"""How good recommendations are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import steady_round
from shelfmark.operators.aggregate import mean_distinct_per_group
from shelfmark.operators.joins import skew_join


def rating_error(predictions: DataFrame, label: str, prediction: str = "prediction", digits: int = 6) -> DataFrame:
    """One row: root mean squared and mean absolute error; nulls if nothing was predicted."""
    error = F.col(prediction).cast("double") - F.col(label).cast("double")
    return predictions.agg(
        steady_round(F.sqrt(F.avg(error * error)), digits).alias("rmse"),
        steady_round(F.avg(F.abs(error)), digits).alias("mae"),
    )


def coverage(recs: DataFrame, items: DataFrame, item: str, digits: int = 2) -> DataFrame:
    """One row: percent of the different items that are recommended to anybody."""
    total = items.agg(F.countDistinct(item)).scalar()
    return recs.agg(F.countDistinct(item).alias("covered")).select(
        "covered", total.alias("total"),
    ).withColumn(
        "coverage_percent",
        F.round(F.try_divide(F.col("covered") * 100.0, F.col("total").cast("double")), digits))


def diversity(
    recs: DataFrame, metadata: DataFrame, user: str, item: str, attribute: str, digits: int = 4,
) -> DataFrame:
    """One row: different attribute values per user's list, averaged over the users."""
    known = skew_join(recs.select(user, item), metadata.select(item, attribute), [item], how="left")
    return mean_distinct_per_group(known, user, attribute, "avg_diversity", digits)


def metrics_row(error: DataFrame, covered: DataFrame, diverse: DataFrame, params: Mapping) -> DataFrame:
    """The one-row summary: errors, coverage, diversity and the model's settings."""
    return error.select(
        "rmse", "mae",
        covered.select("coverage_percent").scalar().alias("coverage_percent"),
        diverse.select("avg_diversity").scalar().alias("avg_diversity"),
        F.struct(
            F.lit(int(params["rank"])).alias("rank"), F.lit(int(params["maxIter"])).alias("maxIter"),
            F.lit(float(params["regParam"])).alias("regParam"),
        ).alias("als_params"),
    )
