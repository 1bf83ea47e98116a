"""Grouped answers: counts, averages, correlations, distributions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import steady_round


def count_by(df: DataFrame, *cols: str, name: str = "n", skip_null: bool = False) -> DataFrame:
    """Rows per value, most frequent first. Null is a value unless ``skip_null``."""
    if skip_null:
        df = df.dropna(subset=list(cols))
    return (
        df.groupBy(*cols).agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), *cols)
    )


def avg_by(
    df: DataFrame, key: str, value: str, name: str, digits: int | None = 4, count_name: str | None = "n",
) -> DataFrame:
    """Mean (rounded unless ``digits`` is None) and row count per group, highest mean first."""
    mean = F.avg(value) if digits is None else steady_round(F.avg(value), digits)
    aggs = [mean.alias(name)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return df.groupBy(key).agg(*aggs).orderBy(F.col(name).desc_nulls_last(), key)


def global_averages(df: DataFrame, names: dict[str, str], digits: int = 4) -> DataFrame:
    """One row with the rounded mean of each column, named as given."""
    return df.agg(*[steady_round(F.avg(c), digits).alias(n) for c, n in names.items()])


def correlation(df: DataFrame, x: str, y: str, name: str = "corr", digits: int = 6) -> DataFrame:
    """One row: Pearson correlation of the rows with both values; null if one is constant."""
    a, b = F.col(x).cast("double"), F.col(y).cast("double")
    both = a.isNotNull() & b.isNotNull()
    a, b = F.when(both, a), F.when(both, b)
    varies = (F.min(a) < F.max(a)) & (F.min(b) < F.max(b))
    covariance = F.covar_samp(a, b)
    value = F.try_divide(covariance, F.stddev_samp(a) * F.stddev_samp(b))
    return df.agg(F.when(varies, steady_round(value, digits)).alias(name))


def distribution(df: DataFrame, bucket: Column, bucket_name: str = "bucket", name: str = "n") -> DataFrame:
    """Rows per bucket, by bucket label."""
    return (
        df.select(bucket.alias(bucket_name)).groupBy(bucket_name)
        .agg(F.count(F.lit(1)).alias(name)).orderBy(bucket_name)
    )


def top_groups(df: DataFrame, where: Column, key: str, n: int, name: str = "n") -> DataFrame:
    """The ``n`` groups with most rows that satisfy ``where``."""
    return (
        df.where(where).groupBy(key).agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.col(name).desc(), key).limit(n)
    )


def distinct_count(df: DataFrame, col: str, name: str = "distinct", approx: bool = False) -> DataFrame:
    """One row: number of different non-null values."""
    return df.agg((F.approx_count_distinct(col) if approx else F.countDistinct(col)).alias(name))


def differing_rows(one: DataFrame, other: DataFrame, name: str = "differing") -> DataFrame:
    """One row: how many rows either table has more than the other, repeats and nulls counted, as ``exceptAll`` both ways.

    Both tables need the same columns, by name; each is read and shuffled once.
    """
    both = one.withColumn("_side", F.lit(1)).unionByName(other.withColumn("_side", F.lit(-1)))
    more = both.groupBy(*[f"`{c}`" for c in one.columns]).agg(F.abs(F.sum("_side")).alias("_more"))
    return more.agg(F.coalesce(F.sum("_more"), F.lit(0)).alias(name))


def mean_distinct_per_group(
    df: DataFrame, key: str | Sequence[str], value: str, name: str = "mean_distinct", digits: int = 4,
) -> DataFrame:
    """One row: different non-null values per group, averaged over the groups."""
    keys = [key] if isinstance(key, str) else list(key)
    return (
        df.groupBy(*keys).agg(F.countDistinct(value).alias("_d"))
        .agg(steady_round(F.avg("_d"), digits).alias(name))
    )
