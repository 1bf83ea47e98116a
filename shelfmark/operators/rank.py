"""Sorted and ranked results. Orders should end in a unique column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, order: Sequence[Column], n: int, cols: Sequence[str] | None = None) -> DataFrame:
    """The first ``n`` rows: each task keeps ``n``, then those are merged."""
    best = df.orderBy(*order).limit(n)
    return best.select(*cols) if cols else best


def top_n_min_support(
    df: DataFrame, order: Sequence[Column], n: int, support: str, at_least: float,
    cols: Sequence[str] | None = None,
) -> DataFrame:
    """``top_n`` among the rows with enough support."""
    return top_n(df.where(F.col(support) >= at_least), order, n, cols)


def top_n_per_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group with their rank.

    Spark cuts each group to ``n`` rows before the shuffle, so a huge group
    sends at most ``n`` rows per task (for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000 unless set).
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def total_sort(df: DataFrame, order: Sequence[Column], whole: bool = True) -> DataFrame:
    """All rows in order; with ``whole=False`` only within each output file."""
    return df.orderBy(*order) if whole else df.sortWithinPartitions(*order)


def lookup_top(df: DataFrame, key: str, value, order: Sequence[Column]) -> DataFrame:
    """One key's rows in order; an unknown key gives none."""
    return df.where(F.col(key) == F.lit(value)).orderBy(*order)
