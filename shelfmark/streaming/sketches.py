"""Distinct counts over any stretch of days, from one small sketch per day.

The sketches of a run are kept next to the history; those of the same day, of several
runs or of several days are merged without looking at any row again, and a row that
comes twice changes nothing.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.derive import steady_round
from shelfmark.streaming.history import DAY
from shelfmark.streaming.runs import append_run, read_runs

# Registers as a power of two: a standard error of about 1.04 / 2**(LOG_K / 2), 0.8 % here, and at most 8 KB.
LOG_K = 14


def _hashed(col: str) -> Column:
    # Sketches take numbers and texts; whatever the type, equal values are equal texts.
    return F.col(f"`{col}`").cast("string")


def append_sketches(
    df: DataFrame, path: str, run: str, ts: str, distinct: Sequence[str], keys: Sequence[str] = (), log_k: int = LOG_K,
) -> bool:
    """Add the sketches of a run's rows, one per day (and key) and column of ``distinct``; False if the run is known."""
    day = F.to_date(F.col(f"`{ts}`")).alias("_day")
    sketches = df.select(day, *[F.col(f"`{k}`") for k in keys], *[_hashed(c).alias(f"_{c}") for c in distinct]).groupBy(
        "_day", *keys).agg(*[F.hll_sketch_agg(f"_{c}", F.lit(log_k)).alias(c) for c in distinct])
    return append_run(sketches, path, run, "_day")


def merged_sketches(
    spark: SparkSession, path: str, distinct: Sequence[str], keys: Sequence[str] = (), since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """One sketch per key and column over the days from ``since`` to ``until``, both included; only those folders are read."""
    rows = read_runs(spark, path, since)
    if until is not None:
        rows = rows.where(F.col(DAY) <= F.lit(until).cast("date"))
    return rows.groupBy(*keys).agg(*[F.hll_union_agg(c).alias(c) for c in distinct])


def distinct_between(
    spark: SparkSession, path: str, distinct: Mapping[str, str], keys: Sequence[str] = (), since: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """Estimated different non-null values per key over a stretch of days; ``distinct`` maps columns to names.

    Without ``keys`` there is one row, with zeros where there are no days.
    """
    merged = merged_sketches(spark, path, list(distinct), keys, since, until)
    return merged.select(*keys, *[
        F.coalesce(F.hll_sketch_estimate(c), F.lit(0)).alias(name) for c, name in distinct.items()])


def mean_distinct_between(
    spark: SparkSession, path: str, col: str, keys: Sequence[str], since: str | None = None, until: str | None = None,
    name: str = "mean_distinct", digits: int = 4,
) -> DataFrame:
    """One row: estimated different values per key over a stretch of days, averaged over the keys seen in it."""
    each = distinct_between(spark, path, {col: "_d"}, keys, since, until)
    return each.agg(steady_round(F.avg("_d"), digits).alias(name))


def coverage_between(
    recommended: DataFrame, items: DataFrame, col: str, digits: int = 2,
) -> DataFrame:
    """One row: estimated percent of the items that are recommended, of two tables of ``merged_sketches``."""
    covered = recommended.agg(F.hll_sketch_estimate(F.hll_union_agg(f"`{col}`"))).scalar()
    total = items.agg(F.hll_sketch_estimate(F.hll_union_agg(f"`{col}`"))).scalar()
    return recommended.sparkSession.range(1).select(
        covered.alias("covered"), total.alias("total"),
        F.round(F.try_divide(covered * 100.0, total.cast("double")), digits).alias("coverage_percent"))
