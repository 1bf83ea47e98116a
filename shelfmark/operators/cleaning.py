"""Deduplication and filling of nulls, with the same result on every run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.operators.joins import orderable
from shelfmark.operators.quantiles import approx_quantiles, quantiles


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] = (), keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) by ``order``, then by all other columns.

    Nulls count as smallest. The row is picked by ``min``/``max`` over whole rows,
    so map tasks send one row per key, however often a key repeats.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    rest = [c for c in df.columns if c not in keys]
    ranked = [*order, *[c for c in orderable(df) if c in rest and c not in order]]
    unranked = [c for c in rest if c not in ranked]
    pick = F.min if keep == "first" else F.max
    if not rest:
        return df.distinct()
    by = F.struct(*[F.col(f"`{c}`") for c in ranked])
    if unranked:
        pick_by = F.min_by if keep == "first" else F.max_by
        row = pick_by(F.struct(*[F.col(f"`{c}`") for c in ranked + unranked]), by)
    else:
        row = pick(by)
    picked = df.groupBy(*keys).agg(row.alias("_row"))
    return picked.select(*[
        F.col(f"`{c}`") if c in keys else F.col(f"_row.`{c}`").alias(c) for c in df.columns
    ])


def medians(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with the median of each column; null where a column has no value.

    Exact by default; ``approx`` uses a sketch, which returns an existing value.
    """
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(f"`{c}`").cast("double").alias("_value")) for c in cols
    ])))
    if approx:
        each = approx_quantiles(long, "_value", [0.5], by=["_column"], names=["_median"])
    else:
        each = quantiles(long, "_value", [0.5], by=["_column"], names=["_median"], few_groups=True)
    return each.agg(*[F.max(F.when(F.col("_column") == c, F.col("_median"))).alias(c) for c in cols])


def median(df: DataFrame, col: str, approx: bool = False) -> DataFrame:
    return medians(df, [col], approx).select(F.col(f"`{col}`").alias("median"))


def mode_value(df: DataFrame, col: str) -> DataFrame:
    """One row: the most frequent non-null value (the smallest one on ties), or null."""
    counts = df.where(F.col(f"`{col}`").isNotNull()).groupBy(F.col(f"`{col}`").alias("mode")).agg(
        F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min_by("mode", F.struct(-F.col("_n"), F.col("mode"))).alias("mode"))


@dataclass(frozen=True)
class Median:
    """Fill with the column's median; with ``fallback`` if it has no value."""

    fallback: Any = None
    approx: bool = False


@dataclass(frozen=True)
class Mode:
    """Fill with the column's most frequent value; with ``fallback`` if it has none."""

    fallback: Any = None


def impute(df: DataFrame, fill: Mapping[str, Any], source: DataFrame | None = None) -> DataFrame:
    """Nulls filled by ``Median()``, ``Mode()`` or a constant per column.

    The statistics are scalar subqueries of the same plan, taken over ``source``
    (``df`` itself if absent): nothing passes through the driver.
    """
    source = source if source is not None else df
    types = {f.name: f.dataType for f in df.schema.fields}
    filled: dict[str, Column] = {}
    for approx in (False, True):
        cols = [c for c, how in fill.items() if isinstance(how, Median) and how.approx is approx]
        if cols:
            stats = medians(source, cols, approx).select(F.struct(*[F.col(f"`{c}`") for c in cols])).scalar()
            for c in cols:
                filled[c] = F.coalesce(
                    F.col(f"`{c}`"), stats.getField(c).cast(types[c]), F.lit(fill[c].fallback).cast(types[c]))
    for c, how in fill.items():
        if isinstance(how, Mode):
            filled[c] = F.coalesce(
                F.col(f"`{c}`"), mode_value(source, c).scalar(), F.lit(how.fallback).cast(types[c]))
        elif not isinstance(how, Median):
            filled[c] = F.coalesce(F.col(f"`{c}`"), F.lit(how).cast(types[c]))
    return df.withColumns(filled)
