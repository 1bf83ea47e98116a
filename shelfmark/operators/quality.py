"""Checks and profiles of a table. All results are DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The table itself, or a ValueError naming what is missing and what is there."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}; available: {df.columns}")
    return df


def schema_report(df: DataFrame) -> DataFrame:
    """Position, name and type of every column."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def null_audit(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 1) -> DataFrame:
    """Nulls and their percentage per column, with the column type; one pass."""
    require_columns(df, cols or [])
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}") for i, f in enumerate(fields)],
    )
    entries = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 F.col(f"_n{i}").alias("nulls"))
        for i, f in enumerate(fields)
    ])
    share = F.try_divide(F.col("nulls") * 100.0, F.col("rows").cast("double"))
    return (
        counts.select(F.col("_rows").alias("rows"), F.inline(entries))
        .select("column", "type", "rows", "nulls", F.round(share, digits).alias("percent"))
    )


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, smallest and largest value per numeric column; one pass."""
    stats = {"n": F.count, "mean": F.avg, "stddev": F.stddev_samp, "min": F.min, "max": F.max}
    wide = df.agg(*[
        fn(F.col(c).cast("double")).alias(f"_{i}_{name}")
        for i, c in enumerate(cols) for name, fn in stats.items()
    ])
    entries = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"_{i}_{name}").alias(name) for name in stats])
        for i, c in enumerate(cols)
    ])
    return wide.select(F.inline(entries))


def step_counts(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Rows before and after each named step and how many it removed.

    ``steps`` starts with the input. Counts shared by two steps run once.
    """
    spark = steps[0][1].sparkSession
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select("n").scalar() for _, df in steps]
    rows = F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(steps[i][0]).alias("step"),
                 counts[i - 1].alias("before"), counts[i].alias("after"))
        for i in range(1, len(steps))
    ])
    return spark.range(1).select(F.inline(rows)).withColumn("removed", F.col("before") - F.col("after"))


def observe_rows(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass here while some later write runs, without another pass."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
