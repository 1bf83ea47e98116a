"""The tables behind charts; drawing is left to the caller."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.derive import steady_round
from shelfmark.operators.aggregate import count_by
from shelfmark.operators.joins import skew_join
from shelfmark.operators.quantiles import quantiles
from shelfmark.sources.staging import stage


def share(df: DataFrame, col: str, digits: int = 1) -> DataFrame:
    """Rows and percent of all rows per non-null value (pie)."""
    counts = df.dropna(subset=[col]).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return (
        counts.withColumn("percent", F.round(F.col("n") * 100.0 / total, digits))
        .orderBy(F.col("n").desc(), col)
    )


def _fences(df: DataFrame, group: str, value: str) -> DataFrame:
    """Every known value with its group's quartiles and whether it lies within the limits."""
    key, v = F.struct(F.col(f"`{group}`")).alias("_key"), F.col(f"`{value}`").cast("double") + 0.0
    # Read three times, so two columns of it are written once.
    values = stage(df.select(key, v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v")), "box")
    quartiles = stage(quantiles(values, "_v", [0.25, 0.5, 0.75], by=["_key"], names=["q1", "median", "q3"]), "quartiles")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    return values.join(quartiles, "_key").withColumn(
        "_inside", (F.col("_v") >= F.col("q1") - reach) & (F.col("_v") <= F.col("q3") + reach))


def box_stats(df: DataFrame, group: str, value: str) -> DataFrame:
    """Per group: quartiles, furthest values within 1.5 quartile distances, outlier rows (box plot).

    Highest median first. The quartiles are exact.
    """
    inside = F.when(F.col("_inside"), F.col("_v"))
    return (
        _fences(df, group, value).groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
            F.min(inside).alias("whisker_low"), F.max(inside).alias("whisker_high"),
            F.count_if(~F.col("_inside")).alias("outliers"),
        )
        .select(F.col(f"_key.`{group}`").alias(group), "n", "q1", "median", "q3",
                "whisker_low", "whisker_high", "outliers")
        .orderBy(F.col("median").desc(), group)
    )


def box_outliers(df: DataFrame, group: str, value: str) -> DataFrame:
    """The values beyond the whiskers, with their row counts."""
    beyond = _fences(df, group, value).where(~F.col("_inside"))
    return beyond.groupBy("_key", "_v").agg(F.count(F.lit(1)).alias("n")).select(
        F.col(f"_key.`{group}`").alias(group), F.col("_v").alias(value), "n")


def scatter_points(df: DataFrame, x: str, y: str, label: str, log_x: bool = True) -> DataFrame:
    """(x, y, label) of the drawable rows: both values known and, on a log axis, x above 0."""
    points = df.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col(label).alias("label"))
    points = points.where(F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("label").isNotNull())
    return points.where(F.col("x") > 0) if log_x else points


def _all_cells(df: DataFrame, row: str, col: str, value: str, digits: int) -> DataFrame:
    return (
        df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
        .groupBy(row, col).agg(steady_round(F.avg(value), digits).alias("mean"))
        .where(F.col("mean").isNotNull())
    )


def _filled_columns(cells: DataFrame, col: str, min_rows: int) -> DataFrame:
    return cells.groupBy(col).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") >= min_rows).select(col)


def mean_cells(
    df: DataFrame, row: str, col: str, value: str, digits: int = 2, min_rows: int = 2,
) -> DataFrame:
    """Rounded mean per (row, column) pair, for columns filled in at least ``min_rows`` rows."""
    cells = _all_cells(df, row, col, value, digits)
    kept = _filled_columns(cells, col, min_rows)
    return skew_join(cells, kept, [col], how="inner", spread_by=[row]).select(row, col, "mean")


def pivot_mean(
    df: DataFrame, row: str, col: str, value: str, values: Sequence, digits: int = 2, min_rows: int = 0,
) -> DataFrame:
    """Rounded means as a wide table with the given column values as columns (heat map).

    With ``min_rows``, only those of ``values`` that are filled in that many rows.
    ``mean_cells`` has the same in long form for column values that are not known.
    """
    cells = _all_cells(df, row, col, value, digits)
    if min_rows:
        # At most as many names as were given.
        filled = _filled_columns(cells.where(F.col(col).isin(list(values))), col, min_rows).collect()
        values = [v for v in values if v in {r[0] for r in filled}]
    wide = [F.max(F.when(F.col(col) == F.lit(v), F.col("mean"))).alias(str(v)) for v in values]
    return cells.groupBy(row).agg(*wide) if wide else cells.select(row).distinct()


def _range(df: DataFrame, col: str) -> DataFrame:
    """Lowest and highest value; a single value is widened by half a unit on each side."""
    v = F.col(col).cast("double")
    v = F.when(~F.isnan(v), v)
    return df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).select(
        F.when(F.col("lo") < F.col("hi"), F.col("lo")).otherwise(F.col("lo") - 0.5).alias("lo"),
        F.when(F.col("lo") < F.col("hi"), F.col("hi")).otherwise(F.col("hi") + 0.5).alias("hi"),
    )


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Rows per equal-width bin between the lowest and highest value, empty bins included."""
    limits = _range(df, col).select(F.struct("lo", "hi")).scalar()
    lo, hi = limits.getField("lo"), limits.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    v = F.col(col).cast("double")
    counts = (
        df.where(v.isNotNull() & ~F.isnan(v))
        .select(F.least(F.floor((v - lo) / width), F.lit(bins - 1)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("_n"))
    )
    edge = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        # At most one row per bin on both sides.
        edge.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin", (lo + F.col("bin") * width).alias("from"),
            F.when(F.col("bin") == bins - 1, hi).otherwise(lo + (F.col("bin") + 1) * width).alias("to"),
            F.coalesce("_n", F.lit(0)).alias("n"),
        )
    )


def marks(df: DataFrame, col: str, digits: int = 2) -> DataFrame:
    """One row: mean and exact median (the marks on a histogram)."""
    middle = quantiles(df, col, [0.5], names=["m"]).select("m").scalar()
    return df.agg(steady_round(F.avg(col), digits).alias("mean")).select(
        "mean", F.round(middle, digits).alias("median"))


# Beyond so many bandwidths a kernel is less than half the last digit of its peak.
KERNEL_REACH = 8.6


def density(df: DataFrame, col: str, points: int = 200) -> DataFrame:
    """Gaussian kernel density on an even grid from the lowest to the highest value.

    The bandwidth is ``n ** (-1/5)`` sample deviations. A value adds to the grid points
    within KERNEL_REACH bandwidths, fewer the more rows there are and however fine the
    grid, inside its task; one sum per task and grid point is shuffled and no value. The
    density is null where all values are the same.
    """
    v = F.col(f"`{col}`").cast("double")
    known = df.select(v.alias("_v")).where(F.col("_v").isNotNull() & ~F.isnan("_v"))
    stats = known.agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.stddev_samp("_v").alias("sd"),
        F.min("_v").alias("lo"), F.max("_v").alias("hi"),
    ).select("n", (F.pow("n", F.lit(-0.2)) * F.col("sd")).alias("bw"), "lo",
             ((F.col("hi") - F.col("lo")) / F.lit(float(points - 1))).alias("step"))
    s = stats.select(F.struct("n", "bw", "lo", "step")).scalar()
    n, bw, lo, step = (s.getField(f) for f in ("n", "bw", "lo", "step"))
    reach = KERNEL_REACH * bw
    first = F.greatest(F.ceil(F.try_divide(F.col("_v") - reach - lo, step)), F.lit(0)).cast("int")
    last = F.least(F.floor(F.try_divide(F.col("_v") + reach - lo, step)), F.lit(points - 1)).cast("int")
    # A value between two far points reaches neither.
    near = F.when((bw > 0) & (first <= last), F.sequence(first, last))
    z = F.try_divide(lo + F.col("point") * step - F.col("_v"), bw)
    sums = known.select("_v", F.explode(near).alias("point")).groupBy("point").agg(F.sum(F.exp(-0.5 * z * z)).alias("_k"))
    grid = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
    scale = n * bw * F.sqrt(F.lit(2.0) * F.pi())
    # At most one row per point on both sides.
    return grid.join(F.broadcast(sums), "point", "left").where(n > 0).select(
        "point", (lo + F.col("point") * step).alias("x"), F.try_divide(F.coalesce("_k", F.lit(0.0)), scale).alias("density"))


def ordered_counts(df: DataFrame, bucket: Column, order: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per bucket in the given order; buckets without rows are left out."""
    position = F.array_position(F.array(*[F.lit(o) for o in order]), F.col("bucket")).cast("int")
    return (
        df.select(bucket.alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))
        .withColumn("position", position).where(F.col("position") > 0)
        .select("position", "bucket", name).orderBy("position")
    )


def bars(df: DataFrame, col: str) -> DataFrame:
    """Rows per non-null value (bar chart)."""
    return count_by(df, col, skip_null=True)
