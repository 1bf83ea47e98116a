"""Labels as numbers 0, 1, ...: frequent ones first, ties by label, however many there are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.operators.joins import skew_join
from shelfmark.sources.staging import stage


def in_sorted_order(df: DataFrame, order: Sequence[Column], out: str) -> DataFrame:
    """The table with each row's place 0, 1, ... in a total order.

    Numbers any amount of rows without a single-task window: they are sorted across
    tasks, numbered within each, and shifted by the sizes of the tasks before. The
    sorted table is staged so that its numbers stay fixed.
    """
    placed = df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    # The upper bits are the task, the lower 33 the position in it.
    fixed = stage(placed, "sorted").withColumn("_task", F.shiftright("_id", 33))
    sizes = fixed.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    # One row per sort task, so this window stays small.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return fixed.join(F.broadcast(starts), "_task").select(
        *[F.col(f"`{c}`") for c in df.columns], (F.col("_start") + position).alias(out))


def label_codes(df: DataFrame, col: str, code: str = "code") -> DataFrame:
    """Every non-null label with its row count and code 0, 1, ...: frequent labels first, ties by label."""
    counts = (
        df.where(F.col(f"`{col}`").isNotNull())
        .groupBy(F.col(f"`{col}`").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    )
    return in_sorted_order(counts, [F.col("n").desc(), F.col("label")], code)


def index_labels(
    df: DataFrame, col: str, out: str, codes: DataFrame | None = None, as_type: str = "bigint",
    counted: DataFrame | None = None,
) -> DataFrame:
    """The table with its labels' codes; null and unknown labels get the code after the last.

    ``counted`` as in ``skew_join``.
    """
    codes = codes if codes is not None else label_codes(df if counted is None else counted, col)
    unknown = codes.agg(F.coalesce(F.max("code") + 1, F.lit(0))).scalar()
    lookup = codes.select(F.col("label").alias(col), F.col("code").alias("_code"))
    joined = skew_join(df, lookup, [col], how="left", counted=counted)
    return joined.select(*[f"`{c}`" for c in df.columns], F.coalesce("_code", unknown).cast(as_type).alias(out))


def label_tables(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, label, n, code): the ``label_codes`` of several columns as text, counted in one pass and written."""
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label")) for c in cols])))
    counts = long.where("label is not null").groupBy("column", "label").agg(F.count(F.lit(1)).alias("n"))
    placed = in_sorted_order(counts, [F.col("column"), F.col("n").desc(), F.col("label")], "_place")
    # One row per column.
    first = placed.groupBy("column").agg(F.min("_place").alias("_first"))
    codes = placed.join(F.broadcast(first), "column")
    return stage(codes.select("column", "label", "n", (F.col("_place") - F.col("_first")).alias("code")), "codes")


def with_codes(df: DataFrame, labels: Mapping[str, str], tables: DataFrame, as_type: str = "bigint") -> DataFrame:
    """The table with the codes of several label columns, looked up in ``label_tables``.

    ``labels`` maps columns to names for their codes; null and unknown labels get the
    code after the last. The tables are written ones, so a small one is broadcast by
    its size, and for a large one adaptive execution splits the rows of a hot label.
    """
    out = df
    for c, name in labels.items():
        own = tables.where(F.col("column") == c)
        unknown = own.agg(F.coalesce(F.max("code") + 1, F.lit(0))).scalar()
        lookup = own.select(F.col("label").alias("_label"), F.col("code").alias("_code"))
        joined = out.join(lookup, F.col(f"`{c}`").cast("string") == F.col("_label"), "left")
        out = joined.select(*[F.col(f"`{x}`") for x in out.columns], F.coalesce("_code", unknown).cast(as_type).alias(name))
    return out
