"""Joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key is cut into parts of about this share of all rows. At most 1/PART_SHARE
# keys can be that frequent, and they are cut into at most 2/PART_SHARE parts.
PART_SHARE = 1e-4
# Keys are counted on this share of the rows ...
SAMPLE_SHARE = 1 / 64
# ... and one seen less often than this is no burden for a task.
SAMPLE_MIN = 500


def orderable(df: DataFrame) -> list[str]:
    """Columns whose type Spark can compare (no maps, variants or ML vectors)."""
    return [f.name for f in df.schema.fields
            if not isinstance(f.dataType, (T.MapType, T.VariantType, T.UserDefinedType))]


def _code(on: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c in on])


def hot_keys(
    df: DataFrame, on: Sequence[str], part_share: float = PART_SHARE, sample_share: float = SAMPLE_SHARE,
    sample_min: int = SAMPLE_MIN,
) -> Column:
    """Hashes of the frequent keys with the number of parts to cut each into.

    One array of at most ``1 / part_share`` entries, as a scalar subquery: it runs
    once per query, so all who use it see the same keys. The sample only decides
    which keys are cut, never which rows are kept.
    """
    keys = df.select(_code(on).alias("code")).sample(sample_share, seed=11)
    counts = keys.groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    frequent = counts.where((F.col("n") >= sample_min) & (F.col("n") >= F.lit(part_share) * total))
    parts = F.ceil(F.col("n") / (F.lit(part_share) * total)).cast("int")
    return frequent.agg(F.collect_list(F.struct("code", parts.alias("parts")))).scalar()


def skew_join(
    facts: DataFrame, other: DataFrame, on: Sequence[str], how: str = "left",
    spread_by: Sequence[str] | None = None, counted: DataFrame | None = None,
    part_share: float = PART_SHARE, sample_share: float = SAMPLE_SHARE, sample_min: int = SAMPLE_MIN,
) -> DataFrame:
    """Equi-join where a key of ``facts`` may be very frequent.

    Rows of a hot key are spread over parts by a hash of ``spread_by`` (all other
    columns if absent), and the rows of ``other`` for that key are repeated per
    part; all other keys join as usual. (Rows that are nothing but their key
    cannot be spread; count them first.) Rows with a null key match nothing and
    are spread as well. ``how`` is "inner" or "left". If ``facts`` is costly to
    compute, name a cheaper table with the same keys as ``counted``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"skew_join does inner and left joins, not {how!r}")
    on = list(on)
    for c in on:
        if facts.schema[c].dataType != other.schema[c].dataType:
            raise ValueError(f"{c} has different types on both sides; cast one")
    spread_by = list(spread_by) if spread_by else [c for c in orderable(facts) if c not in on] or on
    codes = hot_keys(facts if counted is None else counted, on, part_share, sample_share, sample_min)
    # Rebuilt from the array on both sides; its size is bounded, see hot_keys.
    hot = F.broadcast(
        facts.sparkSession.range(1).select(F.inline(codes)).toDF("_hot_code", "_hot_parts"))
    # A hash and not a random number: a task that runs again repeats its choice.
    spot = F.pmod(F.xxhash64(F.lit(11), *[F.col(f"`{c}`") for c in spread_by]), F.col("_hot_parts")).cast("int")
    chosen = F.when(F.col("_hot_parts").isNotNull(), spot).otherwise(0)
    spread = (
        facts.withColumn("_hot_code", _code(on)).join(hot, "_hot_code", "left")
        .withColumn("_hot_part", chosen).drop("_hot_code", "_hot_parts")
    )
    repeated = (
        other.withColumn("_hot_code", _code(on)).join(hot, "_hot_code", "left")
        .withColumn("_hot_part", F.explode(F.sequence(F.lit(0), F.coalesce("_hot_parts", F.lit(1)) - 1)))
        .drop("_hot_code", "_hot_parts")
    )
    return spread.join(repeated, [*on, "_hot_part"], how).drop("_hot_part")
