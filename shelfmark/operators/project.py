"""Choosing, casting and filtering columns and rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WHOLE = {"tinyint", "smallint", "int", "integer", "bigint", "long", "short", "byte"}


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The listed columns that the table has, in list order."""
    return df.select(*[c for c in cols if c in df.columns])


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Without the rows in which all of ``cols`` are null."""
    return df.dropna(how="all", subset=list(cols))


def try_cast(col: Column | str, to: str) -> Column:
    """Cast that gives null for what does not fit. "2.0" is a whole number too."""
    col = F.col(col) if isinstance(col, str) else col
    if to.lower() in _WHOLE:
        return F.coalesce(col.try_cast(to), col.try_cast("double").try_cast(to))
    return col.try_cast(to)


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``try_cast`` of the listed columns that the table has."""
    return df.withColumns({c: try_cast(F.col(f"`{c}`"), t) for c, t in types.items() if c in df.columns})


def with_audit(df: DataFrame, collected_at: datetime | str, name: str = "collected_at") -> DataFrame:
    """Every row stamped with the time of its collection run."""
    return df.withColumn(name, F.lit(collected_at).cast("timestamp"))
