"""Columns out of nested records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flatten_details(
    df: DataFrame, payload: str, schema: T.StructType | str, paths: Mapping[str, str],
    default_id: tuple[str, str] | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """One flat row per nested record.

    ``payload`` is a struct column, or JSON text read with ``schema``. ``paths``
    maps output names to dotted paths; a path missing in a record gives null.
    ``default_id`` = (output name, source column) fills an absent id, and
    ``keep`` passes other columns on. Empty records (null, unreadable or without
    any field) are dropped.
    """
    is_json = isinstance(df.schema[payload].dataType, T.StringType)
    record = F.from_json(F.col(payload), schema) if is_json else F.col(payload)
    parsed = df.withColumn("_record", record)
    fields = parsed.schema["_record"].dataType.names
    filled = reduce(or_, [F.col(f"_record.`{f}`").isNotNull() for f in fields])
    flat = {name: F.col(f"_record.{path}") for name, path in paths.items()}
    if default_id:
        name, source = default_id
        flat[name] = F.coalesce(flat[name], F.col(source))
    return (
        parsed.where(F.col("_record").isNotNull() & filled)
        .select(*keep, *[c.alias(n) for n, c in flat.items()])
    )


def element_count(items: Column) -> Column:
    """Number of elements, 0 for a null array."""
    return F.coalesce(F.array_size(items), F.lit(0))


def joined_texts(items: Column, field: str, sep: str = " | ") -> Column:
    """One field of every element as one text; an element without it adds an empty text."""
    texts = F.transform(items, lambda x: F.coalesce(x[field], F.lit("")))
    return F.coalesce(F.array_join(texts, sep), F.lit(""))


def mean_of(items: Column, field: str, missing_as: float | None = None) -> Column:
    """Mean of one field over the elements; null without elements.

    A missing value is left out, or counts as ``missing_as`` if that is given.
    """
    values = F.transform(items, lambda x: x[field].cast("double"))
    values = F.transform(values, lambda v: F.coalesce(v, F.lit(float(missing_as)))) \
        if missing_as is not None else F.filter(values, lambda v: v.isNotNull())
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return F.when(F.array_size(values) > 0, total / F.array_size(values))


def joined_tags(tags: Column, sep: str = ", ") -> Column:
    """A list of tags as one text."""
    return F.coalesce(F.array_join(tags, sep), F.lit(""))


def rollup_nested(
    items: Column | str, text: str, score: str, sep: str = " | ", missing_as: float | None = None,
    names: tuple[str, str, str] = ("review_count", "review_texts", "avg_review_rating"),
) -> list[Column]:
    """Count, joined texts and mean score of a record's nested elements."""
    items = F.col(items) if isinstance(items, str) else items
    parts = element_count(items), joined_texts(items, text, sep), mean_of(items, score, missing_as)
    return [c.alias(n) for c, n in zip(parts, names, strict=True)]
