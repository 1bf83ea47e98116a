"""The whole cleaning of a catalogue as one lazy plan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame

from shelfmark.operators.cleaning import dedup, impute
from shelfmark.operators.project import cast_columns, drop_all_null
from shelfmark.sources.staging import stage


@dataclass(frozen=True)
class CleanSpec:
    """What to clean and what to derive.

    ``derive`` holds groups of new columns; a group may use the columns of the
    groups before it.
    """

    keys: Sequence[str]
    order: Sequence[str] = ()
    keep: str = "last"
    need_any: Sequence[str] = ()
    fill: Mapping[str, Any] = field(default_factory=dict)
    derive: Sequence[Mapping[str, Column]] = ()
    types: Mapping[str, str] = field(default_factory=dict)


def clean_steps(df: DataFrame, spec: CleanSpec) -> list[tuple[str, DataFrame]]:
    """The table after each step that removes rows."""
    unique = dedup(df, spec.keys, spec.order, spec.keep)
    usable = drop_all_null(unique, spec.need_any) if spec.need_any else unique
    return [("input", df), ("dedup", unique), ("drop_all_null", usable)]


def clean(df: DataFrame, spec: CleanSpec, staged: bool = False) -> DataFrame:
    """Deduplicated, usable rows with nulls filled and columns derived.

    ``staged`` writes the deduplicated rows once, so that the fill statistics
    read single columns of that copy; otherwise they reuse its shuffle.
    """
    usable = clean_steps(df, spec)[-1][1]
    if staged:
        usable = stage(usable, "usable")
    out = impute(usable, spec.fill)
    for group in spec.derive:
        out = out.withColumns(dict(group))
    return cast_columns(out, spec.types)
