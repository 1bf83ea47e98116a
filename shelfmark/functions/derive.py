"""Derived columns: every function takes columns and returns one column."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_code(
    text: Column | str, name: str, fallback: str | None = None,
    gap: str = r"\s*", digits: str = r"\d{1,2}", zeros: str = "0?", label: str | None = None,
) -> Column:
    """"<label> <number>" for the first ``name`` + number in free text, else ``fallback``.

    Case does not matter; ``zeros`` is what is stripped from the number's left
    (one zero by default, ``0*`` for all), always leaving a digit.
    """
    number = F.regexp_extract(_col(text), f"(?i){re.escape(name)}{gap}({digits})", 1)
    shown = F.concat(F.lit(f"{label or name} "), F.regexp_replace(number, rf"^{zeros}(\d+)$", "$1"))
    return F.when(number != "", shown).otherwise(F.lit(fallback or name))


def primary_tag(
    tags: Column | str, default: str, stop: Sequence[str] = (), sep: str = ",",
) -> Column:
    """First tag of a separated list that is not in ``stop``; ``default`` if none is left."""
    tags = _col(tags)
    if sep.strip(" "):
        # Blanks around tags go with the separators, which needs no function per element.
        parts = F.split(F.trim(tags), f" *{re.escape(sep)} *")
    else:
        parts = F.split(tags, re.escape(sep))
    left = F.array_except(parts, F.array(*[F.lit(s) for s in stop]).cast("array<string>"))
    return F.when(F.size(left) > 0, F.get(left, F.lit(0))).otherwise(F.lit(default))


def map_values(value: Column | str, mapping: Mapping, other: str | None = None) -> Column:
    """Exact lookup in a small dict; anything else, null included, becomes ``other``.

    For a mapping that is a table, use ``operators.joins.skew_join``.
    """
    value = _col(value)
    chain = None
    for key, result in mapping.items():
        chain = (F if chain is None else chain).when(value == F.lit(key), F.lit(result))
    return F.lit(other) if chain is None else chain.otherwise(F.lit(other))


def ordinal_label(level: Column | str, labels: Mapping[int, str], unknown: str = "Unknown") -> Column:
    """Name of an integer level."""
    return map_values(level, labels, unknown)


def bucketize(
    value: Column | str, edges: Sequence[float], labels: Sequence[str],
    closed_last: bool = True, clip: bool = False, unknown: str = "Unknown",
) -> Column:
    """Label of the half-open interval ``[edge, next edge)`` holding the value.

    ``closed_last`` also takes the last edge itself. Null, NaN and values outside
    the edges are ``unknown``; with ``clip`` values outside go to the end buckets.
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("one more edge than labels is needed")
    value = _col(value)
    number = value.cast("double")
    chain = F.when(value.isNull() | F.isnan(number), F.lit(unknown))
    last = len(labels) - 1
    for i, label in enumerate(labels):
        above = F.lit(True) if clip and i == 0 else number >= F.lit(float(edges[i]))
        if i < last:
            below = number < F.lit(float(edges[i + 1]))
        elif clip:
            below = F.lit(True)
        else:
            top = F.lit(float(edges[-1]))
            below = number <= top if closed_last else number < top
        chain = chain.when(above & below, F.lit(label))
    return chain.otherwise(F.lit(unknown))


def popularity(count: Column | str, score: Column | str, digits: int = 4) -> Column:
    """``log1p(count) * score``; null if either is null."""
    return F.round(F.log1p(_col(count).cast("double")) * _col(score), digits)


def md5_number(text: Column, hex_digits: int = 8) -> Column:
    """The first hex digits of a text's md5 as a number: the same on every run and engine."""
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def load_score(
    key: Column | str, count: Column | str, ts: Column | str, hour_weights: Sequence[float],
    hex_digits: int = 8, spread: int = 15, centre: int = 7, per: float = 100.0, digits: int = 1,
    full_at: int = 5000, count_share: float = 0.6,
) -> Column:
    """0..100 load estimate from a count, the hour of ``ts`` and a fixed offset per key.

    ``count_share`` weighs the log-scaled count (full at ``full_at``), the rest the
    hour's weight; the offset is ``(md5 number % spread - centre) / per``.
    """
    filled = F.coalesce(_col(count).cast("double"), F.lit(0.0))
    by_count = F.least(F.log1p(filled) / F.log1p(F.lit(float(full_at))), F.lit(1.0))
    by_hour = F.element_at(F.array(*[F.lit(float(w)) for w in hour_weights]), F.hour(_col(ts)) + 1)
    offset = (md5_number(_col(key).cast("string"), hex_digits) % spread - centre) / F.lit(float(per))
    raw = F.lit(count_share) * by_count + F.lit(1.0 - count_share) * by_hour + offset
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(100.0), raw * 100.0)), digits)


def surrogate_key(cols: Sequence[Column | str], prefix: str = "", length: int = 20, sep: str = "-") -> Column:
    """``prefix`` + the first upper-case md5 digits of the joined columns."""
    joined = F.concat_ws(sep, *[_col(c).cast("string") for c in cols])
    return F.concat(F.lit(prefix), F.upper(F.substring(F.md5(joined), 1, length)))


def assign_bucket(key: Column | str, buckets: int) -> Column:
    """Number 1..buckets of a key, whatever the partitioning."""
    return (F.pmod(md5_number(_col(key).cast("string")), F.lit(buckets)) + 1).cast("int")


def in_unit(value: Column | str, low: float, high: float) -> Column:
    """A value of a known range as 0..1."""
    return (_col(value) - F.lit(float(low))) / F.lit(float(high - low))


def rescale_to_int(unit: Column | str, low: int = 1, high: int = 5) -> Column:
    """A 0..1 value as an integer on ``low..high``, rounded half up and clamped."""
    unit = _col(unit)
    scaled = F.round(unit * F.lit(float(high - low)) + F.lit(float(low)), 0).cast("int")
    return F.when(unit.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), scaled)))


def vector_element(vector: Column | str, index: int) -> Column:
    """One number out of an ML vector."""
    return F.get(vector_to_array(_col(vector)), F.lit(index))


def steady_round(value: Column, digits: int, spare: int = 6) -> Column:
    """Half-up rounding of a mean or ratio that does not depend on the order of summing.

    Sums of doubles differ in their last bits from run to run, which would tip
    exact halves either way; those bits are rounded off first.
    """
    return F.round(F.round(value, digits + spare), digits)


def rounded(cols: Mapping[str, int]) -> dict[str, Column]:
    """Columns rounded half up, for ``withColumns``."""
    return {c: F.round(F.col(c), n) for c, n in cols.items()}
