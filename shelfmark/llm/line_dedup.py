"""Boilerplate lines by their frequency within a site. DataFrame functions only.

A line is boilerplate of a host when more than a given share of the host's pages hold
it. Counts are of pages, not of occurrences, and are combined in the map tasks, so a
line on every page of a large host costs a task one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.staging import stage

RATIO = 0.1
# The least at which a line repeats at all: on a host of one page nothing is boilerplate.
MIN_PAGES = 2
BLOCKS = "p|div|li|ul|ol|h[1-6]|br|hr|tr|td|th|table|title|head|body|html|article|section|nav|header|footer|main|aside|pre|blockquote|form|option"


def host_of(url: Column) -> Column:
    """The host of an address in lower case, without user and port; '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def lines_of(html: Column) -> Column:
    """The visible lines of a page: scripts, styles, comments and inline tags go, blocks are lines, blanks are trimmed."""
    text = F.coalesce(html, F.lit(""))
    text = F.regexp_replace(text, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", " ")
    text = F.regexp_replace(text, rf"(?i)</?({BLOCKS})( [^>]*)?/?>", "\n")
    text = F.regexp_replace(text, r"<[^>]*>", "")
    lines = F.transform(F.split(text, r"[\n\r]"), lambda x: F.regexp_replace(x, r"^[ \t]+|[ \t]+$", ""))
    return F.filter(lines, lambda x: x != "")


def drop_boilerplate(
    pages: DataFrame, host: Column, lines: Column, ratio: float = RATIO, min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with host, lines (those that stay, in order), n_lines and n_dropped; columns of these names are replaced.

    A line goes when more than ``ratio`` of its host's pages hold it and at least
    ``min_pages`` do; all its occurrences on these pages go. Pages without host (null
    or '') stay whole. Null lines arrays are empty, null lines are not lines. Every
    row of ``pages`` is a page, repeated ones too; an empty table gives an empty one.
    """
    own = ("host", "lines", "n_lines", "n_dropped")
    kept = [c for c in pages.columns if c.lower() not in own]
    # Column names may clash with those used on the way, so the rest travels as one struct.
    clean = F.filter(F.coalesce(lines, F.array().cast("array<string>")), lambda x: x.isNotNull())
    cut = stage(pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), F.coalesce(host, F.lit("")).alias("host"),
        clean.alias("lines")).withColumn("row", F.monotonically_increasing_id()), "lines")
    # 128 bits stand for a line in the shuffles.
    coded = cut.where("host <> ''").select("row", "host", F.transform("lines", lambda x: F.unhex(F.md5(x))).alias("codes"))
    often = stage(
        coded.select("host", F.explode(F.array_distinct("codes")).alias("code"))
        .groupBy("host", "code").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages), "often")
    totals = stage(coded.groupBy("host").agg(F.count(F.lit(1)).alias("pages")), "hosts")
    # Both sides are read from tables, so adaptive execution can split a large host or line.
    boilerplate = stage(
        often.join(totals, "host").where(F.col("n") > F.lit(ratio) * F.col("pages")).select("host", "code"), "boilerplate")
    hits = (
        coded.select("row", "host", F.posexplode("codes").alias("at", "code")).join(boilerplate, ["host", "code"])
        .groupBy("row").agg(F.collect_list("at").alias("gone"))
    )
    gone = F.coalesce("gone", F.array().cast("array<int>"))
    places = F.when(F.size("lines") > 0, F.sequence(F.lit(0), F.size("lines") - 1)).otherwise(F.array().cast("array<int>"))
    left = F.array_sort(F.array_except(places, gone))
    return cut.join(hits, "row", "left").select(
        "page.*", "host", F.transform(left, lambda i: F.col("lines")[i]).alias("lines"),
        F.size("lines").alias("n_lines"), F.size(gone).alias("n_dropped"))
