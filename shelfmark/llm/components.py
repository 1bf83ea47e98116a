"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.sources.staging import hand_out, scope, stage


def _same(one: DataFrame, other: DataFrame) -> bool:
    def digest(df):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    return tuple(digest(one)) == tuple(digest(other))


def components(links: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of ``links`` (a, b: long).

    Each round hangs every node's larger neighbours, then its smaller ones, under the
    smallest it knows; the number of rounds grows with the logarithm of the longest
    path. Tables of a round are written, so no lineage builds up and adaptive
    execution can split the rows of a hub.
    """
    edges = stage(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while not edges.isEmpty():
        with scope():
            both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
                edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
            least = stage(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
            large = stage(both.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), "large")
            down = stage(large.groupBy("a").agg(F.min("b").alias("m")), "down")
            small = large.join(down, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
                down.select("a", F.col("m").alias("b"))).distinct()
            after = hand_out(small, "links")
        same, edges = _same(edges, after), after
        if same:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
