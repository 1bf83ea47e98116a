"""Tables that lie in buckets by key, so that joins on it move no row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from shelfmark.sources.staging import freed_shuffles


def write_bucketed(df: DataFrame, name: str, by: str | Sequence[str], buckets: int, path: str | None = None) -> DataFrame:
    """Replace the catalogue table ``name`` by ``df`` in so many buckets, sorted within each; the table as written.

    Rows go to their bucket's task first, so there is one file per bucket. Two tables of
    as many buckets of the same key join without an exchange. Bound a bucket's size by
    their number; a key that holds a large part of all rows should not be one to bucket by.
    """
    keys = [by] if isinstance(by, str) else list(by)
    spark = df.sparkSession
    writer = df.repartition(buckets, *[f"`{k}`" for k in keys]).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    with freed_shuffles(spark):
        writer.saveAsTable(name)
    return spark.table(name)
