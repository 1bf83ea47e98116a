"""Writing tables, results and fitted models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Overwrite with headed CSV that ``read_csv`` reads back, line breaks and quotes included.

    ``single_file`` is meant for small results: one task then does the last stage.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite with Parquet, one file per task."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_snapshot(df: DataFrame, paths: Sequence[str]) -> None:
    """Overwrite the current table at every path; computed once, the rest are copies of the first."""
    first, *others = paths
    write_parquet(df, first)
    for path in others:
        write_parquet(df.sparkSession.read.schema(df.schema).parquet(first), path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Overwrite with nested JSON, one object per row; the one row of a summary is one file."""
    df.write.mode("overwrite").json(path)


def write_results(
    results: Mapping[str, DataFrame], folder: str, fmt: str = "csv", single_file: bool = False,
) -> None:
    """Each named result in its own subfolder; every result runs once."""
    for name, df in results.items():
        if fmt == "csv":
            write_csv(df, f"{folder}/{name}", single_file)
        else:
            write_parquet(df, f"{folder}/{name}")


def save_model(model, path: str) -> None:
    """Overwrite a fitted model's folder."""
    model.write().overwrite().save(path)
