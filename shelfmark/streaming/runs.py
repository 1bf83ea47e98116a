"""A history of named runs, of which each counts once however often it is tried."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.sources.commits import Commits
from shelfmark.streaming.history import DAY


def append_run(df: DataFrame, path: str, run: str, ts: str = "collected_at") -> bool:
    """Add a run's rows to the history, by day; False, and nothing changes, if the run is in it already.

    A run that failed half-way is not read and may be repeated under its name.
    """
    log = Commits(df.sparkSession, path)
    if log.get(run) is not None:
        return False
    folder = log.new_folder("attempt")
    # As in a plain history, files grow with rows and not with tasks.
    df.withColumn(DAY, F.to_date(ts)).hint("rebalance", DAY).write.partitionBy(DAY).parquet(folder)
    if log.put(run, {"folder": folder, "schema": df.schema.jsonValue()}):
        return True
    log.drop_folder(folder)
    return False


def runs_of(spark: SparkSession, path: str) -> list[str]:
    """The names of the runs that are in the history."""
    return Commits(spark, path).names()


def read_runs(spark: SparkSession, path: str, since: str | None = None, runs: list[str] | None = None) -> DataFrame:
    """The rows of all runs in the history, or of some; ``since`` (a date) reads only the folders from that day on.

    Columns are those of all runs together, null where a run has none.
    """
    log = Commits(spark, path)
    said = [s for run in (log.names() if runs is None else runs) if (s := log.get(run)) is not None]
    if not said:
        raise FileNotFoundError(f"no finished run at {path}")
    fields: dict[str, T.StructField] = {}
    for one in said:
        for field in T.StructType.fromJson(one["schema"]).fields:
            fields.setdefault(field.name, T.StructField(field.name, field.dataType))
    schema = T.StructType([*fields.values(), T.StructField(DAY, T.DateType())])
    df = spark.read.option("basePath", log.path).schema(schema).parquet(*[s["folder"] for s in said]).drop("attempt")
    return df.where(F.col(DAY) >= F.lit(since).cast("date")) if since else df
