"""An append-only history of collection runs, in batch and as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shelfmark.operators.cleaning import dedup

DAY = "collected_day"
# Windows that one task compares with each other, per key.
STRETCH = 1000


def append_history(df: DataFrame, path: str, ts: str = "collected_at") -> None:
    """Add a run's rows to the history, by day; nothing that is there changes."""
    # Joins the rows of a small day and splits those of a large one, so files grow with rows and not with tasks.
    by_day = df.withColumn(DAY, F.to_date(ts)).hint("rebalance", DAY)
    by_day.write.mode("append").partitionBy(DAY).parquet(path)


def read_history(spark: SparkSession, path: str, since: str | None = None) -> DataFrame:
    """The history; ``since`` (a date) reads only the folders from that day on."""
    df = spark.read.parquet(path)
    return df.where(F.col(DAY) >= F.lit(since).cast("date")) if since else df


def latest_snapshot(history: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The newest row of every key."""
    return dedup(history, keys, [ts], keep="last")


def period_counts(df: DataFrame, ts: str, period: str, keys: Sequence[str] = (), value: str | None = None) -> DataFrame:
    """Rows (and the sum of a value) per time window and key; works on streams too."""
    aggs = [F.count(F.lit(1)).alias("n")]
    if value:
        aggs.append(F.sum(value).alias("total"))
    return (
        df.groupBy(F.window(ts, period).alias("_w"), *keys).agg(*aggs)
        .select(F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"), *keys,
                *(["n", "total"] if value else ["n"]))
    )


def period_delta(
    df: DataFrame, ts: str, period: str, keys: Sequence[str] = (), value: str | None = None,
) -> DataFrame:
    """Rows per time window and the change since the key's previous window (null for its first)."""
    counts = period_counts(df, ts, period, keys, value)
    values = {"n": "delta", **({"total": "total_delta"} if value else {})}
    # Stretches of STRETCH windows are looked at apart from each other.
    seconds = F.unix_seconds(F.col("period_start").cast("timestamp"))
    length = F.unix_seconds(F.col("period_end").cast("timestamp")) - seconds
    counts = counts.withColumn("_stretch", F.floor(seconds / (length * STRETCH)))
    within = Window.partitionBy(*keys, "_stretch").orderBy("period_start")
    # The border between two stretches needs the last window of the one before: a row per stretch and key.
    last = counts.groupBy(*keys, "_stretch").agg(*[
        F.max_by(v, "period_start").alias(f"_{v}") for v in values])
    across = Window.partitionBy(*keys).orderBy("_stretch")
    border = last.select(*keys, "_stretch", *[F.lag(f"_{v}").over(across).alias(f"_{v}") for v in values])
    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"b.{k}")) for k in [*keys, "_stretch"]]
    # A sum may be null, so a stretch's first window is known by its place and not by a lag without value.
    placed = counts.withColumns({"_place": F.row_number().over(within), **{f"_in_{v}": F.lag(v).over(within) for v in values}})
    out = placed.alias("c").join(border.alias("b"), same, "left")
    return out.select(*[f"c.{c}" for c in counts.columns if c != "_stretch"], *[
        (F.col(v) - F.when(F.col("_place") == 1, F.col(f"_{v}")).otherwise(F.col(f"_in_{v}"))).alias(d)
        for v, d in values.items()])


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, files: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """A stream of the Parquet files that are in a folder or arrive there.

    ``files_per_batch`` cuts a large backlog into several batches.
    """
    reader = spark.readStream.schema(schema).option("pathGlobFilter", files)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def with_watermark(stream: DataFrame, ts: str, delay: str) -> DataFrame:
    """Event time as a zoned timestamp with a limit on lateness."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)


def stream_periods(
    stream: DataFrame, ts: str, period: str, delay: str, keys: Sequence[str] = (), value: str | None = None,
) -> DataFrame:
    """Counts per closed time window of a stream; windows that are still open at its end are not given."""
    return period_counts(with_watermark(stream, ts, delay), ts, period, keys, value)


def stream_dedup(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One row per key as long as its repeats come within the delay; state older than it is dropped."""
    return with_watermark(stream, ts, delay).dropDuplicatesWithinWatermark(list(keys))


def append_stream(
    stream: DataFrame, path: str, checkpoint: str, day_of: str | None = None, name: str | None = None,
    every: str | None = None, files_per_day: int = 4,
) -> StreamingQuery:
    """Append a stream to a Parquet history, exactly once across restarts.

    Takes what is available and ends; with ``every`` ("1 minute") it keeps running.
    """
    if day_of:
        # A few files per day and batch, whatever the number of tasks.
        stream = stream.withColumn(DAY, F.to_date(day_of))
        stream = stream.repartition(DAY, F.pmod(F.xxhash64(*stream.columns), F.lit(files_per_day)))
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    writer = writer.partitionBy(DAY) if day_of else writer
    writer = writer.queryName(name) if name else writer
    return writer.start()
