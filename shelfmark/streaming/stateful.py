"""What a stream has to remember: each key's last window, each key's newest row."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from shelfmark.sources.commits import Commits
from shelfmark.sources.staging import discard, scratch_path
from shelfmark.streaming.history import latest_snapshot, stream_periods

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries that start inside keep their state in RocksDB, which ``stream_delta`` needs; the session's own choice comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


class _Change(StatefulProcessor):
    """Hands on each closed window of a key with the change since the one before, and remembers the last."""

    def __init__(self, values: dict[str, str], state: str, kinds: dict[str, str], columns: list[str]):
        self.values, self.state, self.kinds, self.columns = values, state, kinds, columns

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.state)

    def handleInputRows(self, key, rows, timers) -> Iterator[pd.DataFrame]:
        # The windows of one key that close in one batch; later batches only close later ones.
        new = pd.concat(list(rows)).sort_values("period_start", ignore_index=True)
        known = self.last.get() if self.last.exists() else (None,) * len(self.values)
        for (value, delta), before in zip(self.values.items(), known, strict=True):
            column = new[value].astype(self.kinds[value])
            shifted = column.shift(1)
            if before is not None:
                shifted.iloc[0] = before
            new[value], new[delta] = column, column - shifted
        last = new.iloc[-1]
        self.last.update(tuple(None if pd.isna(last[v]) else last[v].item() if hasattr(last[v], "item") else last[v] for v in self.values))
        yield new[self.columns]

    def close(self) -> None:
        pass


def stream_delta(
    stream: DataFrame, ts: str, period: str, delay: str, keys: Sequence[str] = (), value: str | None = None,
) -> DataFrame:
    """Rows (and the sum of a value) per closed window of a stream, with the change since the key's previous window.

    The change is null for a key's first window, and where one of both sums is null. A
    window is given once, when it is closed; rows that come later than ``delay`` are
    left out. The state holds one window per key, of which a key's task keeps as many
    at a time as one batch closes. Start the query inside ``rocksdb_state``.
    """
    closed = stream_periods(stream, ts, period, delay, keys, value)
    # One key for all windows; not a constant, which would be taken out of the plan.
    keyed = closed if keys else closed.withColumn("_all", F.col("n") * 0)
    values = {"n": "delta", **({"total": "total_delta"} if value else {})}
    fields = list(closed.schema.fields)
    kinds, state = {}, []
    for v, d in values.items():
        kind = keyed.schema[v].dataType
        if isinstance(kind, T.DecimalType):
            raise ValueError(f"sums of {kind.simpleString()} are not kept as state; cast {value} to double or bigint")
        kinds[v] = "Int64" if isinstance(kind, T.IntegralType) else "Float64"
        fields.append(T.StructField(d, kind))
        state.append(f"{v} {kind.simpleString()}")
    return keyed.groupBy(*(keys or ["_all"])).transformWithStateInPandas(
        _Change(values, ", ".join(state), kinds, [f.name for f in fields]), T.StructType(fields), "append", "None")


def upsert_latest(
    batch: DataFrame, path: str, keys: Sequence[str], ts: str, source: str, number: int, buckets: int = 64, keep: int = 2,
) -> bool:
    """Bring the newest row of every key of a batch into the snapshot at ``path``; False if this batch is in it already.

    The snapshot lies in buckets by key, and only buckets that the batch touches are
    written anew. Batches of a ``source`` are numbered; one that comes again changes
    nothing. The last ``keep`` states of the snapshot stay readable.
    """
    spark = batch.sparkSession
    log = Commits(spark, path)
    versions = log.names()
    said = (log.get(versions[-1]) if versions else None) or {"buckets": buckets, "folders": {}, "batches": {}}
    if said["batches"].get(source, -1) >= number:
        return False
    at = F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in keys]), F.lit(said["buckets"])).cast("int")
    fresh = scratch_path(spark, "batch")
    try:
        latest_snapshot(batch, keys, ts).withColumn("_bucket", at).write.parquet(fresh)
        new = spark.read.parquet(fresh)
        touched = [str(r[0]) for r in new.select("_bucket").distinct().collect()]  # at most ``buckets`` numbers
        # A snapshot that was read is one that somebody may still be reading, so its files stay.
        held = [said["folders"][b] for b in touched if b in said["folders"]]
        rows = new.drop("_bucket")
        if held:
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(*held))
        folder = log.new_folder("version")
        whole = latest_snapshot(rows, keys, ts).withColumn("_bucket", at)
        whole.repartition(max(1, len(touched)), "_bucket").write.partitionBy("_bucket").parquet(folder)
    finally:
        discard(spark, fresh)
    after = {
        "buckets": said["buckets"], "schema": batch.schema.jsonValue(), "batches": {**said["batches"], source: number},
        "folders": {**said["folders"], **{b: f"{folder}/_bucket={b}" for b in touched}}}
    version = int(versions[-1]) + 1 if versions else 0
    if not log.put(f"{version:012d}", after):
        log.drop_folder(folder)
        raise RuntimeError(f"somebody else wrote to {path} in the meantime")
    # What only states that are not kept refer to can go; the oldest state kept before is the last to let go of anything.
    kept = [after, *[log.get(v) or {"folders": {}} for v in versions[len(versions) - keep + 1:]]] if keep > 1 else [after]
    used = {f for state in kept for f in state["folders"].values()}
    gone = log.get(versions[-keep]) if len(versions) >= keep else None
    for f in set((gone or {"folders": {}})["folders"].values()) - used:
        log.drop_folder(f)
    return True


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot as its last finished batch left it."""
    log = Commits(spark, path)
    versions = log.names()
    if not versions:
        raise FileNotFoundError(f"no snapshot at {path}")
    said = log.get(versions[-1])
    schema = T.StructType.fromJson(said["schema"])
    folders = sorted(said["folders"].values())
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def stream_latest(
    stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], ts: str, source: str = "stream",
    every: str | None = None, buckets: int = 64,
) -> StreamingQuery:
    """Keep the snapshot at ``path`` at the newest row of every key, across restarts.

    A batch that is tried again after a failure is known by its number. Take another
    ``source`` name with another checkpoint. Takes what is available and ends; with
    ``every`` ("1 minute") it keeps running.
    """
    def bring(batch: DataFrame, number: int) -> None:
        upsert_latest(batch, path, keys, ts, source, number, buckets)

    writer = stream.writeStream.foreachBatch(bring).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
