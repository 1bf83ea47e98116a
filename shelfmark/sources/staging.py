"""Where intermediate tables and checkpoints go.

A cluster names its shared folder in ``spark.checkpoint.dir``. Where that is
unset, the warehouse folder takes them: the session names it, and every executor
can reach it as well. What lies below the folder of a session is deleted when the
session's JVM ends.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can read and write."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def _session_dir(spark: SparkSession) -> str:
    """This session's own folder in the shared one; it goes when the JVM ends."""
    folder = f"{shared_dir(spark)}/shelfmark/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


# What the open scopes delete when they end, the innermost last.
_SCOPES: list[list[Callable[[], None]]] = []


def at_end(clean_up: Callable[[], None], level: int = -1) -> None:
    """Have something done when the scope around ends; without a scope nothing is."""
    if len(_SCOPES) >= -level:
        _SCOPES[level].append(clean_up)


@contextmanager
def scope() -> Iterator[None]:
    """Scratch tables written inside are deleted when it ends, also by an error; ``hand_out`` keeps one."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for clean_up in reversed(_SCOPES.pop()):
            clean_up()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Commands inside delete the files of their shuffles when they end, not when the driver collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def free_unreferenced(spark: SparkSession) -> None:
    """Have the files of RDDs that nobody refers to any more deleted now; Spark sees them when the driver collects garbage."""
    gc.collect()
    spark._jvm.System.gc()


def scratch_path(spark: SparkSession, name: str, level: int = -1) -> str:
    """A new path in the shared folder, used by nobody else; it goes with the scope around."""
    path = f"{_session_dir(spark)}/{name}-{uuid.uuid4().hex}"
    at_end(lambda: discard(spark, path), level)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete what was written at a scratch path and is no longer read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def stage(df: DataFrame, name: str, level: int = -1, codec: str | None = None) -> DataFrame:
    """Write a table once and go on from the written copy.

    Use it where a result is read several times or must not change between
    reads; a lost executor then costs a re-read and not a recomputation.
    Texts are worth the ``codec`` zstd; without one it is the session's.
    """
    path = scratch_path(df.sparkSession, name, level)
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hand_out(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write the result of a scope, to last as long as what is around that scope."""
    return stage(df, name, -2, codec)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative fits cut their lineage only if the context knows a folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(f"{_session_dir(spark)}/checkpoints")
