"""A table of texts cut into parts that stay where they are.

Operators that look at every text more than once write it once, with a key per
row, bucketed by part. Later passes group by part without a shuffle, and what the
passes learn about a part comes back to it as a cogroup: keys and bitmaps travel,
texts do not.
"""

from __future__ import annotations

import ctypes
import inspect
import uuid
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from shelfmark.sources.staging import at_end, scratch_path

BATCH_BYTES = "8m"


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of BATCH_BYTES, unless the session names a size of its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and idle ones share the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(fn: Callable) -> Callable:
    """A function over a group that gives back what it used, or one over batches that does so at their end."""
    def over_batches(batches):
        yield from fn(batches)
        give_back()

    def over_group(table):
        out = fn(table)
        give_back()
        return out

    def over_pair(left, right):
        out = fn(left, right)
        give_back()
        return out

    if inspect.isgeneratorfunction(fn):
        return over_batches
    return over_pair if len(inspect.signature(fn).parameters) == 2 else over_group


class PartTable:
    """A written copy of ``df`` with ``row``, a key no two rows share, and ``part``.

    A part is what one task wrote, so its size is that of an input partition; with
    ``most`` (a power of two) it is a stretch of at most so many of the rows that a task
    wrote, however large the partitions are. The columns of ``df`` are written under
    numbers, so their names may be any.
    """

    def __init__(self, df: DataFrame, name: str, most: int | None = None):
        self.spark = df.sparkSession
        self.most = most
        small_batches(self.spark)
        self.name = f"llm_{name}_{uuid.uuid4().hex}"
        self.columns = df.columns
        self.kinds = [f.dataType for f in df.schema.fields]
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        # In the shared folder, and no longer there when the scope around ends, however it does.
        path = scratch_path(self.spark, name)
        at_end(self.drop)
        (
            df.toDF(*[f"c{i}" for i in range(len(self.columns))])
            .withColumn("row", F.monotonically_increasing_id())
            .withColumn("part", self.part_of("row"))
            .write.option("compression", "zstd").option("path", path).bucketBy(buckets, "part").saveAsTable(self.name)
        )
        self.rows = self.spark.table(self.name)

    def part_of(self, row: str) -> Column:
        """The part of the row with this key."""
        task = F.shiftright(row, 33)
        if self.most is None:
            return task.cast("int")
        stretch = F.shiftright(F.col(row).bitwiseAND(F.lit((1 << 33) - 1)), self.most.bit_length() - 1)
        # Beyond 2,048 stretches of a task two share a number and are one part.
        return F.pmod(task * 2048 + stretch, F.lit(1 << 31)).cast("int")

    def drop(self) -> None:
        """Take the copy out of the catalogue; its files go with the scope it was made in."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def kind(self, column: str) -> str:
        return self.kinds[self.columns.index(column)].simpleString()

    def pick(self, cols: list[str]) -> DataFrame:
        """row, part and the named columns."""
        return self.rows.select("row", "part", *[F.col(f"c{self.columns.index(c)}").alias(c) for c in cols])

    def each(self, cols: list[str], fn: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
        """``fn`` over each part, its rows in the order of their key."""
        return self.pick(cols).groupBy("part").applyInArrow(tidy(lambda part: fn(part.sort_by("row"))), schema)

    def each_with(
        self, cols: list[str], answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table], schema: str
    ) -> DataFrame:
        """``fn`` over each part and the rows of ``answers`` that name it in their column ``part``."""
        return self.pick(cols).groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
            tidy(lambda part, own: fn(part.sort_by("row"), own)), schema)

    def rewrite(self, answers: DataFrame, fn: Callable[[pa.Table, pa.Table], pa.Table]) -> DataFrame:
        """The table in the columns it came with, each part (under c0, c1, ...) as ``fn`` leaves it."""
        names = [f"c{i}" for i in range(len(self.columns))]
        schema = StructType([StructField(n, k) for n, k in zip(names, self.kinds, strict=True)])
        out = self.rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(
            tidy(lambda part, own: fn(part.sort_by("row"), own).select(names)), schema)
        return out.toDF(*self.columns)

    def keep(self, chosen: DataFrame) -> DataFrame:
        """The rows of the table whose key is among ``chosen``'s ``row``, in the columns they came with."""
        answers = chosen.select("row", self.part_of("row").alias("part"))
        return self.rewrite(answers, lambda part, own: part.filter(
            pc.is_in(part.column("row"), value_set=own.column("row").combine_chunks())))


def texts_of(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    """A text column as one array, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.cast(pa.string()).fill_null("")


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after the other, and where each begins and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(texts: pa.Array, limit: int = 1 << 20) -> list[tuple[int, int]]:
    """Runs [i, j) of texts with about ``limit`` bytes each; a longer text is a run of its own."""
    if not len(texts):
        return []
    sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts, done = [], 0
    while done < len(texts):
        base = sizes[done - 1] if done else 0
        end = max(done + 1, int(np.searchsorted(sizes, base + limit, side="right")))
        cuts.append((done, min(end, len(texts))))
        done = cuts[-1][1]
    return cuts


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())
