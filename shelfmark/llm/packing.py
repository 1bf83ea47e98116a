"""Packing by deficit round-robin over source queues, in closed form.

Every source is a queue of its documents' tokens. In each round a queue earns its
share of a window; when what it has earned and not yet used reaches a unit of
tokens, that unit is served, and the rest is carried to the next round. The windows
are cut from the stream of all rounds, so each is full and holds the target mix to
within a unit per source.

What a queue has used after r rounds depends on r alone, so no task has to play the
rounds of another: given the tokens of its queue before it, a document finds the
rounds it is served in, the tokens that all queues have used by then, and so its
windows. A partition starts with the deficits that those before it have left.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.llm.bpe import codec
from shelfmark.llm.parts import small_batches, spans, texts_of, tidy
from shelfmark.llm.words import ragged
from shelfmark.sources.staging import scratch_path, stage

# Shares are held in millionths (a power of two of them), so that all of this fits 64 bits.
SHARE_BITS = 20
UNIT_BITS = 6


@dataclass(frozen=True)
class Schedule:
    """Which unit of which queue comes when. ``earned``: window size times share; ``total``: tokens per queue."""

    window: int
    earned: np.ndarray
    total: np.ndarray

    SHIFT = SHARE_BITS + UNIT_BITS

    @staticmethod
    def of(window: int, weights: list[float], totals: list[int]) -> Schedule:
        whole = sum(weights)
        shares = [max(1, round(w / whole * (1 << SHARE_BITS))) for w in weights]
        return Schedule(window, np.array([window * s for s in shares], np.int64), np.array(totals, np.int64))

    def round_of(self, queue: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """The round (from 1) in which the queue has earned its first ``unit + 1`` units."""
        e = self.earned[queue]
        a, b = np.divmod(unit + 1, e)
        return (a << self.SHIFT) - (-(b << self.SHIFT) // e)

    def used(self, rounds: np.ndarray) -> np.ndarray:
        """Tokens that each queue (columns) has used after each of ``rounds`` (rows)."""
        mask = (1 << self.SHIFT) - 1
        r = rounds[:, None]
        units = (r >> self.SHIFT) * self.earned + (((r & mask) * self.earned) >> self.SHIFT)
        return np.minimum(units << UNIT_BITS, self.total)

    def pieces(self, queue: np.ndarray, begin: np.ndarray, sizes: np.ndarray):
        """Documents at ``begin`` of their queues, cut into pieces: document, start, length, sequence, offset."""
        first, last = begin >> UNIT_BITS, (begin + sizes - 1) >> UNIT_BITS
        n = last - first + 1
        doc = np.repeat(np.arange(len(begin)), n)
        unit = ragged(np.arange(int(last.max()) - int(first.min()) + 1), first - first.min(), n) + first.min()
        rounds = self.round_of(queue[doc], unit)
        # Units of a document that are served in one round are one run.
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (rounds[1:] != rounds[:-1])
        at = np.flatnonzero(new)
        doc, rounds, unit = doc[at], rounds[at], unit[at]
        start = np.maximum(unit << UNIT_BITS, begin[doc])
        end = np.append(start[1:], 0)
        closes = np.append(doc[1:] != doc[:-1], True)
        end[closes] = (begin + sizes)[doc[closes]]
        # The stream is ordered by round, queue and place in the queue.
        each, back = np.unique(rounds, return_inverse=True)
        before, after = self.used(each - 1), self.used(each)
        own = queue[doc]
        within = np.cumsum(after - before, axis=1) - (after - before)
        rank = before.sum(axis=1)[back] + within[back, own] + start - before[back, own]
        # Cut where a window ends.
        spread = (rank + end - start - 1) // self.window - rank // self.window + 1
        again = np.repeat(np.arange(len(rank)), spread)
        step = np.arange(len(again)) - np.repeat(np.cumsum(spread) - spread, spread)
        sequence = rank[again] // self.window + step
        lo = np.maximum(rank[again], sequence * self.window)
        hi = np.minimum((rank + end - start)[again], (sequence + 1) * self.window)
        doc, start = doc[again], (start - begin[doc])[again] + lo - rank[again]
        # Neighbours in one window are one piece.
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (sequence[1:] != sequence[:-1]) | (lo[1:] != hi[:-1])
        at = np.flatnonzero(new)
        ends = np.append(at[1:] - 1, len(doc) - 1)
        return doc[at], start[at], (hi[ends] - lo[at]), sequence[at], (lo % self.window)[at]


@functools.lru_cache(maxsize=8)
def _width(path: str) -> str:
    return "<u2" if codec(path).size <= 1 << 16 else "<u4"


def _tokens(docs: DataFrame, path: str, end_id: int, doc_id: str, texts: str, source: str) -> DataFrame:
    """Each row's ids with the tokens of its source before it in its part, written once."""
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    id_type = docs.schema[doc_id].dataType.simpleString()
    key = F.when(F.col(f"`{source}`").isNull(), "").otherwise(F.concat(F.lit("="), F.col(f"`{source}`").cast("string")))

    def run(batches):
        own, width = codec(path), _width(path)
        part = TaskContext.get().partitionId()
        used: dict[str, int] = {}
        for batch in batches:
            column, sources = texts_of(batch.column(1)), batch.column(2).to_pylist()
            for i, j in spans(column):
                ids, at = own.encode(column.slice(i, j - i))
                sizes = np.diff(at) + 1
                full = np.full(len(ids) + j - i, end_id, width)
                ends = np.cumsum(sizes)
                keep = np.ones(len(full), bool)
                keep[ends - 1] = False
                full[keep] = ids
                before = np.empty(j - i, np.int64)
                for k, (s, n) in enumerate(zip(sources[i:j], sizes.tolist(), strict=True)):
                    before[k] = used.get(s, 0)
                    used[s] = int(before[k]) + n
                offsets = np.append(0, ends * full.itemsize).astype(np.int32)
                blob = pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(offsets), pa.py_buffer(full)])
                yield pa.record_batch({
                    "doc_id": batch.column(0).slice(i, j - i), "source": batch.column(2).slice(i, j - i),
                    "part": pa.array(np.full(j - i, part, np.int32)), "before": pa.array(before),
                    "n": pa.array(sizes, pa.int64()), "ids": blob})

    picked = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{texts}`").alias("text"), key.alias("source"))
    made = picked.mapInArrow(tidy(run), f"doc_id {id_type}, source string, part int, before long, n long, ids binary")
    at = scratch_path(spark, "tokens")
    made.write.option("compression", "zstd").parquet(at)
    return spark.read.schema(made.schema).parquet(at)


def pack(
    docs: DataFrame, path: str, window: int = 4096, end_id: int = 2, weights: dict[str | None, float] | None = None,
    max_queues: int = 256, doc_id: str = "doc_id", texts: str = "text", source: str = "source",
) -> DataFrame:
    """One row per piece: doc_id, source, start, length, ids, doc_tokens, sequence_id, offset.

    ``ids`` are little-endian unsigned 32-bit. ``weights`` sets the target mix per
    source (sources that are not named get their share of all tokens); without it
    every window mirrors the corpus. When a source runs out the others go on, so
    nothing is dropped. The ``max_queues - 1`` sources with most tokens and all that
    ``weights`` names have queues of their own. All others share one, so the schedule
    is of bounded size, and are mixed in it by their tokens, however many they are.

    Null texts are empty and consist of ``end_id`` alone; null is a source of its own;
    repeated rows are packed each; an empty table gives no piece. All sequences but
    the last are full.
    """
    tokens = _tokens(docs, path, end_id, doc_id, texts, source)
    loads = tokens.groupBy("part", "source").agg(F.sum("n").alias("n"))
    sums = loads.groupBy("source").agg(F.sum("n").alias("n"))
    largest = sums.orderBy(F.desc("n"), "source").limit(max_queues).collect()
    everything = tokens.agg(F.sum("n")).first()[0] or 0
    wanted = {"" if k is None else f"={k}": w for k, w in (weights or {}).items()}
    if len(largest) == max_queues:
        largest = largest[:max_queues - 1]
        given = sums.where(F.col("source").isin(list(wanted))).orderBy(F.desc("n"), "source").collect() if wanted else []
        largest += [r for r in given if r not in largest]
    named, totals = [r.source for r in largest], [r.n for r in largest]
    rest = everything - sum(totals)
    shares = [n / max(1, everything) for n in [*totals, rest]]
    mix = [*(wanted.get(s, share) for s, share in zip(named, shares[:-1], strict=True)), shares[-1]]
    schedule = Schedule.of(window, [max(m, 1e-9) for m in mix], [*totals, rest])

    numbers = F.create_map(*[F.lit(x) for i, s in enumerate(named) for x in (s, i)]) if named else None
    queue = F.element_at(numbers, F.col("source")) if named else F.lit(None).cast("int")
    # One row per source and part.
    by_source = Window.partitionBy("source")
    # Written, so that its size is known when the tokens are joined with it and need not be shuffled for it.
    starts = stage(loads.select(
        "part", "source", queue.alias("queue"), F.sum("n").over(by_source).alias("total"),
        (F.sum("n").over(by_source.orderBy("part")) - F.col("n")).alias("start")), "starts")
    width = _width(path)
    fields = "doc_id {}, source string, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"

    def cut(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            n = batch.column("n").to_numpy()
            for i, j in _chunks(n):
                yield _cut(batch.slice(i, j - i), schedule, width)

    placed = tokens.join(starts.where("queue is not null"), ["part", "source"]).select(
        "doc_id", "source", "n", "ids", "queue", (F.col("start") + F.col("before")).alias("begin"))
    fields = fields.format(docs.schema[doc_id].dataType.simpleString())
    packed = placed.mapInArrow(tidy(cut), fields)
    if rest:
        runs = _mixed(tokens.join(starts.where("queue is null"), ["part", "source"]), rest)
        shared = tokens.join(runs, ["part", "source", "before"]).select(
            "doc_id", "source", "n", "ids", F.lit(len(named)).alias("queue"), "runs")
        packed = packed.unionByName(shared.mapInArrow(tidy(cut), fields))
    return packed.withColumn("source", F.when(F.col("source") != "", F.expr("substring(source, 2)")))


def _mixed(tail: DataFrame, tokens: int) -> DataFrame:
    """part, source, before and ``runs`` (at, length, begin): where each document of ``tail`` lies in the shared queue.

    The units of a source have times spread evenly over 0 to 1, each source with an
    offset of its own, and the queue holds all units by time. So at any time every
    source has been given its share to within a unit, and no task needs all sources.
    """
    begin, one = F.col("start") + F.col("before"), 1 << UNIT_BITS
    units = F.floor((F.col("total") + (one - 1)) / one)
    offset = F.pmod(F.xxhash64("source"), F.lit(1 << 52)) / (1 << 52)
    lo = F.greatest(F.col("unit") * one, F.col("begin"))
    # A bucket of times has some million tokens, so that no task orders them all.
    buckets = max(1, tokens >> 22)
    each = tail.select("part", "source", "before", "n", begin.alias("begin"), units.alias("units"), F.explode(F.sequence(
        F.shiftright(begin, UNIT_BITS), F.shiftright(begin + F.col("n") - 1, UNIT_BITS))).alias("unit")).select(
        "part", "source", "before", (lo - F.col("begin")).alias("at"), lo.alias("lo"),
        (F.least((F.col("unit") + 1) * one, F.col("begin") + F.col("n")) - lo).alias("length"),
        ((F.col("unit") + offset) / F.col("units")).alias("time"))
    each = each.withColumn("bucket", F.least(F.floor(F.col("time") * buckets), F.lit(buckets - 1)))
    # One row per bucket in this window.
    bases = each.groupBy("bucket").agg(F.sum("length").alias("all")).select(
        "bucket", (F.sum("all").over(Window.orderBy("bucket")) - F.col("all")).alias("base"))
    ordered = Window.partitionBy("bucket").orderBy("time", "source", "lo").rowsBetween(Window.unboundedPreceding, -1)
    ranked = each.withColumn("within", F.coalesce(F.sum("length").over(ordered), F.lit(0))).join(bases, "bucket")
    return ranked.groupBy("part", "source", "before").agg(F.sort_array(F.collect_list(F.struct(
        "at", "length", (F.col("base") + F.col("within")).alias("begin")))).alias("runs"))


def _chunks(n: np.ndarray, limit: int = 1 << 21) -> list[tuple[int, int]]:
    cuts, done, total = [], 0, 0
    for i, k in enumerate(n.tolist()):
        if total and total + k > limit:
            cuts.append((done, i))
            done, total = i, 0
        total += k
    return [*cuts, (done, len(n))]


def _cut(batch: pa.RecordBatch, schedule: Schedule, width: str) -> pa.RecordBatch:
    sizes = batch.column("n").to_numpy()
    blob = batch.column("ids")
    offsets = np.frombuffer(blob.buffers()[1], np.int32)[blob.offset:blob.offset + len(blob) + 1]
    ids = np.frombuffer(blob.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(width).astype("<u4")
    queue = batch.column("queue").to_numpy().astype(np.int64)
    if "runs" in batch.schema.names:
        own, at, long, begin = _runs(batch.column("runs"))
        run, start, length, sequence, offset = schedule.pieces(queue[own], begin, long)
        doc, start = own[run], at[run] + start
    else:
        doc, start, length, sequence, offset = schedule.pieces(queue, batch.column("begin").to_numpy(), sizes)
    # Pieces of a document follow one another, so the ids are cut where they stand.
    ends = np.append(0, np.cumsum(length) * 4).astype(np.int32)
    return pa.record_batch({
        "doc_id": batch.column("doc_id").take(pa.array(doc)), "source": batch.column("source").take(pa.array(doc)),
        "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()),
        "ids": pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(ids)]),
        "doc_tokens": pa.array(sizes[doc], pa.int64()), "sequence_id": pa.array(sequence, pa.int64()),
        "offset": pa.array(offset, pa.int64())})


def _runs(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Document, place in it, length and place in the queue of each run; neighbours in both are one."""
    doc = np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
    at, length, begin = (x.to_numpy() for x in column.flatten().flatten())
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1] + length[:-1])
    first = np.flatnonzero(new)
    return doc[first], at[first], np.add.reduceat(length, first), begin[first]


def sequences(pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, ids (binary), and where the pieces begin."""
    rows = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(rows.alias("_p")).select(
        "sequence_id", F.expr("reduce(_p, X'', (a, p) -> concat(a, p.ids))").alias("ids"),
        F.col("_p.offset").alias("offsets"))
