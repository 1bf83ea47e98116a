"""Exact top-k by inner product over a pivot-distance index.

All vectors are lifted by one coordinate so that they have the same length; then the
largest inner products are the smallest distances. Each vector is keyed by its
nearest pivot and its distance to it, and sorted by that key, so a run of neighbours
is an annulus around a pivot. The triangle inequality bounds the distance of a query
to all that lies in an annulus. A query goes from annulus to annulus by that bound
and stops when it exceeds what its k-th best result allows.

Queries and vectors meet in blocks: every block of queries with every block of the
index, each of bounded size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.sources.staging import stage

PIVOTS = 32
SAMPLE = 2048
ANNULUS = 256
BLOCK = 1 << 14
QUERY_BLOCK = 1 << 12


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, width).astype(np.float64)


def whole_vectors(df: DataFrame, vec_id: str, vector: str, scale: int) -> DataFrame:
    """vec_id, width, v (components floor(scale * x) as little-endian 64-bit), norm2 of usable vectors."""
    x = F.col(f"`{vector}`")
    usable = x.isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    id_type = df.schema[vec_id].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            flat = np.floor(scale * lists.flatten().to_numpy().astype(np.float64))
            if len(flat) and np.abs(flat).max() >= 1 << 31:
                raise ValueError("a component is too large for whole-number products of 64 bits")
            sizes = np.diff(lists.offsets.to_numpy())
            ends = np.cumsum(sizes)
            squares = [float((flat[e - n:e] ** 2).sum()) for e, n in zip(ends, sizes, strict=True)]
            raw = flat.astype("<i8").tobytes()
            yield pa.record_batch({
                "vec_id": batch.column(0), "width": pa.array(sizes, pa.int32()),
                "v": pa.array([raw[8 * (e - n):8 * e] for e, n in zip(ends, sizes, strict=True)], pa.binary()),
                "norm2": pa.array(squares, pa.float64())})

    kept = df.where(usable).select(F.col(f"`{vec_id}`").alias("vec_id"), x.cast("array<double>").alias("x"))
    return kept.mapInArrow(run, f"vec_id {id_type}, width int, v binary, norm2 double")


def _pivots(rows: list, width: int, top: float) -> np.ndarray:
    """Up to PIVOTS lifted vectors far from one another: each next one is the farthest from those before."""
    lifted = _lift(np.stack([np.frombuffer(r.v, "<i8") for r in rows]).astype(np.float64), top)
    chosen = [0]
    far = ((lifted - lifted[0]) ** 2).sum(axis=1)
    while len(chosen) < min(PIVOTS, len(lifted)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
    return lifted[chosen]


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(0.0, top - (x * x).sum(axis=1)))[:, None]])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    d2 = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(0.0, d2))


def _products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: as doubles while 53 bits hold them, else as 64-bit integers."""
    most = (np.abs(q).max() * np.abs(x).max()) * q.shape[1]
    if most < 2.0 ** 53:
        return (q @ x.T).astype(np.int64)
    if most >= 2.0 ** 63:
        raise ValueError("inner products exceed 64 bits")
    return q.astype(np.int64) @ x.astype(np.int64).T


class _Best:
    """The k best (score, then smaller id) of each query, as found so far."""

    def __init__(self, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()
        n = len(floor)
        self.query, self.score, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.n = n

    def offer(self, query: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        query = np.concatenate([self.query, query])
        score = np.concatenate([self.score, score])
        ids = np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -score, query))
        query, score, ids = query[order], score[order], ids[order]
        first = np.searchsorted(query, np.arange(self.n))
        rank = np.arange(len(query)) - first[query]
        top = rank < self.k
        self.query, self.score, self.ids = query[top], score[top], ids[top]
        full = np.flatnonzero(rank == self.k - 1)
        self.floor[query[full]] = np.maximum(self.floor[query[full]], score[full])


def search_block(ids, x, pivot, distance, qids, q, floor, pivots, top: float, k: int):
    """The k best of one block of the index for each query: query, vec_id, score.

    ``floor`` is a score that the k-th best is known to reach (any lower one is
    dropped, equal ones stay). Rows are sorted by pivot and distance.
    """
    edges = np.flatnonzero(np.append(True, pivot[1:] != pivot[:-1]))
    cuts = np.unique(np.concatenate([edges, np.concatenate(
        [np.arange(a, b, ANNULUS) for a, b in zip(edges, np.append(edges[1:], len(pivot)), strict=True)]), [len(pivot)]]))
    lo, hi = cuts[:-1], cuts[1:]
    to_pivot = _distances(np.hstack([q, np.zeros((len(q), 1))]), pivots)[:, pivot[lo]]
    bound = np.maximum(0.0, np.maximum(distance[lo] - to_pivot, to_pivot - distance[hi - 1]))
    order = np.argsort(bound, axis=1, kind="stable")
    best = _Best(k, floor)
    lengths = (q * q).sum(axis=1) + top
    alive = np.arange(len(q))
    for step in range(len(lo)):
        # Beyond this distance a score is below the floor; the slack is far above the rounding of doubles.
        reach = np.sqrt(np.maximum(0.0, lengths[alive] - 2.0 * best.floor[alive]))
        nearest = order[alive, step]
        alive = alive[bound[alive, nearest] <= reach * (1 + 1e-9) + 1e-6 * np.sqrt(top + 1)]
        if not len(alive):
            break
        nearest = order[alive, step]
        found = []
        for a in np.unique(nearest):
            own = alive[nearest == a]
            score = _products(q[own], x[lo[a]:hi[a]])
            keep = (score >= best.floor[own][:, None]) & (ids[lo[a]:hi[a]] != qids[own][:, None])
            i, j = np.nonzero(keep)
            found.append((own[i], score[i, j], ids[lo[a] + j]))
        best.offer(*(np.concatenate(c) for c in zip(*found, strict=True)))
    return best.query, best.ids, best.score


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k best vectors by whole-number inner product.

    Components are floor(scale * x). Ties go to the smaller vec_id; a query is never
    its own result; fewer than k vectors give all of them. Vectors that are null,
    empty, or hold nulls or non-finite components take no part, nor do those without
    vec_id; vectors of different widths do not meet. Repeated query rows have results
    each; repeated vectors are results each. Pivots come from a bounded sample
    (SAMPLE), every vector is in the index, and the result is exact.
    """
    rows = stage(whole_vectors(vectors.where(F.col(vec_id).isNotNull()), vec_id, vector, scale), "vectors")
    wanted = stage(whole_vectors(queries.where(F.col(vec_id).isNotNull()), vec_id, vector, scale)
                   .withColumn("query", F.monotonically_increasing_id()), "queries")
    out = []
    for w in sorted(r.width for r in rows.select("width").distinct().collect()):
        out.append(_top_k(rows.where(F.col("width") == w), wanted.where(F.col("width") == w), w, k))
    if not out:
        return wanted.limit(0).select(
            F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score"))
    for other in out[1:]:
        out[0] = out[0].unionByName(other)
    return out[0]


def _top_k(rows: DataFrame, wanted: DataFrame, width: int, k: int) -> DataFrame:
    spark = rows.sparkSession
    count, top = rows.agg(F.count(F.lit(1)), F.max("norm2")).first()
    drawn = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()
    pivots = _pivots(drawn, width, top)
    sample = np.stack([np.frombuffer(r.v, "<i8") for r in drawn]).astype(np.float64)
    sample_ids = np.array([r.vec_id for r in drawn])
    sent = spark.sparkContext.broadcast((pivots, sample, sample_ids))

    def key(batches):
        pivots = sent.value[0]
        for batch in batches:
            if batch.num_rows:
                d = _distances(_lift(_matrix(batch.column("v"), width), top), pivots)
                nearest = d.argmin(axis=1)
                yield pa.record_batch({
                    "vec_id": batch.column("vec_id"), "v": batch.column("v"), "pivot": pa.array(nearest, pa.int32()),
                    "distance": pa.array(d[np.arange(len(d)), nearest])})

    blocks = max(1, -(-count // BLOCK))
    id_type = rows.schema["vec_id"].dataType.simpleString()
    # Ties at one distance are spread by vec_id, so a repeated vector does not fill one task.
    index = stage(
        rows.mapInArrow(key, f"vec_id {id_type}, v binary, pivot int, distance double")
        .repartitionByRange(blocks, "pivot", "distance", "vec_id").withColumn("block", F.spark_partition_id()), "index")
    groups = max(1, -(-wanted.count() // QUERY_BLOCK))
    mine = wanted.withColumn("group", F.pmod(F.xxhash64("query"), F.lit(groups)).cast("int")).select(
        F.col("vec_id").alias("query_id"), "query", "v", "group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"))
    theirs = index.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            none = np.zeros(0, np.int64)
            return _found(none, none, none, none)
        pivots, sample, sample_ids = sent.value
        left = left.sort_by([("pivot", "ascending"), ("distance", "ascending")])
        qids, q = right.column("query_id").to_numpy(), _matrix(right.column("v"), width)
        # The k-th best of the sample is a floor to begin with.
        known = _products(q, sample)
        known[sample_ids[None, :] == qids[:, None]] = -(1 << 62)
        floor = np.partition(known, -k, axis=1)[:, -k] if len(sample) >= k else np.full(len(q), -(1 << 62))
        at, ids, score = search_block(
            left.column("vec_id").to_numpy(), _matrix(left.column("v"), width), left.column("pivot").to_numpy(),
            left.column("distance").to_numpy(), qids, q, floor, pivots, top, k)
        return _found(right.column("query").to_numpy()[at], qids[at], ids, score)

    def _found(query, qids, ids, score) -> pa.Table:
        return pa.table({"query": pa.array(query, pa.int64()), "query_id": pa.array(qids, pa.int64()),
                         "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.int64())})

    found = theirs.groupBy("block", "group").cogroup(mine.groupBy("block", "group")).applyInArrow(
        search, "query long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
