"""Quality scores: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader.

Features are word n-grams of two kinds, of the words themselves and of their shapes
(case, digits, marks, length, whether a word repeats the one before), hashed into a
fixed number of weights. Training is FTRL-proximal on a bounded sample of labelled
documents, in shards whose weights are averaged. A score is a sparse dot product.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from shelfmark.llm.parts import small_batches, spans, text_bytes, texts_of, tidy
from shelfmark.llm.words import keys, mix, sums, word_spans

BITS = 18
SHARDS = 8
SAMPLE = 16384

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
KINDS = np.full(256, 3, np.uint8)  # marks
KINDS[65:91] = 0
KINDS[97:123] = 1
KINDS[128:] = 1
KINDS[48:58] = 2


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, text after text, and where each text's begin and the last end.

    Per word: the word, the word with the next, its shape, and its shape with the next.
    """
    data, offsets = text_bytes(texts)
    starts, ends, at = word_spans(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    word, _ = keys(LOWER[data], starts, ends)
    sizes = ends - starts
    kinds = KINDS[data]
    counts = [np.concatenate([[0], np.cumsum(kinds == k)]) for k in (0, 1, 2, 3)]
    upper, lower, digits, marks = (c[ends] - c[starts] for c in counts)
    first = np.zeros(len(starts), bool)
    first[at[:-1][at[:-1] < at[1:]]] = True
    repeats = np.append(False, word[1:] == word[:-1]) & ~first
    length = np.minimum(np.ceil(np.log2(sizes + 1)), 7).astype(np.uint64)
    shape = np.minimum(upper, 2).astype(np.uint64)
    for value, base in ((np.minimum(lower, 1), 2), (np.minimum(digits, 2), 3), (np.minimum(marks, 3), 4),
                        (data[ends - 1] * (kinds[ends - 1] == 3), 256), (repeats, 2), (length, 8)):
        shape = shape * np.uint64(base) + value.astype(np.uint64)
    shape = mix(shape + np.uint64(1))
    closes = np.append(first[1:], True)
    out = np.empty((len(starts), 4), np.uint64)
    out[:, 0], out[:, 2] = word, shape
    for column, base in ((1, word), (3, shape)):
        after = np.append(base[1:], np.uint64(0))
        after[closes] = 0
        out[:, column] = mix(base * np.uint64(0x9E3779B97F4A7C15) + after + np.uint64(column))
    return (out.ravel() >> np.uint64(64 - BITS)).astype(np.int64), at * 4


def scores(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Probability of label 1 per text; the last weight is the bias, all that an empty text has."""
    out = np.empty(len(texts))
    for i, j in spans(texts):
        index, at = features(texts.slice(i, j - i))
        n = np.maximum(1, np.diff(at))
        out[i:j] = sums(weights[index], at) / np.sqrt(n) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def train(texts: pa.Array, labels: np.ndarray, alpha=0.3, beta=1.0, l1=0.02, l2=0.2, epochs: int = 3) -> np.ndarray:
    """FTRL-proximal over the texts in their order; weights of all features and the bias."""
    z, n = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
    rows = []
    for i, j in spans(texts):
        index, at = features(texts.slice(i, j - i))
        for a, b in zip(at[:-1], at[1:], strict=True):
            unique, count = np.unique(index[a:b], return_counts=True)
            rows.append((np.append(unique, 1 << BITS), np.append(count / np.sqrt(max(1, b - a)), 1.0)))

    def weights(i):
        zi = z[i]
        return np.where(np.abs(zi) <= l1, 0.0, (np.sign(zi) * l1 - zi) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for (index, value), label in zip(rows, labels, strict=True):
            w = weights(index)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -30, 30)))
            g = (p - label) * value
            grown = n[index] + g * g
            z[index] += g - (np.sqrt(grown) - np.sqrt(n[index])) / alpha * w
            n[index] = grown
    return weights(slice(None))


def held_out(doc_id: Column) -> Column:
    """True for the third of the documents whose labels are never seen in training."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> np.ndarray:
    """Weights from at most ``sample`` labelled documents that are not held out.

    The sample is the labelled documents of the smallest hashes. A document with
    several labels takes the more frequent one (1 on a tie); null labels and labels
    without document do not count. Without any label all weights are 0.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg((F.avg(F.col(label)) >= 0.5).cast("int").alias("label"))
        .withColumn("place", F.xxhash64("doc_id", F.lit(7)))
        .orderBy("place", "doc_id").limit(sample)
    )
    # At most ``sample`` short rows, so a broadcast of known size.
    rows = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("place", "doc_id", "text", "label")

    def shard(batches):
        parts = [pa.Table.from_batches([b]) for b in batches]
        if not sum(p.num_rows for p in parts):
            return
        rows = pa.concat_tables(parts).sort_by([("place", "ascending"), ("doc_id", "ascending"), ("text", "ascending")])
        w = train(texts_of(rows.column("text")), rows.column("label").to_numpy())
        yield pa.record_batch({"weights": pa.array([w.astype("<f4").tobytes()], pa.binary()), "n": pa.array([rows.num_rows], pa.int64())})

    made = rows.repartition(SHARDS, F.pmod("place", F.lit(SHARDS))).mapInArrow(tidy(shard), "weights binary, n long").collect()
    total = sum(r.n for r in made)
    out = np.zeros((1 << BITS) + 1)
    for r in sorted(made, key=lambda r: (r.n, bytes(r.weights[:64]))):
        out += np.frombuffer(r.weights, "<f4") * (r.n / total)
    return out.astype(np.float32)


def _scored(docs: DataFrame, weights: np.ndarray, add, kinds: list[StructField]) -> DataFrame:
    """``docs`` with what ``add`` makes of each batch and its scores; columns travel under numbers."""
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    place = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield add(batch, scores(texts_of(batch.column(place)), sent.value))

    names = [f"c{i}" for i in range(len(docs.columns))]
    fields = [StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields, strict=True)]
    return docs.toDF(*names).mapInArrow(tidy(run), StructType([*fields, *kinds])).toDF(*docs.columns, *[k.name for k in kinds])


def score(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """``docs`` (doc_id, text, any others) with score and predicted (1 from 0.5 on) behind its columns; columns of these names are replaced.

    Null texts are scored as empty ones, texts of any length whole; repeated rows are
    scored each; an empty table gives an empty one.
    """
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in ("score", "predicted")])
    def add(batch, p):
        return batch.append_column("score", pa.array(p)).append_column("predicted", pa.array((p >= 0.5).astype(np.int32)))

    return _scored(docs, weights, add, [StructField("score", DoubleType()), StructField("predicted", IntegerType())])


def keep_good(docs: DataFrame, weights: np.ndarray) -> DataFrame:
    """The rows of ``docs`` that score at least 0.5, in its own columns."""
    return _scored(docs, weights, lambda batch, p: batch.filter(pa.array(p >= 0.5)), [])
