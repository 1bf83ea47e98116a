"""Exact duplicates by an exchange of Golomb-coded fingerprints.

Each part sends its sorted fingerprints, compressed, to the owners of the ranges
they fall into. An owner answers with a bitmap per message: which of these occur
elsewhere. Only rows so marked are suspects, and only their texts are shuffled, to
be compared byte by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm import exchange
from shelfmark.llm.parts import PartTable, binary, texts_of, tidy
from shelfmark.sources.staging import hand_out, scope, stage

# An owner gets about this many fingerprints; their number grows with the rows.
KEYS_PER_OWNER = 1 << 18


def _digests(texts: pa.Array) -> tuple[pa.Array, list[bytes], np.ndarray]:
    """Texts with A-Z lower-cased, their SHA-256, and its first eight bytes."""
    lowered = pc.ascii_lower(texts)
    digests = [hashlib.sha256(t.as_buffer()).digest() for t in lowered.cast(pa.binary())]
    keys = np.frombuffer(b"".join(d[:8] for d in digests), "<u8").astype(np.uint64)
    return lowered, digests, keys


def _messages(texts: str, owners: int):
    def send(part: pa.Table) -> pa.Table:
        _, _, keys = _digests(texts_of(part.column(texts)))
        distinct, counts = np.unique(keys, return_counts=True)
        return exchange.messages(part.column("part")[0].as_py(), distinct, counts > 1, owners, 64)

    return send


def _suspects(doc_id: str, texts: str, owners: int):
    def mark(part: pa.Table, answers: pa.Table) -> pa.Table:
        lowered, digests, keys = _digests(texts_of(part.column(texts)))
        distinct, back = np.unique(keys, return_inverse=True)
        shared = exchange.marked(distinct, answers, owners, 64)[back]
        text = pc.if_else(pa.array(shared), lowered, pa.scalar(None, pa.string()))
        return pa.table({
            "row": part.column("row"), "doc_id": part.column(doc_id),
            "sha": binary(digests), "text": text})

    return mark


def decide(table: PartTable, doc_id: str = "doc_id", texts: str = "text") -> DataFrame:
    """Per row: row, doc_id, keep_id, keep_row, group_size, kept, sha.

    Of rows whose texts are the same after lower-casing A-Z (null counts as empty)
    the one with the largest doc_id stays, of these the one with the largest key.
    """
    owners = max(1, -(-table.rows.count() // KEYS_PER_OWNER))
    messages = table.each([texts], _messages(texts, owners), exchange.MESSAGE)
    answers = messages.groupBy("owner").applyInArrow(tidy(exchange.judge), exchange.ANSWER)
    id_type = table.kind(doc_id)
    seen = stage(
        table.each_with([doc_id, texts], stage(answers, "marks"), _suspects(doc_id, texts, owners),
                        f"row long, doc_id {id_type}, sha binary, text string"), "seen")
    # Rows that have a text are the suspects. The text is part of the key, so it is compared
    # byte by byte; a task sends one row per text, however often it holds it.
    same = (
        seen.where("text is not null").groupBy("sha", "text")
        .agg(F.max(F.struct("doc_id", "row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    # Texts that differ but share all 256 bits would be told apart above and must not be mixed up below.
    groups = stage(same.groupBy("sha").agg(
        F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("two texts share a SHA-256")).cast("long"))
        .otherwise(F.max("n")).alias("n"), F.first("keep").alias("keep")), "groups")
    alone = seen.where("text is null").select(
        "row", "doc_id", F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"),
        F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha")
    shared = seen.where("text is not null").select("row", "doc_id", "sha").join(groups, "sha").select(
        "row", "doc_id", F.col("keep.doc_id").alias("keep_id"), F.col("keep.row").alias("keep_row"),
        F.col("n").alias("group_size"), (F.col("row") == F.col("keep.row")).alias("kept"), "sha")
    return alone.unionByName(shared)


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", texts: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Nulls and empty texts are equal to one another; an empty table gives an empty
    result; other columns of ``docs`` do not matter. Of rows that share text and
    doc_id exactly one is kept.
    """
    with scope():
        table = PartTable(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{texts}`").alias("text")), "exact")
        return hand_out(decide(table).select(
            "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("sha")).alias("text_sha256")), "exact")


def drop_exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", texts: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole; the texts themselves are not changed."""
    with scope():
        table = PartTable(docs, "exact")
        with scope():
            chosen = hand_out(decide(table, doc_id, texts).where("kept").select("row"), "kept")
        return hand_out(table.keep(chosen), "deduplicated", "zstd")
