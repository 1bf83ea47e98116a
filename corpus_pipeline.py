"""From raw documents to packed training sequences.

Five stages, each on all that the one before kept; each result is written and read
again. ``run`` applies them to the documents of a folder.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import exact_dedup, minhash, packing, quality, suffix_dedup
from shelfmark.sources.staging import discard, freed_shuffles, scope, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the folder's labels."""
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, weights)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, whatever its case; of copies the one of the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return minhash.drop_near_duplicates(docs, shingle=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller doc_id holds as well."""
    return suffix_dedup.drop_repeats(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 tokens, every window in the mix of the sources."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), window=4096, end_id=2)
    return pieces.select(
        "doc_id", "source", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Stage]] = [
    ("quality", keep_good),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("suffix_dedup", cut_repeats),
    ("packing", pack),
]

# A trained classifier and a tokenizer are not SQL; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the folder's documents; what a stage wrote on its way, and its input, go when its result is written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, step in STAGES:
        path = scratch_path(spark, name)
        with scope():
            kept = step(spark, docs, sf_dir)
            with freed_shuffles(spark):
                kept.write.option("compression", "zstd").parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
        if before is not None:
            discard(spark, before)
        before = path
    return docs
