"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents that the one before it left and returns what it
keeps, with the columns of documents; the last one returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freightlake.llm import (
    common,
    near_duplicates,
    packing,
    quality,
    quality_rules,
    repeats,
)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field takes for good ones."""
    return quality.keep_good(docs, common.table(spark, sf_dir, "labels"))


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the likelihood ratio."""
    return quality_rules.keep_passing(docs, common.table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id.

    Fingerprints over three words link at three bits or fewer, as in op6.
    """
    return near_duplicates.keep_one(docs, width=3, radius=3)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that occur more than once; none is dropped.

    Passages have more than 50 words, whatever is between them.
    """
    return repeats.without_repeats(docs, length=None, words=51)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, with their sequences and offsets."""
    return packing.pack(packing.tokenized_pieces(docs, with_ids=False))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_filter),
    ("simhash_near_dedup", near_dedup),
    ("suffix_array_dedup", passage_dedup),
    ("best_fit_packing", pack_sequences),
]

# The field, the fingerprints and the tokenizer have no SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.stored_once(stage(spark, docs, sf_dir), name)
    return docs
