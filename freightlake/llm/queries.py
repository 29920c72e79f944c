"""Registered queries of the operators, one for each, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlake.llm import (
    bpe,
    common,
    conversations,
    fingerprints,
    hard_negatives,
    language_model,
    licenses,
    near_duplicates,
    packing,
    quality,
    quality_rules,
    repeats,
    sharding,
    token_counts,
)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(common.documents(spark, sf_dir))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels")
    return quality.classify(common.documents(spark, sf_dir), labels)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = common.documents(spark, sf_dir)
    return packing.pack(packing.tokenized_pieces(documents, with_ids=False))


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = repeats.remove_repeats(common.documents(spark, sf_dir), with_text=True)
    return removed.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
        # What is left, to be read; a character that was cut in two goes as a whole.
        "text",
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(common.documents(spark, sf_dir))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(common.documents(spark, sf_dir))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(common.documents(spark, sf_dir))
    listed = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels")
    return quality_rules.apply_rules(common.documents(spark, sf_dir), labels)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(common.documents(spark, sf_dir).select("doc_id"))


def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.with_neighbours(common.documents(spark, sf_dir))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = common.table(spark, sf_dir, "conversations")
    return conversations.repair(conversations.damaged(rows))


def op12_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    return language_model.score(common.documents(spark, sf_dir), held_out)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    rows = common.table(spark, sf_dir, "embeddings").withColumn(
        "label", F.coalesce(moved, "label")
    )
    return hard_negatives.mine(hard_negatives.whole_vectors(rows))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_quality_classifier,
        op3_best_fit_packing,
        op4_suffix_dedup,
        op5_token_counts,
        op6_simhash,
        op7_bpe,
        op8_quality_rules,
        op9_sharding,
        op10_fingerprints,
        op11_conversation_repair,
        op12_language_model,
        op13_hard_negatives,
    )
}

ORACLE: dict[str, str] = {
    "op9_sharding": sharding.PLACE_SQL,
    "op13_hard_negatives": hard_negatives.MINE_SQL,
}
