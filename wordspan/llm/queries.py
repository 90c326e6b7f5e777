"""Queries of this package: one an operator, over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, caps, chat, decontaminate, licenses, lines, packing, phrases, quality, runs, simhash, suffixes, toxicity
from .common import table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), licenses.built_in(spark))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_recurring_lines(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("text_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.preferences(chat.preference_pairs(table(spark, sf_dir, "conversations")))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffixes.dedup(suffixes.file_batches(spark, f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return ann.neighbours(rows, rows.where("vec_id % 100 = 0"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digests(runs.periodic_runs(runs.planted(table(spark, sf_dir, "documents"))))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.ranked(phrases.collocations(table(spark, sf_dir, "documents")))


def op13_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return caps.links(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_simhash, op2_license_scan, op3_line_dedup, op4_quality, op5_toxicity, op6_packing,
        op7_decontamination, op8_chat_preferences, op9_suffix_dedup, op10_neighbours, op11_runs, op12_collocations, op13_caps,
    )}


def oracle_sql() -> dict[str, str]:
    return {
            "op2_license_scan": licenses.oracle(), "op3_line_dedup": lines.oracle(), "op8_chat_preferences": chat.oracle(),
            "op11_runs": runs.oracle(), "op12_collocations": phrases.oracle(), "op13_caps": caps.oracle()}
