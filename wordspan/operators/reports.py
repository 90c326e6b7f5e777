"""Counters, failure lists and the gate on them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTERS = ["attempted", "skipped", "passed", "failed"]


def shard_summary(results: DataFrame, keys: list[str], status: str = "status") -> DataFrame:
    """(keys, attempted, skipped, passed, failed) of rows with status skipped, passed or failed."""
    return results.groupBy(*keys).agg(F.count("*").alias("attempted"), *[F.count_if(F.col(status) == k).alias(k) for k in COUNTERS[1:]])


def failure_rows(results: DataFrame, keys: list[str], errors: str = "errors", error: str = "error", status: str = "status") -> DataFrame:
    """(keys, reason) of failed rows: the error, else the validation errors joined with ';'."""
    return results.where(F.col(status) == "failed").select(*keys, F.coalesce(F.col(error), F.array_join(errors, ";")).alias("reason"))


def merge_reports(summaries: DataFrame, keys: list[str] = []) -> DataFrame:
    """Sums over shards, with processed and fail_rate; a missing counter is 0."""
    sums = summaries.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in COUNTERS])
    rate = F.when(F.col("attempted") > 0, F.col("failed") / F.col("attempted")).otherwise(0.0)
    return sums.withColumn("processed", F.col("passed") + F.col("failed")).withColumn("fail_rate", rate)


def failure_gate(merged: DataFrame, most: float = 0.05) -> DataFrame:
    """``merged`` with over_gate: something was attempted and the rate is over the limit."""
    return merged.withColumn("over_gate", (F.col("attempted") > 0) & (F.col("fail_rate") > most))


def failures_csv(failures: DataFrame, path: str) -> None:
    failures.select("surah", "ayah", "reason").write.mode("overwrite").option("header", True).csv(path)
