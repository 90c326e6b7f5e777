"""From raw documents to packed training sequences, in five stages over the whole corpus.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between stages the
rows are written as Parquet and read again. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wordspan.llm import decontaminate, lines, packing, simhash, toxicity
from wordspan.llm.common import stash, table

#: The stages learn, sample walks and pack; SQL doesn't express them. The tests hold the stages that drop rows or lines against slow versions.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from the texts; every document stays."""
    done = lines.drop_recurring_lines(docs).select(*docs.columns)
    return done.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else done


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents, placed in sequences."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("near-dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
