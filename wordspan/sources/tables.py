"""The driver's tables as timed words, by fixed formulas, and folders for what queries write."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = r"[ \t\n\r\f\x0B]+"
LATIN = "abcdefghijklmnopqrstuvwxyz"
#: The letter that stands for each Latin one.
ARABIC = (
    "َبادِيوُّآلىم"
    "ناٰۦۡسيوٓرـۥۖ"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows of a table that fewer tasks than cores would read, dealt over the cores; a larger table isn't shuffled.

    A small table may be one row group, which one task reads."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores, key) if df.rdd.getNumPartitions() < cores else df


def scratch_folder(spark: SparkSession) -> str:
    """A new folder that executors share: under spark.checkpoint.dir, or a temporary one with a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="wordspan-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/wordspan-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: made once for several readers, and its lineage ends there. The shuffle files of the
    writing go when it ends."""
    path, conf, key = scratch_folder(df.sparkSession), df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, "false")
    conf.set(key, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        conf.set(key, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(words: DataFrame, name: str, keys: list[str], buckets: int) -> DataFrame:
    """``words`` as a table of the catalog in ``buckets`` buckets by ``keys``, sorted within: groups and joins on these keys need no
    shuffle any more. Kept until it is dropped; for words that are read more than once."""
    words.repartition(buckets, *keys).write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    return words.sparkSession.table(name)


def arabic(text: Column) -> Column:
    return F.translate(F.lower(text), LATIN, ARABIC)


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, SPACES), lambda t: t != "")


def documents(spark: SparkSession, sf_dir: str, by: list[str] = []) -> DataFrame:
    """(reciter_id, surah, ayah, tokens): documents as verses; sorted ``by`` columns of the table within partitions, while they are small."""
    docs = spread(table(spark, sf_dir, "documents").select("lang", "source", "doc_id", "text"), "doc_id")
    return (docs.sortWithinPartitions(*by) if by else docs).select(F.col("lang").alias("reciter_id"), F.col("source").alias("surah"), F.col("doc_id").alias("ayah"), tokens(F.coalesce("text", F.lit(""))).alias("tokens"))


def _word(t: Column, at: Column) -> list[Column]:
    """A token and its place in verse ``ayah`` as a word, with its start and the time until its end; some are wrong on purpose."""
    d, i = F.col("ayah"), at + 1
    bad = lambda k: (d % 7 == 0) & (i % k == 0)
    start = 1100 * at + 60 * (i - i % 50) + 35 * (i - i % 20) + (7 * d + 13 * i) % 200 + F.when(d % 9 == 0, 9000).otherwise(0) - F.when(bad(13), 1200).otherwise(0)
    own = F.when(bad(11), -5).when(bad(17), 30).when(bad(29), 16000).otherwise(100 + (97 * F.length(t) + 31 * d + 17 * i) % 900)
    score = -((d + i) % 900) / 100.0 - F.when(d % 10 == 3, 25.0).otherwise(0.0)
    return [i.cast("int").alias("idx"), t.alias("text"), start.cast("int").alias("start_ms"), own.cast("int").alias("own"), score.cast("double").alias("score")]


def _ended(get) -> list[Column]:
    """The fields of a timed word. The end is added in a step of its own, after the start is made: inlined, the formulas would stand
    in one stage several times, in methods longer than the JVM compiles."""
    return [get("idx").alias("idx"), get("text").alias("text"), get("start_ms").alias("start_ms"), (get("start_ms") + get("own")).alias("end_ms"), get("score").alias("score")]


def verses(spark: SparkSession, sf_dir: str, script: bool = False, by: list[str] = []) -> DataFrame:
    """(reciter_id, surah, ayah, duration_ms, words): a verse a row, words nested: no shuffle. In Arabic letters with ``script``."""
    docs, d, n = documents(spark, sf_dir, by), F.col("ayah"), F.size("tokens")
    duration = 1100 * n + 3000 * F.floor(n / 50) + 700 * F.floor(n / 20) + 200 + (d % 4) * 4000
    word = lambda t, at: F.struct(*[arabic(t).alias("text") if script and i == 1 else x for i, x in enumerate(_word(t, at))])
    timed = F.transform(F.transform("tokens", word), lambda w: F.struct(*_ended(lambda k: w[k])))
    return docs.select("reciter_id", "surah", "ayah", duration.cast("int").alias("duration_ms"), timed.alias("words"))


def words(spark: SparkSession, sf_dir: str, script: bool = False) -> DataFrame:
    """One row a word, in Arabic letters with ``script``.

    The outer explode, filtered after: the plain one would filter by the array first and make all of it twice."""
    rows = documents(spark, sf_dir).select("reciter_id", "surah", "ayah", F.posexplode_outer("tokens").alias("at", "token")).where("token is not null")
    rows = rows.select("reciter_id", "surah", "ayah", *_word(F.col("token"), F.col("at"))).select("reciter_id", "surah", "ayah", *_ended(F.col))
    return rows.withColumn("text", arabic(F.col("text"))) if script else rows


#: The same words in SQL, as common table expressions.
WORDS_SQL = rf"""
docs_ AS (SELECT lang AS reciter_id, source AS surah, doc_id AS ayah,
  list_filter(regexp_split_to_array(coalesce(text, ''), '{SPACES}'), lambda t: t <> '') AS ts FROM documents),
tokens_ AS (SELECT reciter_id, surah, ayah, len(ts) AS n, unnest(ts) AS text, generate_subscripts(ts, 1) AS idx FROM docs_),
timed_ AS (SELECT *, 1100 * (idx - 1) + 3000 * (idx // 50) + 700 * (idx // 20) + (7 * ayah + 13 * idx) % 200
    + CASE WHEN ayah % 9 = 0 THEN 9000 ELSE 0 END - CASE WHEN ayah % 7 = 0 AND idx % 13 = 0 THEN 1200 ELSE 0 END AS start_ms,
  CASE WHEN ayah % 7 = 0 AND idx % 11 = 0 THEN -5 WHEN ayah % 7 = 0 AND idx % 17 = 0 THEN 30 WHEN ayah % 7 = 0 AND idx % 29 = 0 THEN 16000
    ELSE 100 + (97 * length(text) + 31 * ayah + 17 * idx) % 900 END AS own FROM tokens_),
words AS (SELECT reciter_id, surah, ayah, idx, text, translate(lower(text), '{LATIN}', '{ARABIC}') AS script, start_ms, start_ms + own AS end_ms, CASE WHEN own > 0 THEN own END AS dur,
  -((ayah + idx) % 900) / 100.0 - CASE WHEN ayah % 10 = 3 THEN 25.0 ELSE 0.0 END AS score,
  1100 * n + 3000 * (n // 50) + 700 * (n // 20) + 200 + (ayah % 4) * 4000 AS duration_ms, n FROM timed_)"""
