"""What is to be done: chapters, verses, shards, names, and what is done already."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .validate import Limits, validate

CHAPTERS = 114


def chapter_ranges(specs: DataFrame, spec: str, most: int = CHAPTERS) -> DataFrame:
    """(chapter): what lists like '1,2,112-114' name, within 1..most, each once."""
    part = specs.select(F.explode(F.split(spec, ",")).alias("p")).select(F.trim("p").alias("p")).where("p <> ''")
    ends = part.select(F.split_part("p", F.lit("-"), F.lit(1)).cast("int").alias("a"), F.split_part("p", F.lit("-"), F.lit(-1)).cast("int").alias("b")).where("a <= b")
    inside = ends.select(F.greatest("a", F.lit(1)).alias("a"), F.least("b", F.lit(most)).alias("b")).where("a <= b")
    return inside.select(F.explode(F.sequence("a", "b")).alias("chapter")).distinct()


def work_list(counts: DataFrame, chapter: str = "chapter", verses: str = "n_verses") -> DataFrame:
    """(chapter, verse, position): every verse of the chapters, numbered from 0 in order.

    The number is the running sum of the counts, one row a chapter, so that verses need no sort."""
    order = Window.orderBy(chapter).rowsBetween(Window.unboundedPreceding, -1)
    begun = counts.withColumn("_first", F.coalesce(F.sum(verses).over(order), F.lit(0)))
    return begun.where(F.col(verses) > 0).select(chapter, F.explode(F.sequence(F.lit(1), F.col(verses).cast("int"))).alias("verse"), "_first").select(chapter, "verse", (F.col("_first") + F.col("verse") - 1).alias("position"))


def shard_slice(items: DataFrame, index: int, count: int, position: str = "position") -> DataFrame:
    """Every ``count``-th item, beginning with number ``index``."""
    if not 0 <= index < count:
        raise ValueError("the shard's number must be in 0..count-1")
    return items.where(F.col(position) % count == index)


def select_items(items: DataFrame, pairs: DataFrame | None, keys: list[str], order: list[str], first: int | None = None) -> DataFrame:
    """The listed items, then the first of them. pairs: column pair, as 'chapter:verse'."""
    if pairs is not None:
        wanted = pairs.select(*[F.split_part(F.trim("pair"), F.lit(":"), F.lit(i + 1)).cast("long").alias(k) for i, k in enumerate(keys)]).distinct()
        items = items.join(wanted, keys, "left_semi")
    return items.orderBy(*order).limit(first) if first is not None else items


def audio_stem(chapter: Column, verse: Column) -> Column:
    return F.format_string("%03d%03d", chapter.cast("long"), verse.cast("long"))


def audio_names(items: DataFrame, chapter: Column, verse: Column, folder: Column, base: str) -> DataFrame:
    """``items`` with stem, audio_file, url and document path."""
    stem = audio_stem(chapter, verse)
    return items.withColumns({"stem": stem, "audio_file": F.concat(stem, F.lit(".mp3")), "url": F.concat_ws("/", F.lit(base.rstrip("/")), folder, F.concat(stem, F.lit(".mp3"))), "document": F.concat(F.concat_ws("/", chapter.cast("string"), verse.cast("string")), F.lit(".json"))})


def existing_outputs(tree: DataFrame, items: DataFrame, keys: list[str], duration: str, expected: str | None = None, words: str = "words", required: list[str] = [], limits: Limits = Limits()) -> DataFrame:
    """(keys, status) of the outputs in a tree that ``items`` ask for: ok, invalid or broken. Where a verse has several outputs, one
    that is ok counts, then an invalid one.

    tree: keys, broken, and the document's fields; items: keys, and the ``expected`` words. Outputs that no item asks for are sorted out before
    they are validated, by a join that Spark guards with a Bloom filter of the items where the tree is large."""
    wanted = items.select(*keys, *([F.col(expected)] if expected else []))
    asked = tree.join(wanted, keys) if expected else tree.join(wanted, keys, "left_semi")
    judged = validate(asked, duration, words, expected, required, limits)
    status = F.when(F.col("broken"), 0).when(F.coalesce("ok", F.lit(False)), 2).otherwise(1)
    return judged.groupBy(*keys).agg(F.element_at(F.array(F.lit("broken"), F.lit("invalid"), F.lit("ok")), F.max(status) + 1).alias("status"))


def resume_pending(items: DataFrame, outputs: DataFrame, keys: list[str], force: bool = False) -> DataFrame:
    """Items without a valid output, or all with ``force``, with status: missing, broken, invalid, or ok (with force only).

    outputs: (keys, status) as ``existing_outputs`` gives them."""
    rows = items.join(outputs.select(*keys, "status"), keys, "left").withColumn("status", F.coalesce("status", F.lit("missing")))
    return rows if force else rows.where("status <> 'ok'")


def backfill_analysis(words: DataFrame, analysed: str, attach) -> DataFrame:
    """Rows whose document lacks the analysis get it by ``attach``; the others stay, columns by name."""
    lacking = F.coalesce(F.col(analysed), F.lit(False)) == False  # noqa: E712
    new = attach(words.where(lacking)).withColumn(analysed, F.lit(True))
    return new.unionByName(words.where(~lacking), allowMissingColumns=True)


def placeholder_timings(verses: DataFrame, words: str = "tokens") -> DataFrame:
    """One row a word with even spans over max(1500, 450 n) ms; the verse's other columns stay."""
    n = F.size(words)
    total = F.greatest(F.lit(1500), 450 * n)
    rows = verses.withColumn("duration_ms", total).select(*[x for x in verses.columns if x != words], "duration_ms", n.alias("_n"), F.posexplode_outer(words).alias("_i", "text")).where(F.col("text").isNotNull())
    step = F.col("duration_ms") / F.col("_n")
    start = F.floor(F.col("_i") * step).cast("int")
    end = F.when(F.col("_i") + 1 == F.col("_n"), F.col("duration_ms")).otherwise(F.floor((F.col("_i") + 1) * step).cast("int"))
    return rows.select(*[x for x in verses.columns if x != words], "duration_ms", (F.col("_i") + 1).alias("idx"), "text", start.alias("start_ms"), F.greatest(end, start + 1).alias("end_ms"))


def reciter_dim(spark: SparkSession, reciters: dict[str, dict]) -> DataFrame:
    """(reciter_id, folder, bitrate_kbps) from a configuration mapping."""
    return spark.createDataFrame([(k, v.get("everyayah_folder"), v.get("bitrate_kbps")) for k, v in sorted(reciters.items())], "reciter_id string, folder string, bitrate_kbps int")


def with_reciter(items: DataFrame, dim: DataFrame, key: str = "reciter_id") -> DataFrame:
    """``items`` with the columns of their reciter; an action that meets an id which the configuration lacks fails."""
    known = F.broadcast(dim.withColumn("_known", F.lit(True)))  # as many rows as the configuration
    checked = F.when(F.col("_known"), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("unknown reciter "), F.coalesce(F.col(key), F.lit("null")))))
    return items.join(known, key, "left").withColumn(key, checked).drop("_known")


def unknown_reciters(items: DataFrame, dim: DataFrame, key: str = "reciter_id") -> DataFrame:
    """Ids that the configuration lacks; a caller treats any as an error."""
    return items.select(key).distinct().join(dim, key, "left_anti")
