"""Baselines and the analysis of timed words, one row a word. Column names are parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions import text as T
from ..functions.core import free_names, half_even
from ..sources.tables import written
from .ranges import running_total


@dataclass(frozen=True)
class Columns:
    """Names of the columns of timed words."""

    reciter: str = "reciter_id"
    chapter: str = "surah"
    verse: str = "ayah"
    index: str = "idx"
    text: str = "text"
    start: str = "start_ms"
    end: str = "end_ms"
    score: str = "score"
    duration: str = "dur"

    @property
    def verse_key(self) -> list[str]:
        return [self.reciter, self.chapter, self.verse]


def with_duration(words: DataFrame, c: Columns = Columns()) -> DataFrame:
    return words.withColumn(c.duration, M.word_duration(F.col(c.start), F.col(c.end)))


def group_stats(words: DataFrame, keys: list[str], value: str, names: tuple[str, str], least: int = 1) -> DataFrame:
    """(keys, mean rounded to 1 place, median, n) of the non-null values; null under ``least`` of them."""
    enough = F.col("n") >= least
    got = words.groupBy(*keys).agg(F.count(value).alias("n"), F.sum(value).alias("s"), F.median(value).alias("m"))
    mean = half_even(F.col("s"), F.greatest(F.col("n"), F.lit(1)), 1)
    return got.select(*keys, F.when(enough, mean).alias(names[0]), F.when(enough, F.col("m")).alias(names[1]), "n")


def verse_stats(words: DataFrame, c: Columns = Columns()) -> DataFrame:
    return group_stats(words, c.verse_key, c.duration, ("verse_mean", "verse_median"))


def chapter_stats(words: DataFrame, c: Columns = Columns(), least: int = 8) -> DataFrame:
    """Without chapter null or 0."""
    named = words.where(F.col(c.chapter).isNotNull() & (F.col(c.chapter).cast("string") != "0"))
    return group_stats(named, [c.reciter, c.chapter], c.duration, ("chapter_mean", "chapter_median"), least)


def reciter_median(words: DataFrame, c: Columns = Columns(), least: int = 8) -> DataFrame:
    return group_stats(words, [c.reciter], c.duration, ("reciter_mean", "reciter_median"), least).select(c.reciter, "reciter_median", "n")


def order_stats(rows: DataFrame, keys: list[str], value: str, prefix: str = "") -> DataFrame:
    """(keys, n, below, mid, above): the middle values of each group, from which the median without any
    one value follows. Groups are counted by value first, so a window sees their distinct values only. Nulls are sorted out by
    their count: a filter on the value would be pushed below the formula that makes it, and make it twice."""
    return order_stats_of(rows.groupBy(*keys, value).agg(F.count(value).alias("_c")).where("_c > 0"), keys, value, prefix)


def order_stats_of(counts: DataFrame, keys: list[str], value: str, prefix: str = "") -> DataFrame:
    """The same from (keys, value, _c)."""
    order = Window.partitionBy(*keys).orderBy(value)
    seen = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    total = F.sum("_c").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ranked = counts.select(*keys, value, seen.alias("_seen"), total.alias("_n"))
    middle = F.floor((F.col("_n") - 1) / 2)
    at = lambda p: F.min(F.when(F.col("_seen") > p, F.col(value)))
    return ranked.groupBy(*keys).agg(F.max("_n").alias(prefix + "n"), at(middle - 1).alias(prefix + "below"), at(middle).alias(prefix + "mid"), at(middle + 1).alias(prefix + "above"))


def median_without(v: Column, n: Column, below: Column, mid: Column, above: Column) -> Column:
    """The median of a group without one copy of its value v, from its order statistics."""
    even = F.when(v <= mid, above).otherwise(mid).cast("double")
    low, high = F.when(v <= below, mid).otherwise(below), F.when(v >= above, mid).otherwise(above)
    return F.when(v.isNull() | (n < 2), None).when(n % 2 == 0, even).otherwise((low + high) / 2.0)


def loo_median(rows: DataFrame, keys: list[str], value: str, out: str, least_others: int = 1) -> DataFrame:
    """``rows`` with ``out``, the median of the other values of the row's group, and ``out``_others, how
    many they are; null where the value is, or under ``least_others`` of them. Null keys have no group."""
    stats = order_stats(rows, keys, value, f"_{out}_")
    joined = rows.join(stats, keys, "left")
    n = F.col(f"_{out}_n")
    got = median_without(F.col(value), n, *(F.col(f"_{out}_{k}") for k in ("below", "mid", "above")))
    others = F.when(F.col(value).isNotNull(), n - 1)
    return joined.select(*[F.col(x) for x in rows.columns], F.when(others >= least_others, got).alias(out), others.alias(f"{out}_others"))


def word_baseline(words: DataFrame, c: Columns = Columns(), least: int = 3) -> DataFrame:
    keyed = words.withColumn("word_key", T.baseline_key(F.col(c.text)))
    return loo_median(keyed, [c.reciter, "word_key"], c.duration, "word_base", least)


def verse_baseline(words: DataFrame, c: Columns = Columns(), least: int = 2) -> DataFrame:
    return loo_median(words, c.verse_key, c.duration, "verse_base", least)


def resolve_baseline(words: DataFrame, config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """``words`` with baseline_ms, baseline_source and baseline_n: the first of word, verse, chapter and
    reciter that has enough samples. n counts the others for the first two and whole groups else."""
    based = verse_baseline(word_baseline(words, c, config.min_word_samples), c, config.min_verse_others)
    chapters = chapter_stats(words, c, config.min_chapter_words).select(c.reciter, c.chapter, "chapter_median", F.col("n").alias("chapter_n"))
    reciters = reciter_median(words, c, config.min_reciter_words).select(c.reciter, "reciter_median", F.col("n").alias("reciter_n"))
    joined = based.join(chapters, [c.reciter, c.chapter], "left").join(reciters, c.reciter, "left")
    return joined.select(*[F.col(x) for x in words.columns], *first_baseline(c), "chapter_median")


def first_baseline(c: Columns) -> list[Column]:
    """baseline_ms, baseline_source and baseline_n: of the first of word, verse, chapter and reciter that there is."""
    steps = [("word", "word_base", "word_base_others"), ("verse", "verse_base", "verse_base_others"), ("surah", "chapter_median", "chapter_n"), ("reciter", "reciter_median", "reciter_n")]

    def first(pick) -> Column:
        out = F.when(F.col(c.duration).isNull(), None)
        for step in steps:
            out = out.when(F.col(step[1]).isNotNull(), pick(step))
        return out

    return [first(lambda s: F.col(s[1]).cast("double")).alias("baseline_ms"), first(lambda s: F.lit(s[0])).alias("baseline_source"), first(lambda s: F.col(s[2]).cast("long")).alias("baseline_n")]


NO_CANDIDATES = "array<struct<type:string,clusterIndex:int,reason:string>>"
#: What an analysis adds to words; old values of a document analysed before go first.
ANALYSIS = ["dur", "candidates", "stretch", "baseline_ms", "baseline_source", "baseline_n", "ratio", "level", "confidence", "verse_mean", "verse_median", "chapter_mean", "chapter_median", "timing_enabled"]


def stripped(words: DataFrame, c: Columns = Columns()) -> DataFrame:
    return words.drop(*[x for x in [*ANALYSIS, c.duration] if x in words.columns])


def text_analysis(texts: DataFrame, config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """``texts`` with candidates and stretch, which follow from the text."""
    drawn = texts.withColumn("candidates", F.coalesce(T.madd_candidates(F.col(c.text)), F.array().cast(NO_CANDIDATES)))
    return drawn.withColumn("stretch", T.stretch_positions(F.col(c.text), F.col("candidates"), config.max_tatweel))


def dealt(texts: DataFrame, *keys: str) -> DataFrame:
    """Texts over all tasks: few bytes, which would be read by few tasks, but long work on each."""
    spark = texts.sparkSession
    return texts.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), *keys)


def with_text_analysis(words: DataFrame, config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """Adds candidates and stretch, made once a distinct text."""
    texts = text_analysis(dealt(words.select(c.text).where(F.col(c.text).isNotNull()).distinct(), c.text), config, c)
    return words.join(texts, c.text, "left").select(*words.columns, F.coalesce("candidates", F.array().cast(NO_CANDIDATES)).alias("candidates"), "stretch")


def measured(words: DataFrame, config: M.TimingConfig, c: Columns) -> DataFrame:
    """Adds ratio, level and confidence to words with a baseline and candidates."""
    has = F.size("candidates") > 0
    rows = words.withColumn("ratio", M.duration_ratio(F.col(c.duration), F.col("baseline_ms")))
    return rows.withColumn("level", M.extension_level(F.col("ratio"), has, config)).withColumn("confidence", M.extension_confidence(F.col("ratio"), has, F.col(c.score), F.col("baseline_source"), F.col("baseline_n")))


def with_verse_measures(words: DataFrame, c: Columns = Columns(), least: int = 2) -> DataFrame:
    """``words`` with dur, verse_mean, verse_median, verse_base and verse_base_others. One shuffle, or none where words lie in a
    table bucketed by verse (``sources.tables.bucketed``): a verse's words are gathered in one row."""
    rest = [x for x in words.columns if x not in c.verse_key]
    own = M.word_duration(F.col(c.start), F.col(c.end))
    (w_,) = free_names(words, "w")
    nested = words.groupBy(*c.verse_key).agg(F.collect_list(F.struct(*rest, own.alias(c.duration))).alias(w_))
    return verse_measures(nested, w_, words.columns, c, least)


def measured_verses(verses: DataFrame, words: str = "words", c: Columns = Columns(), least: int = 2, fields: list[str] | None = None) -> DataFrame:
    """``with_verse_measures`` of nested verses (keys, array of words with index, text, start, end and score, or the ``fields`` among
    them that are asked for): measured where they are, no shuffle."""
    fields = fields or [c.index, c.text, c.start, c.end, c.score]
    inner = F.transform(words, lambda w: F.struct(*[w[x].alias(x) for x in fields], M.word_duration(w[c.start], w[c.end]).alias(c.duration)))
    return verse_measures(verses.select(*c.verse_key, inner.alias("w")), "w", [*c.verse_key, *fields], c, least)


def verse_measures(nested: DataFrame, w_: str, columns: list[str], c: Columns, least: int) -> DataFrame:
    """The words of verses (keys, array ``w_`` of the other columns and the duration), one row each, with their verse's
    measures: its order statistics are places of its sorted durations. No shuffle."""
    d_, n_, below_, mid_, above_ = free_names(nested, "d", "n", "below", "mid", "above")
    sorted_ = nested.withColumn(d_, F.array_sort(F.filter(F.transform(w_, lambda w: w[c.duration]), lambda d: d.isNotNull())))
    n, middle = F.size(d_), F.floor((F.size(d_) - 1) / 2).cast("int")
    total = F.aggregate(d_, F.lit(0).cast("long"), lambda acc, d: acc + d)
    some, at = n > 0, lambda i: F.get(F.col(d_), i)
    stats = sorted_.select(
        *c.verse_key, n.alias(n_), at(middle - 1).alias(below_), at(middle).alias(mid_), at(middle + 1).alias(above_), F.when(some, half_even(total, F.greatest(n, F.lit(1)), 1)).alias("verse_mean"),
        F.when(some, (at(F.floor((n - 1) / 2).cast("int")) + at(F.floor(n / 2).cast("int"))) / 2.0).alias("verse_median"), w_,
    )
    # the outer form, filtered after: the plain one would filter by the array first and make all of it twice
    rows = stats.select(*[x for x in stats.columns if x != w_], F.explode_outer(w_).alias(w_)).where(F.col(w_).isNotNull())
    d = F.col(w_)[c.duration]
    others = F.when(d.isNotNull(), F.col(n_) - 1).cast("long")
    base = F.when(others >= least, median_without(d, F.col(n_), F.col(below_), F.col(mid_), F.col(above_)))
    named = [F.col(x) if x in c.verse_key else F.col(w_)[x].alias(x) for x in columns]
    return rows.select(*named, d.alias(c.duration), "verse_mean", "verse_median", base.alias("verse_base"), others.alias("verse_base_others"))


def folded(words: DataFrame, c: Columns) -> tuple[DataFrame, list[Column]]:
    """``words`` with all columns but those of ``c`` in one struct, so that no helper column meets one of their names, and
    the columns that bring them back."""
    own = [x for x in words.columns if x in (*c.verse_key, c.index, c.text, c.start, c.end, c.score)]
    rest = [x for x in words.columns if x not in own]
    if not rest:
        return words, [F.col(x) for x in own]
    return words.select(*own, F.struct(*rest).alias("rest_of_row")), [F.col(x) if x in own else F.col("rest_of_row")[x].alias(x) for x in words.columns]


def attach_analysis(words: DataFrame, config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """The analysis of each verse by itself: verse statistics and verse baselines only, in place of what an
    analysis before has left. timing_enabled says that it is there. Unchanged when disabled."""
    if not config.enabled:
        return words
    plain, back = folded(stripped(words, c), c)
    done = _attached(with_verse_measures(plain, c, config.min_verse_others), config, c)
    return done.select(*back, *[x for x in done.columns if x not in plain.columns])


def attach_verses(verses: DataFrame, words: str = "words", config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """``attach_analysis`` for nested verses, as ``enrich_verses``: a row a word, shuffled only by text."""
    if not config.enabled:
        return _plain_words(verses, words, c)
    return _attached(measured_verses(verses, words, c, config.min_verse_others), config, c)


def _plain_words(verses: DataFrame, words: str, c: Columns) -> DataFrame:
    return verses.select(*c.verse_key, F.explode(words).alias("w")).select(*c.verse_key, *[F.col("w")[x].alias(x) for x in [c.index, c.text, c.start, c.end, c.score]])


def _attached(based: DataFrame, config: M.TimingConfig, c: Columns) -> DataFrame:
    known = F.col("verse_base").isNotNull()
    based = based.withColumns({"baseline_ms": F.col("verse_base"), "baseline_source": F.when(known, "verse"), "baseline_n": F.when(known, F.col("verse_base_others"))}).drop("verse_base", "verse_base_others")
    return measured(with_text_analysis(based, config, c), config, c).withColumn("timing_enabled", F.lit(True))


#: Tables of so many rows at most are copied to all tasks; larger ones are joined by key.
BROADCAST_ROWS = 100_000


def counted_stats(counts: DataFrame, keys: list[str], c: Columns, least: int, names: tuple[str, str, str]) -> DataFrame:
    """(keys, mean, median, n) from (keys, duration, n): groups are counted by value before, so no group is held."""
    n = F.sum("n")
    got = counts.groupBy(*keys).agg(n.alias(names[2]), F.sum(F.col(c.duration) * F.col("n")).alias("_s"), F.percentile(F.col(c.duration), F.lit(0.5), F.col("n")).alias(names[1]))
    return got.where(F.col(names[2]) >= least).select(*keys, half_even(F.col("_s"), F.col(names[2]), 1).alias(names[0]), names[1], names[2])


def small(df: DataFrame) -> DataFrame:
    """``df`` as a table, broadcast only if it is small enough."""
    kept = written(df)
    return F.broadcast(kept) if kept.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else kept


def enrich(words: DataFrame, config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """The analysis over whole reciters: durations, candidates, stretch, baseline, ratio, level, confidence, and
    the mean and median of verse and chapter, in place of what an analysis before has left. Words of a flat table are gathered by
    verse first; where verses are nested already, ``enrich_verses`` does without that shuffle."""
    if not config.enabled:
        return words
    plain, back = folded(stripped(words, c), c)
    done = _enriched(with_verse_measures(plain, c, config.min_verse_others), plain.columns, config, c)
    return done.select(*back, *[x for x in done.columns if x not in plain.columns])


def enrich_verses(verses: DataFrame, words: str = "words", config: M.TimingConfig = M.TimingConfig(), c: Columns = Columns()) -> DataFrame:
    """``enrich`` for nested verses (reciter, chapter, verse, array of words with index, text, start, end and score, all named by
    ``c``): a row a word. Verses are measured where they are, so words are shuffled once at most, by text, to meet the lexicon, and
    not at all while that is small enough to be broadcast. Other columns of verses and fields of words aren't returned."""
    if not config.enabled:
        return _plain_words(verses, words, c)
    return _enriched(measured_verses(verses, words, c, config.min_verse_others), [*c.verse_key, c.index, c.text, c.start, c.end, c.score], config, c)


def _enriched(measures: DataFrame, columns: list[str], config: M.TimingConfig, c: Columns) -> DataFrame:
    """Words with their verse's measures are made once. All else is counted before it is shuffled: durations by
    chapter, and a lexicon with a row for each text of a reciter, which holds the word's order statistics and
    the analysis of the text, so that words are joined once. Skewed texts are left to the adaptive join."""
    timed = written(measures.withColumn("_text", F.coalesce(c.text, F.lit(""))))
    has = F.col(c.duration).isNotNull()
    by_chapter = written(timed.where(has).groupBy(c.reciter, c.chapter, c.duration).agg(F.count("*").alias("n")))
    named = by_chapter.where(F.col(c.chapter).isNotNull() & (F.col(c.chapter).cast("string") != "0"))
    chapters = small(counted_stats(named, [c.reciter, c.chapter], c, config.min_chapter_words, ("chapter_mean", "chapter_median", "chapter_n")))
    reciters = small(counted_stats(by_chapter, [c.reciter], c, config.min_reciter_words, ("_mean", "reciter_median", "reciter_n")).drop("_mean"))
    by_text = written(timed.groupBy(c.reciter, "_text", c.duration).agg(F.count("*").alias("n")))
    keyed = by_text.withColumn("word_key", T.baseline_key(F.col("_text")))
    stats = order_stats_of(keyed.where(has).groupBy(c.reciter, "word_key", c.duration).agg(F.sum("n").alias("_c")), [c.reciter, "word_key"], c.duration, "_")
    texts = text_analysis(dealt(keyed.select(c.reciter, "word_key", "_text"), c.reciter, "_text").distinct().withColumnRenamed("_text", c.text), config, c).withColumnRenamed(c.text, "_text")
    lexicon = texts.join(stats, [c.reciter, "word_key"], "left").drop("word_key")
    rows = timed.join(lexicon, [c.reciter, "_text"], "left").join(chapters, [c.reciter, c.chapter], "left").join(reciters, c.reciter, "left")
    others = F.when(has, F.col("_n") - 1).cast("long")
    word = F.when(others >= config.min_word_samples, median_without(F.col(c.duration), F.col("_n"), F.col("_below"), F.col("_mid"), F.col("_above")))
    rows = rows.withColumn("word_base", word).withColumn("word_base_others", others)
    rows = rows.select(*columns, c.duration, "verse_mean", "verse_median", "chapter_mean", "chapter_median", *first_baseline(c), F.coalesce("candidates", F.array().cast(NO_CANDIDATES)).alias("candidates"), "stretch")
    return measured(rows, config, c).withColumn("timing_enabled", F.lit(True))


def chapter_timeline(verses: DataFrame, duration: str, c: Columns = Columns()) -> DataFrame:
    """(reciter, chapter, verse, start_ms, end_ms) of verses in the audio of their chapter, one after the other. A chapter may
    hold all verses: ranges of it are summed apart and raised by the totals before them."""
    rows = verses.select(*c.verse_key, F.col(duration).cast("long").alias("own_ms"))
    done = running_total(rows, [c.reciter, c.chapter], [c.verse], "own_ms", "end_ms")
    return done.select(*c.verse_key, (F.col("end_ms") - F.coalesce("own_ms", F.lit(0))).alias("start_ms"), "end_ms")
