"""Validation of verses against a fixed set of rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.core import fixed, let


@dataclass(frozen=True)
class Limits:
    min_mean_score: float | None = -20.0
    max_word_ms: int = 15000
    min_word_ms: int = 80
    max_very_short_frac: float = 0.08
    min_coverage: float = 0.48
    max_gap_ms: int = 1600


def _say(condition: Column, *parts) -> Column:
    """The message where the condition holds, else null."""
    return F.when(condition, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts]))


def _text(x: Column) -> Column:
    return F.coalesce(x.cast("string"), F.lit("None"))


def _word_errors(words: Column, expected: Column | None, duration: Column, limits: Limits) -> Column:
    """Errors of the words (with soft and pause), in the order of words and rules."""

    def of(w: Column, i: Column) -> Column:
        before = F.get(words, i - 1)
        last = F.coalesce(before["end_ms"], F.lit(-1))
        start, end, n = w["start_ms"], w["end_ms"], _text(w["idx"])
        own, gap = end - start, start - last
        large = (gap > limits.max_gap_ms) & ~F.coalesce(before["pause"], F.lit(False))
        rules = [
            _say(w["idx"] != i + 1, "index_order at ", i.cast("string"), ": got ", n),
            _say(F.lit(expected is not None) & ~w["text"].eqNullSafe(F.get(expected, i)), "text_mismatch at ", n) if expected is not None else F.lit(None).cast("string"),
            _say((start < 0) | (end < 0), "negative_ts at ", n),
            _say(start >= end, "start_ge_end at ", n),
            _say(end > duration + 50, "end_past_duration at ", n, ": ", _text(end), ">", _text(duration)),
            _say(start < last - 30, "overlap at ", n),
            _say((own < w["soft"]) & (own < 40), "collapsed at ", n, ": ", _text(own), "ms"),
            _say(own > limits.max_word_ms, "too_long at ", n, ": ", _text(own), "ms"),
            _say((last >= 0) & large, "large_gap before ", n, ": ", _text(gap), "ms"),
            _say((last >= 0) & ~large & (gap > 2800), "huge_gap before ", n, ": ", _text(gap), "ms"),
        ]
        return F.filter(F.array(*rules), lambda x: x.isNotNull())

    return F.flatten(F.transform(words, of))


def errors(words: Column, duration: Column, expected: Column | None = None, present: dict[str, Column] | None = None, limits: Limits = Limits()) -> Column:
    """The ordered messages of a verse; words: array of idx, text, start_ms, end_ms, score.

    ``present`` has the required fields by name; those that are null are reported, and nothing else then."""
    required = {"words": words, **(present or {})}
    missing = F.filter(F.array(*[_say(x.isNull(), f"missing_field:{k}") for k, x in required.items()]), lambda x: x.isNotNull())

    def soft(w: Column) -> Column:  # what needs the letters, once a word
        return F.least(F.lit(limits.min_word_ms), F.greatest(F.lit(60), 40 * T.letter_count(w["text"])))

    seen = F.transform(words, lambda w: F.struct(*[w[k].alias(k) for k in ("idx", "text", "start_ms", "end_ms", "score")], soft(w).alias("soft"), T.has_waqf(F.coalesce(w["text"], F.lit(""))).alias("pause")))

    def rules(words: Column) -> Column:
        size = F.size(words)
        first, last = F.get(words, F.lit(0))["start_ms"], F.element_at(words, -1)["end_ms"]
        edge = F.greatest(F.lit(3000), F.floor(0.25 * duration).cast("int"))
        tiny = F.size(F.filter(words, lambda w: w["end_ms"] - w["start_ms"] < w["soft"]))
        covered = F.aggregate(words, F.lit(0), lambda acc, w: acc + F.greatest(F.lit(0), w["end_ms"] - w["start_ms"]))
        coverage = covered / F.greatest(last - first, F.lit(1))
        scores = F.filter(F.transform(words, lambda w: w["score"]), lambda x: x.isNotNull())
        mean = F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(0.0), lambda acc, x: acc + x) / F.size(scores))
        whole = [
            _say((first > edge) & (duration - last > edge), "late_start"),
            _say(last < duration - edge, "early_end"),
            _say(tiny / size > limits.max_very_short_frac, "too_many_short:", tiny.cast("string"), "/", size.cast("string")),
            _say(coverage < limits.min_coverage, "low_coverage:", fixed(coverage, 3)),
        ]
        if limits.min_mean_score is not None:
            whole.append(_say(mean < limits.min_mean_score, "low_mean_score:", fixed(mean, 4)))
        count = [_say(size != F.size(expected), "word_count expected=", F.size(expected).cast("string"), " got=", size.cast("string"))] if expected is not None else []
        plain = lambda xs: F.filter(F.array(*xs), lambda x: x.isNotNull()) if xs else F.array().cast("array<string>")
        return F.concat(plain(count), _word_errors(words, expected, duration, limits), plain(whole))

    return F.when(F.size(missing) > 0, missing).when(F.size(words) == 0, F.array(F.lit("empty_words"))).otherwise(let(seen, rules))


def validate(verses: DataFrame, duration: str, words: str = "words", expected: str | None = None, required: list[str] = [], limits: Limits = Limits()) -> DataFrame:
    """``verses`` with ok and errors. No shuffle: a verse is one row."""
    found = errors(F.col(words), F.col(duration), F.col(expected) if expected else None, {k: F.col(k) for k in required}, limits)
    return verses.withColumn("errors", found).withColumn("ok", F.size("errors") == 0)
