"""Durations, ratios, levels and confidence."""

from __future__ import annotations

import contextlib
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TimingConfig:
    """Parameters of the timing analysis."""

    enabled: bool = True
    min_word_samples: int = 3
    min_chapter_words: int = 8
    min_verse_others: int = 2
    min_reciter_words: int = 8
    slightly: float = 1.4
    extended: float = 1.8
    highly: float = 2.5
    max_tatweel: int = 4

    @classmethod
    def from_mapping(cls, raw: dict | None) -> TimingConfig:
        """From the mapping of a configuration file. What it lacks keeps its default; a ratio that isn't a number is
        ignored, any other bad value is an error."""
        raw = raw or {}
        own = raw.get("timing_analysis")
        own = own if isinstance(own, dict) else {}
        switch = next((x for x in (raw.get("enable_timing_analysis"), own.get("enabled")) if x is not None), True)
        given = {name: int(own[key]) for name, key in COUNTS.items() if key in own}
        ratios = own.get("extension_ratios") or raw.get("extension_ratios")
        for name, key in RATIOS.items() if isinstance(ratios, dict) else ():
            with contextlib.suppress(TypeError, ValueError, KeyError):
                given[name] = float(ratios[key])
        return cls(enabled=bool(switch), **given)


# The keys of a configuration file.
COUNTS = {
    "min_word_samples": "min_word_baseline_samples", "min_chapter_words": "min_surah_baseline_words", "min_verse_others": "min_verse_baseline_others",
    "min_reciter_words": "min_reciter_baseline_words", "max_tatweel": "max_tatweel_per_position",
}
RATIOS = {"slightly": "slightlyExtended", "extended": "extended", "highly": "highlyExtended"}


def word_duration(start: Column, end: Column) -> Column:
    """end - start in ms where both are whole numbers and the end is later, else null."""
    a, b = start.try_cast("int"), end.try_cast("int")
    return F.when(b > a, b - a)


def duration_ratio(duration: Column, baseline: Column) -> Column:
    """Rounded to 3 places, half to even; baselines are multiples of a half.

    Numerators of whole ms stay under 2^52, so a quotient that is no tie never rounds to one: ``half_even`` in short code, which
    the JVM compiles also at the end of a long stage."""
    return F.when(baseline > 0, F.rint(2000.0 * duration.cast("long") / F.greatest((2 * baseline).cast("long"), F.lit(1))) / 1000.0)


def extension_level(ratio: Column, candidate: Column, config: TimingConfig = TimingConfig()) -> Column:
    level = F.when(ratio < config.slightly, "normal").when(ratio < config.extended, "slightlyExtended").when(ratio < config.highly, "extended").otherwise("highlyExtended")
    return F.when(ratio.isNotNull() & candidate, level)


def extension_confidence(ratio: Column, candidate: Column, score: Column, source: Column, samples: Column) -> Column:
    weight = F.when(source == "word", 1.0).when(source == "verse", 0.7).when(source == "surah", 0.5).when(source == "reciter", 0.35).otherwise(0.3)
    clamped = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (score + 8.0) / 8.0))
    value = 0.4 * clamped + 0.35 * weight + 0.25 * F.least(F.lit(1.0), samples / 8.0)
    return F.when(candidate & ratio.isNotNull() & score.isNotNull() & source.isNotNull(), F.rint(value * 1000) / 1000)


def clip_duration(samples: Column, rate: int = 16000) -> Column:
    return F.rint(samples / float(rate) * 1000).cast("int")
