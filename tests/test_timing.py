"""Numbers of baselines, alignment, validation and reports on small rows."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordspan.functions import measures as M
from wordspan.functions.core import half_even
from wordspan.operators import align, reports, timing, validate, worklist
from wordspan.sources import documents as D

WORDS = "reciter_id string, surah int, ayah int, idx int, text string, start_ms int, end_ms int, score double"
VERSE = "duration_ms int, words array<struct<idx:int,text:string,start_ms:int,end_ms:int,score:double>>"
IYAKA = "إِيَّاكَ"


def test_half_even(spark):
    got = spark.sql("select * from values (5, 20), (15, 20), (1, 3), (-5, 20), (0, 7) t(a, b)").select(half_even(F.col("a"), F.col("b"), 1).alias("x")).collect()
    assert [r.x for r in got] == [0.2, 0.8, 0.3, -0.2, 0.0]


def test_word_baseline_and_level(spark):
    rows = [("r", 1, v, 1, IYAKA, 100, 100 + d, -0.3) for v, d in enumerate((300, 340, 320, 1200), 1)]
    got = timing.enrich(spark.createDataFrame(rows, WORDS)).where("ayah = 4").first()
    assert (got.baseline_source, got.baseline_ms, got.ratio, got.level, got.baseline_n) == ("word", 320.0, 3.75, "highlyExtended", 3)


def test_loo_median_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(g, rng.choice([None, *range(9)])) for g in range(40) for _ in range(rng.randrange(1, 12))] + [(None, 4)]
    got = timing.loo_median(spark.createDataFrame(rows, "g int, v int"), ["g"], "v", "loo").collect()

    def expected(g, v):
        others = [x for h, x in rows if h == g and x is not None]
        if g is None or v is None or len(others) < 2:
            return None
        others.remove(v)
        return float(statistics.median(others))

    assert len(got) == len(rows) and all(r.loo == expected(r.g, r.v) for r in got)


def test_measures(spark):
    row = spark.range(1).select(
        M.word_duration(F.lit(800), F.lit(1930)).alias("a"), M.word_duration(F.lit(5), F.lit(5)).alias("b"), M.word_duration(F.lit("x"), F.lit("9")).alias("c"),
        M.duration_ratio(F.lit(900), F.lit(190.0)).alias("d"), M.duration_ratio(F.lit(9), F.lit(0.0)).alias("e"),
        M.extension_level(F.lit(3.0), F.lit(False)).alias("f"), M.extension_confidence(F.lit(2.0), F.lit(True), F.lit(-0.3), F.lit("word"), F.lit(10)).alias("g"),
    ).first()
    assert tuple(row) == (1130, None, None, 4.737, None, None, 0.985)


def test_config():
    read = M.TimingConfig.from_mapping
    c = read({"timing_analysis": {"extension_ratios": {"extended": "x", "highlyExtended": 3, "slightlyExtended": "1.2"}, "min_word_baseline_samples": 5, "min_verse_baseline_others": "4", "min_reciter_baseline_words": 9}})
    assert (c.slightly, c.extended, c.highly, c.min_word_samples, c.min_verse_others, c.min_reciter_words, c.enabled) == (1.2, 1.8, 3.0, 5, 4, 9, True)
    off = read({"enable_timing_analysis": False, "timing_analysis": {"enabled": True, "max_tatweel_per_position": 2}})
    assert (off.enabled, off.max_tatweel) == (False, 2)
    assert not read({"timing_analysis": {"enabled": False}}).enabled and read({}) == read(None) == M.TimingConfig() == read({"timing_analysis": 7})
    assert read({"extension_ratios": {"highlyExtended": 9}}).highly == 9


def test_config_changes_levels(spark):
    rows = [("r", 1, v, 1, IYAKA, 100, 100 + d, -0.3) for v, d in enumerate((300, 340, 320, 1200), 1)]
    config = M.TimingConfig.from_mapping({"timing_analysis": {"extension_ratios": {"highlyExtended": 4}}})
    assert timing.enrich(spark.createDataFrame(rows, WORDS), config).where("ayah = 4").first().level == "extended"


def test_statistics_of_verse_and_chapter(spark):
    rows = [("r", 1, 1, i + 1, "ab", 0, d, None) for i, d in enumerate((300, 310, 320, 330, 5000))] + [("r", 1, 2, i + 1, "cd", 0, d, None) for i, d in enumerate((100, 200, 301))] + [("r", 1, 3, 1, "x", 5, 5, None)]
    got = {(r.ayah, r.idx): r for r in timing.enrich(spark.createDataFrame(rows, WORDS)).collect()}
    assert (got[1, 1].verse_mean, got[1, 1].verse_median, got[2, 3].verse_mean, got[2, 3].verse_median) == (1252.0, 320.0, 200.3, 200.0)
    assert (got[1, 1].chapter_mean, got[1, 1].chapter_median) == (857.6, 305.5) and got[3, 1].verse_mean is None and got[3, 1].chapter_median == 305.5
    again = timing.attach_analysis(timing.enrich(spark.createDataFrame(rows, WORDS)))
    assert "chapter_mean" not in again.columns and again.where("timing_enabled").count() == len(rows)
    assert {r.baseline_source for r in again.where("ayah = 2").collect()} == {"verse"}


def test_disabled_is_no_op(spark):
    rows = spark.createDataFrame([("r", 1, 1, 1, "a", 0, 9, None)], WORDS)
    off = M.TimingConfig(enabled=False)
    assert timing.enrich(rows, off) is rows and timing.attach_analysis(rows, off) is rows


def repair(verses, energies=None):
    """verses: [([(start, end, need, pause)], duration)]"""
    flat = [w for words, _ in verses for w in words]
    column = lambda k, kind: np.array([w[k] for w in flat], dtype=kind)
    s, e = align.repaired(column(0, np.int64), column(1, np.int64), column(2, np.int64), column(3, bool), np.array([len(w) for w, _ in verses]), np.array([d for _, d in verses]), energies)
    return list(zip(s.tolist(), e.tolist()))


def test_collapsed_word_gets_room():
    a, b, c = repair([([(7740, 8100, 150, False), (9260, 9320, 160, False), (10060, 10320, 160, False)], 12000)])
    assert b[1] - b[0] >= 120 and b[0] >= a[1] - 1 and b[1] <= c[0] + 1 and all(x < y for x, y in (a, b, c))


def slow_repair(words, duration, energy):
    """The four passes, a word at a time, from the rules."""
    spans, last = [[s, e] for s, e, _, _ in words], len(words) - 1
    need, pause = [w[2] for w in words], [w[3] for w in words]
    sides = lambda i: (spans[i - 1][1] if i else 0, spans[i + 1][0] if i < last else duration)
    for i, (s, e) in enumerate(spans):
        (left, right), own = sides(i), e - s
        if own < 100 or own < need[i] / 2:
            if s - left + right - e + own < need[i]:
                a, b = left, right
            elif right - e >= s - left:
                a, b = s, right
            else:
                a, b = left, e
            if b - a >= 40:
                want = min(need[i], b - a)
                if energy is None:
                    lo = max(a, (a + b) // 2 - want // 2)
                    hi = min(b, lo + want)
                    lo = max(a, hi - want)
                else:
                    lo, hi = slow_window(energy, a, b, want)
                spans[i] = [lo, max(lo + 1, hi)]
    for i, span in enumerate(spans):
        lack, (left, right) = need[i] - (span[1] - span[0]), sides(i)
        if lack > 0:
            before, after = span[0] - left, right - span[1]
            grown = min(after, lack - min(before, lack // 2))
            spans[i] = [span[0] - min(before, lack - grown), span[1] + grown]
    for i in range(last):
        gap = spans[i + 1][0] - spans[i][1]
        if gap > 250 and not pause[i]:
            spans[i][1] = spans[i + 1][0] = spans[i][1] + gap // 2
        elif gap > 1200:
            spans[i][1] += (gap - 900) // 2
            spans[i + 1][0] -= gap - 900 - (gap - 900) // 2
    spans[0][0] = max(0, spans[0][0])
    for i in range(last):
        spans[i][1] = max(spans[i][1], spans[i][0] + 1)
        if spans[i][1] > spans[i + 1][0]:
            spans[i + 1][0] = spans[i][1] = (spans[i][1] + spans[i + 1][0]) // 2
        spans[i][1] = max(spans[i][1], spans[i][0] + 1)
    end = max(spans[last][0] + 1, min(duration, spans[last][1]))
    spans[last][1] = duration if 0 < duration - end < 800 else end
    return [tuple(x) for x in spans]


def slow_window(energy, a, b, want):
    a, frames = max(0, a), len(energy)
    b = max(a + 1, b)
    want = min(want, b - a)
    if want < 40:
        return a, max(a + 1, (a + b) // 2)
    first = min(a // 20, frames - 1)
    end, wide = max(first + 1, min(b // 20, frames)), max(1, want // 20)
    if end - first <= wide:
        return a, a + want
    at = max(range(first, end - wide + 1), key=lambda i: (sum(energy[i : i + wide]), -i)) * 20
    at = b - want if at + want > b else at
    return max(a, at), min(b, max(max(a, at) + 1, at + want))


@pytest.mark.parametrize("loud", [False, True])
def test_repair_against_a_word_at_a_time(loud):
    rng = random.Random(1)
    verses, energies = [], []
    for _ in range(600):
        t, words = 0, []
        for _ in range(rng.randrange(1, 30)):
            t += rng.choice([0, 0, 0, 300, 1300, 2000, -200, 50])
            own = rng.choice([30, 60, 5, 150, 400, 900, -5])
            words.append((t, t + own, rng.choice([120, 220, 550, 900]), rng.random() < 0.3))
            t += max(own, 0)
        duration = max(1, t + rng.choice([0, 300, 900, -400]))
        verses.append((words, duration))
        energies.append([float(rng.randrange(5)) for _ in range(max(1, duration // 20 + rng.choice([-2, 0, 3])))])
    expected = [x for (words, duration), e in zip(verses, energies) for x in slow_repair(words, duration, e if loud else None)]
    assert repair(verses, energies if loud else None) == expected


def test_refine_in_spark(spark):
    rows = spark.createDataFrame([(12000, [(1, "abcd", 7740, 8100, None), (2, "ab", 9260, 9320, -1.0)])], VERSE)
    words = align.refine_timings(rows, "duration_ms").first().words
    assert [w.idx for w in words] == [1, 2] and words[1].end_ms - words[1].start_ms >= 120


def test_refine_leaves_empty_and_silent_verses(spark):
    rows = spark.createDataFrame([(0, [(1, "abcd", 5, 6, None)]), (10, []), (None, [(1, "a", 1, 2, None)]), (500, None)], VERSE)
    assert [r.words for r in align.refine_timings(rows, "duration_ms").collect()] == [r.words for r in rows.collect()]


def test_best_window(spark):
    energy = [5.0 if 40 <= i < 46 else 0.0 for i in range(100)]
    rows = [(0, 2000, 120, energy), (10, 40, 200, energy), (-5, 30, 40, energy), (805, 1000, 100, energy), (0, 100, 60, None)]
    got = align.best_window(spark.createDataFrame(rows, "lo int, hi int, want int, rms array<double>"), "lo", "hi", "want", "rms").collect()
    assert [(r.start_ms, r.end_ms) for r in got] == [slow_window(x or [0.0], a, b, w) for a, b, w, x in rows]
    assert (got[0].start_ms, got[0].end_ms) == (800, 920) and (got[1].start_ms, got[1].end_ms) == (10, 25)


def test_quality_prefers_coverage(spark):
    rows = [(10000, [(1, "a", 0, 50, None), (2, "b", 5000, 5050, None), (3, "c", 9900, 10000, None)]), (10000, [(1, "a", 0, 3000, None), (2, "b", 3000, 6500, None), (3, "c", 6500, 10000, None)])]
    bad, good = [r.q for r in spark.createDataFrame(rows, VERSE).select(align.timing_quality(F.col("words"), F.col("duration_ms")).alias("q")).collect()]
    assert good > bad


def test_modes(spark):
    names = lambda mode: [r.strategy for r in align.strategy_catalog(spark, mode).orderBy("rank").collect()]
    assert names("fast")[0] == names("balanced")[0] == "mms_roman_edges" and "xlsr_diac_edges" not in names("fast") and "xlsr_diac_edges" in names("balanced")
    assert {r.mode: r.threshold for r in align.strategy_catalog(spark).collect()} == {"fast": 28.0, "balanced": 32.0, "max": None}


def test_strategies(spark):
    with pytest.raises(ValueError, match="unknown mode"):
        align.strategy_catalog(spark, "none")
    rows = [(1, 1, "a", 31.9, None), (1, 2, "b", 32.0, None), (1, 3, "c", 40.0, None), (2, 1, "a", None, "x"), (2, 2, "b", None, "y"), (3, 1, "a", 5.0, None), (3, 2, "b", 5.0, None)]
    tries = spark.createDataFrame(rows, "v int, rank int, strategy string, quality double, error string").withColumn("threshold", F.lit(32.0))
    got = {r.v: (r.strategy, r.tried, r.early_exit, r.failure) for r in align.select_strategy(tries, ["v"]).collect()}
    assert got == {1: ("b", 2, True, None), 2: (None, 2, False, "all_strategies_failed:x;y"), 3: ("a", 2, False, None)}


def errors(spark, duration, spans, texts=None, **limits):
    words = [(i + 1, (texts or ["abcde"] * len(spans))[i], a, b, -1.0) for i, (a, b) in enumerate(spans)]
    row = spark.createDataFrame([(duration, words)], VERSE)
    return validate.validate(row, "duration_ms", limits=validate.Limits(**limits)).first().errors


@pytest.mark.parametrize(
    "duration, spans, bad",
    [
        (5000, [(100, 800), (900, 1500), (1600, 2200), (2300, 4800)], []),
        (13244, [(7340, 7680), (7800, 8460), (8600, 9660), (9760, 13244)], []),
        (13244, [(7340, 7680), (7800, 8460), (8600, 9000)], ["late_start", "early_end"]),
        (1000, [(0, 1050)], []),
        (1000, [(0, 1051)], ["end_past_duration at 1: 1051>1000"]),
        (1000, [(0, 500), (470, 1000)], []),
        (1000, [(0, 500), (469, 1000)], ["overlap at 2"]),
        (4000, [(0, 1200), (2800, 4000)], []),
        (4001, [(0, 1200), (2801, 4001)], ["large_gap before 2: 1601ms"]),
        (1000, [(0, 0)], ["start_ge_end at 1", "collapsed at 1: 0ms", "too_many_short:1/1", "low_coverage:0.000"]),
        (100, [], ["empty_words"]),
    ],
)
def test_validation(spark, duration, spans, bad):
    assert errors(spark, duration, spans) == bad


def test_index_negative_and_missing(spark):
    rows = spark.createDataFrame([(900, [(2, "abc", -40, 400, None), (2, "abc", 420, 900, None)]), (None, [(1, "a", 0, 9, None)]), (9, None)], VERSE)
    got = [r.errors for r in validate.validate(rows, "duration_ms", required=["duration_ms"]).collect()]
    assert got == [["index_order at 0: got 2", "negative_ts at 2", "overlap at 2"], ["missing_field:duration_ms"], ["missing_field:words"]]


def test_pause_allows_gaps(spark):
    assert errors(spark, 5200, [(0, 1200), (4000, 5200)], ["abۖ", "ab"], min_coverage=0.0) == []
    assert errors(spark, 5201, [(0, 1200), (4001, 5201)], ["abۖ", "ab"], min_coverage=0.0) == ["huge_gap before 2: 2801ms"]


def test_merge_and_gate(spark):
    rows = [("a", 7, 6, 0, 1), ("b", 5, 5, 0, 0), ("c", 100, None, 95, 5)]
    merged = reports.failure_gate(reports.merge_reports(spark.createDataFrame(rows, "k string, attempted int, skipped int, passed int, failed int"), ["k"]))
    got = {r.k: (r.processed, round(r.fail_rate, 4), r.over_gate) for r in merged.collect()}
    assert got == {"a": (1, round(1 / 7, 4), True), "b": (0, 0.0, False), "c": (100, 0.05, False)}


def test_work(spark):
    specs = spark.createDataFrame([("1,2,112-114, ,0-1,900",)], "s string")
    assert sorted(r.chapter for r in worklist.chapter_ranges(specs, "s").collect()) == [1, 2, 112, 113, 114]
    with pytest.raises(ValueError):
        worklist.shard_slice(specs, 3, 3)


def test_paths_and_documents(spark, tmp_path):
    paths = {"a/2/255.json": (2, 255), "002/002255.json": (2, 2255), "x/002255.json": (2, 255), "x/2_7.json": (2, 7), "x/abc.json": None}
    got = spark.createDataFrame([(p,) for p in paths], "p string").select("p", D.parse_alignment_path(F.col("p")).alias("k")).collect()
    assert {r.p: tuple(r.k) if r.k else None for r in got} == paths
    (tmp_path / "1").mkdir()
    (tmp_path / "1/1.json").write_text('{"reciterId": "r", "surah": 1, "ayah": 1, "words": [{"index": 1, "text": "a", "startMs": 0, "endMs": 5}]}')
    (tmp_path / "1/2.json").write_text("{broken")
    (tmp_path / "1/_meta.json").write_text('{"reciterId": "no"}')
    docs = D.read_alignments(spark, str(tmp_path))
    assert [(r.reciterId, r.ayah) for r in docs.collect()] == [("r", 1)]
    assert D.explode_words(docs).first().end_ms == 5
    sums = D.file_checksums(spark, str(tmp_path / "1"))
    assert {r.status for r in D.verify_checksums(sums, sums).collect()} == {"ok"}
