"""Messages with rounded figures, and what larger tables showed."""

import random
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from wordspan.functions import text as T
from wordspan.functions.core import fixed
from wordspan.operators import align, reports, validate
from wordspan.sources import documents as D
from wordspan.sources import tables

VERSE = "reciter_id string, ayah int, duration_ms int, words array<struct<idx:int,text:string,start_ms:int,end_ms:int,score:double>>"
#: Mean score -26.09875: binary a little above it, so four decimals are -26.0987. Coverage 125 / 400 = 0.3125, a tie: 0.312.
TIES = [("r", 4493, 1000, [(1, "abcd", 0, 100, -26.09875), (2, "abcd", 375, 400, -26.09875)])]
REASON = "low_coverage:0.312;low_mean_score:-26.0987"


def _failed(spark):
    limits = validate.Limits(max_very_short_frac=1.0, min_word_ms=0)
    rows = validate.validate(spark.createDataFrame(TIES, VERSE), "duration_ms", limits=limits)
    return rows.withColumns({"status": F.when(F.col("ok"), "passed").otherwise("failed"), "error": F.lit(None).cast("string"), "errors": F.filter("errors", lambda e: e.startswith("low"))})


def test_figures_are_rounded_as_c_and_python_do(spark):
    rng = random.Random(3)
    ties = [(k / 1000 + 0.0005,) for k in range(0, 500)] + [(-(2500 + rng.randrange(900) + rng.randrange(64) / 64) / 100,) for _ in range(2000)]
    rows = spark.createDataFrame([(None,), (0.0,), (0.3125,), (0.4125,), (-25.03125,), *ties, *((rng.random(),) for _ in range(500))], "x double")
    got = rows.select("x", fixed(F.col("x"), 3).alias("a"), fixed(F.col("x"), 4).alias("b")).collect()
    assert [tuple(r) for r in got if r.x is not None and (r.a, r.b) != (f"{r.x:.3f}", f"{r.x:.4f}")] == []
    assert [tuple(r) for r in got if r.x is None] == [(None, None, None)]


def test_messages_of_validation_at_ties(spark):
    assert ";".join(_failed(spark).first().errors) == REASON


def test_reasons_of_failures_at_ties(spark):
    assert [tuple(r) for r in reports.failure_rows(_failed(spark), ["ayah"]).collect()] == [(4493, REASON)]


def test_csv_of_failures_at_ties(spark, tmp_path):
    rows = reports.failure_rows(_failed(spark), ["reciter_id", "ayah"])
    reports.failures_csv(rows.select(F.col("reciter_id").alias("surah"), "ayah", "reason"), str(tmp_path / "csv"))
    back = spark.read.option("header", True).schema("surah string, ayah string, reason string").csv(str(tmp_path / "csv"))
    assert [tuple(r) for r in back.collect()] == [("r", "4493", REASON)]


#: The JVM interprets longer methods, which made these queries' last stages two to three times as long.
COMPILED = 8000
SHORT = ["enrich", "timing_config", "extension_level", "extension_confidence", "word_baseline", "resolve_baseline", "attach_analysis"]


@pytest.mark.parametrize("name", SHORT)
def test_stages_are_compiled_by_the_jvm(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
        made = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(plan)
        assert max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size())) < COMPILED
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


#: Verses are nested in these, and need no gathering.
NESTED = ["explode_words", "join_normalized", "extension_level", "extension_confidence", "timing_config"]


@pytest.mark.parametrize("name", NESTED)
def test_nested_verses_are_not_gathered_anew(spark, name):
    plan = entry.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan and "Join" not in plan


@pytest.mark.parametrize("keep", [False, True])
def test_words_of_an_array_are_normalized_as_one_by_one(spark, keep):
    """Covered and other texts side by side, marks first or alone, words that are left empty, odd spaces."""
    words = ["\u0627\u0653", "\u0653\u0627", "\u06d6", "\u200f", "e\u0301", "\u0301e", "\u0628\u0651\u064e", "\u0628\u064e\u0651", "\u0648\u0654", "\u00a0x\u00a0", "abc", "\u0623\u0629", "\u1100\u1161", "\u064a\u0654\u064e"]
    rows = [(i, words[i % 5 :] + words[: i % 5]) for i in range(5)] + [(5, []), (6, ["abc"]), (7, ["\u0301", "\u0653"])]
    df = spark.createDataFrame(rows, "i int, w array<string>")
    got = {r.i: r.n for r in df.select("i", T.normalize_words(F.col("w"), keep).alias("n")).collect()}
    one = spark.createDataFrame([(w,) for w in {x for _, ws in rows for x in ws}], "w string").select("w", T.normalize_text(F.col("w"), keep).alias("n"))
    plain = {r.w: r.n for r in one.collect()}
    assert got == {i: [plain[w] for w in ws] for i, ws in rows}


def test_repair_takes_words_in_bounded_parts():
    sizes = np.array([5, 0, 300, 10, 90, 1, 1, 1, 99, 250])
    live = np.flatnonzero(sizes)
    parts = align.slices(live, sizes, 100)
    assert np.concatenate(parts).tolist() == live.tolist() and len(parts) > 3
    assert all(len(p) == 1 or sizes[p].sum() <= 100 + sizes[p].max() for p in parts) and align.slices(live[:0], sizes) == []


def test_alignments_are_written_compressed_and_read_back(spark, tmp_path):
    rows = spark.createDataFrame([("r", "1", '{"ayah":1}'), ("r", "2", '{"ayah":2}')], "reciter_id string, surah string, json string")
    D.write_alignments(rows, str(tmp_path / "t"), compression="gzip")
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "t")).collect()) == ['{"ayah":1}', '{"ayah":2}']
    assert {p.suffix for p in (tmp_path / "t").rglob("part-*")} == {".gz"}


def test_small_files_of_a_tree_share_tasks(spark, tmp_path):
    for i in range(100):
        (tmp_path / f"t/{i}").mkdir(parents=True)
        (tmp_path / f"t/{i}/1.json").write_text('{"ayah": %d}' % i)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4m")  # a file a task, as Spark plans them
    try:
        rows = D.read_tree(spark, str(tmp_path / "t"), "ayah int")
        assert rows.rdd.getNumPartitions() <= 4 * spark.sparkContext.defaultParallelism < 100
        assert sorted(r.ayah for r in rows.collect()) == list(range(100))
        packed = D.compact_tree(spark, str(tmp_path / "t"), str(tmp_path / "p"), "ayah int")
        assert sorted(r.ayah for r in packed.collect()) == list(range(100)) and len(list((tmp_path / "p").glob("*.parquet"))) == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_tables_between_steps_leave_no_shuffle_files(spark):
    """As the verses of ``enrich_words``, whose words are all shuffled before they are written."""
    here = Path(spark.conf.get("spark.local.dir"))
    files = lambda: {p for p in here.rglob("shuffle_*.data")}
    before = files()
    back = tables.written(spark.range(10_000).repartition(7, "id"))
    assert back.count() == 10_000 and not [p for p in files() - before if p.stat().st_size > 1000]
