"""Trees, packs, publishing, resuming, and the checks that fail an action."""

import hashlib
import json
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from wordspan.operators import align, ranges, timing, worklist
from wordspan.sources import documents as D
from wordspan.sources import tables

WORDS = [{"index": 1, "text": "a", "startMs": 0, "endMs": 500, "score": -1.0}]


def put(root, name, text):
    target = Path(root) / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


@pytest.fixture
def tree(tmp_path):
    document = {"reciterId": "r", "surah": 1, "ayah": 1, "words": WORDS}
    put(tmp_path, "r/1/1.json", json.dumps(document, indent=2))
    put(tmp_path, "r/1/2.json", json.dumps(document | {"ayah": 2}))
    put(tmp_path, "r/1/3.json", "{broken")
    put(tmp_path, "r/1/4.json", json.dumps([document]))
    put(tmp_path, "r/1/5.json", "")
    put(tmp_path, "r/1/6.json", json.dumps(document | {"words": "none"}))
    put(tmp_path, "r/_meta.json", json.dumps(document | {"ayah": 9}))
    put(tmp_path, "r/1/notes.txt", json.dumps(document | {"ayah": 9}))
    return str(tmp_path)


def test_tree_is_read_and_compacted(spark, tree, tmp_path):
    assert sorted(r.ayah for r in D.read_alignments(spark, tree).collect()) == [1, 2]
    to = str(tmp_path / "packed.parquet")
    packed = D.compact_tree(spark, tree, to)
    assert sorted((r.path.rsplit("/", 1)[1], r.broken) for r in packed.collect()) == [("1.json", False), ("2.json", False), ("3.json", True), ("4.json", True), ("6.json", True)]
    assert sum(name.endswith(".parquet") for name in os.listdir(to)) == 1
    D.compact_tree(spark, tree, to, file_bytes=200)
    assert sum(name.endswith(".parquet") for name in os.listdir(to)) > 1


def test_packs_hold_what_their_checksum_says(spark, tmp_path):
    rows = [("r", "002", 10, "ten"), ("r", "002", 9, "nine"), ("r", "002", 9, "Nine"), ("r", "a+b c/%", 1, None), (None, "1", 1, "é"), ("r", "1", 2, "x" * 10_000), ("r", "1", 1, "first")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "k string, c string, o int, line string, value int").repartition(5)
    packs = D.build_packs(df, str(tmp_path / "p"), ["k", "c"], "o", "line").collect()
    assert {(p.k, p.c): p.n_documents for p in packs} == {("r", "002"): 3, ("r", "a+b c/%"): 1, (None, "1"): 1, ("r", "1"): 2}
    for p in packs:
        data = (tmp_path / "p" / p.file).read_bytes()
        lines = sorted((o, line or "") for k, c, o, line in rows if (k, c) == (p.k, p.c))
        assert data == "".join(line + "\n" for _, line in lines).encode()
        assert (p.bytes, p.checksum) == (len(data), hashlib.sha256(data).hexdigest())
    found = D.file_checksums(spark, str(tmp_path / "p/kind=packs"), "/(kind=packs/.*)$")
    listed = spark.createDataFrame([(p.file, p.checksum) for p in packs], "file string, checksum string")
    assert [r.status for r in D.verify_checksums(found, listed).collect()] == ["ok"] * 4
    assert D.build_packs(df.limit(0), str(tmp_path / "none"), ["k", "c"], "o", "line").count() == 0


def test_only_changed_folders_are_published(spark, tmp_path):
    to = str(tmp_path / "tree")
    rows = [("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 2, 1, "z"), ("b", 1, 1, None)]
    df = lambda rows: spark.createDataFrame(rows, "reciter_id string, surah int, ayah int, path string")
    times = lambda: {str(p.relative_to(to)): p.stat().st_mtime_ns for p in Path(to).rglob("part-*")}
    assert len(D.publish_changes(df(rows), to).collect()) == 3
    first = times()
    assert D.publish_changes(df(rows[::-1]), to).count() == 0 and times() == first
    changed = D.publish_changes(df([rows[0], ("a", 1, 2, "new"), *rows[2:], ("c", 5, 5, "v")]), to).collect()
    assert sorted((r.reciter_id, r.surah) for r in changed) == [("a", 1), ("c", 5)]
    second = times()
    kept = {k: t for k, t in first.items() if "reciter_id=a/surah=1" not in k}
    assert len(kept) == 2 and kept.items() <= second.items() and len(second) == 4
    back = spark.read.schema("ayah int, path string, reciter_id string, surah int").json(to)
    assert sorted((r.reciter_id, r.surah, r.ayah, r.path or "") for r in back.collect()) == [("a", 1, 1, "x"), ("a", 1, 2, "new"), ("a", 2, 1, "z"), ("b", 1, 1, ""), ("c", 5, 5, "v")]


def test_resume(spark):
    word = lambda a, b: [(1, "abcde", a, b, -1.0)]
    tree = [("a", False, 500, word(0, 500)), ("b", True, None, None), ("c", False, 500, word(400, 300)), ("d", True, None, None), ("d", False, 500, word(0, 500)), ("e", False, None, word(0, 500)), ("z", False, 500, word(0, 500))]
    outputs = spark.createDataFrame(tree, "k string, broken boolean, duration_ms int, words array<struct<idx:int,text:string,start_ms:int,end_ms:int,score:double>>")
    items = spark.createDataFrame([(k, ["abcde"]) for k in "abcdef"], "k string, expected array<string>")
    done = worklist.existing_outputs(outputs, items, ["k"], "duration_ms", "expected", required=["duration_ms"])
    status = lambda force: {r.k: r.status for r in worklist.resume_pending(items, done, ["k"], force=force).collect()}
    assert status(False) == {"b": "broken", "c": "invalid", "e": "invalid", "f": "missing"}
    assert status(True) == status(False) | {"a": "ok", "d": "ok"}
    other = items.withColumn("expected", F.array(F.lit("other")))
    assert set(r.status for r in worklist.existing_outputs(outputs, other, ["k"], "duration_ms", "expected").collect()) == {"broken", "invalid"}


def test_unknown_reciters_fail_the_action(spark):
    dim = worklist.reciter_dim(spark, {"a": {"everyayah_folder": "A", "bitrate_kbps": 64}})
    assert worklist.with_reciter(spark.createDataFrame([("a",)], "reciter_id string"), dim).first().folder == "A"
    with pytest.raises(Exception, match="unknown reciter b"):
        worklist.with_reciter(spark.createDataFrame([("a",), ("b",)], "reciter_id string"), dim).collect()


def test_texts_are_counted_in_the_same_plan(spark):
    entry = lambda text, ayah=1: {"sora": 1, "aya_no": ayah, "aya_text": text}
    raw = spark.createDataFrame([(1, json.dumps({"a": entry("one"), "b": entry("two")})), (2, json.dumps({"c": entry("three"), "d": entry("x", 2)})), (0, json.dumps({"e": entry("four")}))], "n int, value string")
    assert sorted((r.ayah, r.text) for r in D.load_texts(raw, least=2, record="n").collect()) == [(1, "three"), (2, "x")]
    with pytest.raises(Exception, match="fewer than 3 verses"):
        D.load_texts(raw, least=3, record="n").collect()


@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_running_total_of_one_large_group(spark, keys):
    """Most rows in one group, over many ranges."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(3000).select(F.when(F.col("id") % 100 == 0, None).when(F.col("id") % 50 == 1, "small").otherwise("large").alias("k"), F.lit(None).cast("int").alias("j"), (F.col("id") * 7919 % 3000).alias("o"), F.when(F.col("id") % 9 > 0, F.col("id") % 13 - 5).alias("v"), F.lit(0).alias("total"))
        got = ranges.running_total(rows, keys, ["o"], "v", "sum").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sums = {}
    for r in sorted(got, key=lambda r: r.o):
        sums[r.k] = sums.get(r.k, 0) + (r.v or 0)
        assert r["sum"] == sums[r.k]
    assert len(got) == 3000


def test_timeline_of_nothing(spark):
    assert timing.chapter_timeline(spark.createDataFrame([], "reciter_id string, surah int, ayah int, d int"), "d").count() == 0


@pytest.mark.parametrize("wide, block", [(1, 10), (5, 4), (7, 10), (25, 10), (50, 4096)])
def test_sliding_sums_across_blocks(spark, wide, block):
    values = {k: [(i * i + k) % 17 for i in range(n)] for k, n in ((1, 100), (2, 24), (3, 1))}
    rows = spark.createDataFrame([(k, i, v) for k, vs in values.items() for i, v in enumerate(vs)], "k int, i long, v int")
    got = sorted((r.k, r.i, r.s) for r in ranges.sliding_sum(rows, "k", "i", "v", wide, "s", block).collect())
    assert got == [(k, i, sum(vs[i : i + wide])) for k, vs in values.items() for i in range(len(vs) - wide + 1)]


def test_best_windows_take_the_first_on_ties(spark):
    rows = spark.createDataFrame([("c", i, 1.0 if i in (3, 4, 9, 10) else 0.0) for i in range(12)], "c string, frame long, rms double")
    assert [tuple(r) for r in align.best_windows(rows, "c", 2).collect()] == [("c", 3, 2.0)]


def test_columns_of_any_name(spark):
    """Words with columns that helpers might have used."""
    rows = spark.createDataFrame([("r", 1, 1, i, "a", 100 * i, 100 * i + 50 + i, -1.0, 7, 8, 9) for i in range(1, 12)], "reciter_id string, surah int, ayah int, idx int, text string, start_ms int, end_ms int, score double, w int, _n int, n int")
    for analysed in (timing.attach_analysis(rows), timing.enrich(rows)):
        assert {(r.w, r._n, r.n) for r in analysed.collect()} == {(7, 8, 9)}


def test_words_in_buckets_are_gathered_without_a_shuffle(spark):
    rows = [("r", s, a, i, "a", 100 * i, 100 * i + 40 + 7 * i, -1.0) for s in range(3) for a in range(4) for i in range(1, 9)]
    words = spark.createDataFrame(rows, "reciter_id string, surah int, ayah int, idx int, text string, start_ms int, end_ms int, score double")
    table = tables.bucketed(words, "words_in_buckets", ["reciter_id", "surah", "ayah"], 4)
    try:
        measured = timing.with_verse_measures(table)
        assert "Exchange" not in measured._jdf.queryExecution().executedPlan().toString()
        same = lambda df: sorted(map(tuple, df.collect()))
        assert same(measured) == same(timing.with_verse_measures(words))
        nested = D.nest_words(words).withColumn("words", F.transform("words", lambda w: F.struct(w["index"].alias("idx"), w["text"].alias("text"), w["startMs"].alias("start_ms"), w["endMs"].alias("end_ms"), w["score"].alias("score"))))
        flat, deep = timing.enrich(words), timing.enrich_verses(nested)
        assert sorted(map(str, deep.select(*flat.columns).collect())) == sorted(map(str, flat.collect()))
    finally:
        spark.sql("DROP TABLE words_in_buckets")


def test_lines_that_are_no_document_are_left_out(spark, tmp_path):
    put(tmp_path, "a/part.txt", json.dumps({"reciterId": "r", "ayah": 1, "words": WORDS}) + "\n{broken\n")
    assert [(r.reciterId, r.ayah) for r in D.read_lines(spark, str(tmp_path)).collect()] == [("r", 1)]
