"""Some queries against their SQL on the smallest tables, and that all are registered with it."""

import math
import os
import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return "null" if v is None or (isinstance(v, float) and math.isnan(v)) else f"{v:.9g}" if isinstance(v, float) else str(v)


def test_oracles_belong_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.queries()["enrich"]


@pytest.mark.parametrize("name", ["verse_stats", "loo_median", "raw_to_ms", "chapter_ranges", "enrich", "select_strategy", "validate", "validation_rules", "stretch_positions", "merge_reports", "build_packs", "refine_timings", "refine_timings_energy", "best_window_gap", "timing_config", "verify_checksums", "publish_tree", "safe_boundaries", "merge_manifest", "read_alignments", "resume_forced", "load_texts", "reciter_dim", "chapter_timeline", "best_window"])
def test_query(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    left = sorted(tuple(plain(r[c]) for c in sorted(names)) for r in df.collect())
    at = [names.index(c) for c in sorted(names)]
    assert left == sorted(tuple(plain(r[i]) for i in at) for r in cur.fetchall())


def test_every_rule_fires(spark):
    rules = {r.rule for r in entry.queries()["validation_rules"](spark, "/root/testdata/sf0.01").collect()}
    assert rules == set("missing_field empty_words word_count index_order text_mismatch negative_ts start_ge_end end_past_duration overlap collapsed too_long large_gap huge_gap late_start early_end too_many_short low_coverage low_mean_score".split())


def test_entry_point_without_the_optional_folders(tmp_path):
    """On a copy without the subpackage: with the pipeline's file, and without."""
    root = Path(entry.__file__).parent
    shutil.copytree(root / "wordspan", tmp_path / "wordspan", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("import wordspan.llm\n")
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert 'enrich' in q and set(o) <= set(q) and not [k for k in q if k[:2] == 'op' or k == 'pipeline']"
    for _ in range(2):
        subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=os.environ | {"PYTHONPATH": str(tmp_path)}, check=True)
        (tmp_path / "corpus_pipeline.py").unlink(missing_ok=True)
