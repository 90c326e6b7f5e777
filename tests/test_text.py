"""Literals for the text functions, as escapes."""

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from wordspan.functions import text as T

IYAKA = "إِيَّاكَ"
CASES = {
    IYAKA: [("ya_madd", 1, "kasra_before_shadda_ya"), ("alif_madd", 2, "fatha_alif")],
    "وَ" + IYAKA: [("ya_madd", 2, "kasra_before_shadda_ya"), ("alif_madd", 3, "fatha_alif")],
    "نَعۡبُدُ": [],
    "نَسۡتَعِينُ": [("ya_madd", 4, "kasra_ya")],
    "وَلَا": [("alif_madd", 2, "fatha_alif")],
    "عَلَيۡهِمۡ": [("ya_lin", 2, "madd_lin")],
    "أَ": [],
    "ٱ": [],
}


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


def test_madd_candidates(spark):
    rows = spark.createDataFrame([(t,) for t in CASES], "t string").select("t", T.madd_candidates(F.col("t")).alias("m")).collect()
    assert {r.t: [tuple(c) for c in r.m] for r in rows} == CASES


@pytest.mark.parametrize("text, expected", [("نس", [0]), ("اب", []), ("نا", [0]), ("دب", []), ("ا", []), ("نَسۡ", [0])])
def test_safe_boundaries(spark, text, expected):
    assert one(spark, text, T.safe_boundaries) == expected


def test_stretch_and_insertion(spark):
    assert [p.afterClusterIndex for p in one(spark, IYAKA, lambda t: T.stretch_positions(t, T.madd_candidates(t)))] == [1]
    assert one(spark, "ا", lambda t: T.stretch_positions(t, T.madd_candidates(t))) is None
    put = one(spark, IYAKA, lambda t: T.insert_tatweel(t, F.lit(1), F.lit(3)))
    assert put.count("ـ") == 3 and put.replace("ـ", "") == IYAKA and put.index("ـ") == 5
    for place in (3, 99, -1):
        assert one(spark, IYAKA, lambda t: T.insert_tatweel(t, F.lit(place), F.lit(1), strict=False)) is None
    with pytest.raises(Exception, match="between clusters"):
        one(spark, IYAKA, lambda t: T.insert_tatweel(t, F.lit(99), F.lit(1)))


def test_clusters_concatenate(spark):
    for t in [*CASES, "َِaَ", "", "abc"]:
        assert "".join(one(spark, t, T.cluster_texts)) == t
    first = one(spark, "َِa", T.clusterize)[0]
    assert (first.kind, first.base, first.marks, first.joining) == ("other", "َ", "ِ", "nonjoining")


def test_tokens(spark):
    words = lambda t: one(spark, t, T.words_of)
    assert words("قۖ ل") == ["قۖ", "ل"]
    assert words("ق ۞ ل") == ["ق", "ل"]
    assert words("١٢ ١ق ل۩ ") == ["١ق"]
    assert words("") == [] and one(spark, None, T.words_of) is None


def test_nfc(spark):
    """Equal to the Unicode database: every character of the block, every letter with one and two marks, random texts."""
    rng = random.Random(4)
    marks, letters = list(T.CLASS_OF), [*T.PARTS, *{p[0] for p in T.PARTS.values()}, "\u0628", "a", " ", ""]
    texts = [*T.BLOCK, *(b + m for b in T.BLOCK for m in T.COMPOSING), *(b + m + n for b in letters for m in marks for n in marks)]
    texts += ["".join(rng.choice(rng.choice([letters, marks, marks, T.BLOCK])) for _ in range(rng.randrange(1, 14))) for _ in range(5000)]
    texts += ["", "e\u0301 x", "\u0627\u0653\u0301", "\u2126", "\U0001F600\u0627\u0654", "\ufeff\u200f\u0627\u0654\n\u0654", None]
    bare = lambda c: F.regexp_replace(c, T.ALL_MARKS, "")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", T.nfc(F.col("t")).alias("c"), bare(T.nfc(F.col("t"), stripped=True)).alias("s")).collect()
    assert len(rows) == len(texts) and [r.t for r in rows if r.c != (r.t and unicodedata.normalize("NFC", r.t))] == []
    assert [r.t for r in rows if r.s != (r.t and re.sub(T.ALL_MARKS, "", unicodedata.normalize("NFC", r.t)))] == []


def test_normalize(spark):
    assert one(spark, "أَ‏ى", T.normalize_text) == "اي"
    assert one(spark, "َ", T.normalize_text) == "ا"
    assert one(spark, "نَۖ", lambda t: T.normalize_text(t, True)) == "نَ"
    assert one(spark, "", T.letter_count) == 1 and one(spark, "abcَ1", T.letter_count) == 4
    assert one(spark, "a", T.target_min_ms) == 120 and one(spark, "a" * 30, T.target_min_ms) == 900
