"""Text of vocalized words: tokens, keys, grapheme clusters, elongation candidates, stretch points."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .core import let

# Characters and classes of the script.
TATWEEL = "\u0640"
HIZB, SAJDA = "\u06DE", "\u06E9"
WAQF = "[\u06D6-\u06DC]"
COMBINING = "\u0610-\u061A\u064B-\u065F\u0670\u06D6-\u06DC\u06DF-\u06E8\u06EA-\u06ED"
RIGHT_JOINING = "\u0622\u0623\u0624\u0625\u0627\u0629\u062F\u0630\u0631\u0632\u0648\u0649\u0671\u06C0\u06D2\u06D3"
KEY_STRIP = "\u06DE\u06E9\u0640\u06D6\u06D7\u06D8\u06D9\u06DA\u06DB\u06DC"
ALL_MARKS = "[\u06D6-\u06ED\u064B-\u065F\u0670\u0640]"
PAUSE_MARKS = "[\u06D6-\u06ED]"
LETTER_FORMS = ("\u0623\u0625\u0622\u0671\u0649\u0629", "\u0627\u0627\u0627\u0627\u064A\u0647")
ALEF, ALEF_MADDA, ALEF_MAKSURA, WAW, YEH, HAMZA = "\u0627", "\u0622", "\u0649", "\u0648", "\u064A", "\u0621"
FATHA, DAMMA, KASRA, SHADDA, SUKUN, SMALL_SUKUN = "\u064E", "\u064F", "\u0650", "\u0651", "\u0652", "\u06E1"
DAGGER_ALEF, MADDAH, SMALL_MADDA, SMALL_WAW, SMALL_YEH = "\u0670", "\u0653", "\u06E4", "\u06E5", "\u06E6"

CLUSTER = f"[^{COMBINING}][{COMBINING}]*|[{COMBINING}]+"


def words_of(text: Column) -> Column:
    """The words of a verse in order: no empty tokens, none with a section mark, none of digits only."""
    return F.filter(F.split(text, r"(?U)\s+"), lambda w: (w != "") & ~w.contains(HIZB) & ~w.contains(SAJDA) & ~w.rlike("^[\u0660-\u0669]+$"))


def count_words(text: Column) -> Column:
    return F.size(words_of(text))


#: By the Unicode database: combining class (as a character) of each mark of the Arabic block, and its composed letters.
BLOCK = [chr(c) for c in range(0x600, 0x700)]
CLASS_OF = {c: chr(unicodedata.combining(c)) for c in BLOCK if unicodedata.combining(c)}
PARTS = {c: unicodedata.normalize("NFD", c) for c in BLOCK if unicodedata.normalize("NFD", c) != c}
MARKS = "".join(CLASS_OF)
COMPOSING = "".join(sorted({parts[1] for parts in PARTS.values()}))
#: Characters that composition leaves alone, but for the block's own pairs: ASCII, the block, joiners and direction marks.
COVERED = "\\x{00}-\\x{7F}\\x{A0}\u0600-\u06FF\u200B-\u200F\u202A-\u202E\u2060-\u2064\uFEFF"


def _composed(text: Column) -> Column:
    """NFC of a covered text: letters taken apart, marks of a letter sorted by class, then pairs put together unless a
    mark of the same class or a higher one stands between."""
    apart = text
    for letter, parts in PARTS.items():
        apart = F.replace(apart, F.lit(letter), F.lit(parts))
    pairs = F.create_map(*[F.lit(x) for letter, parts in PARTS.items() for x in (parts, letter)])
    level = lambda mark: F.translate(mark, MARKS, "".join(CLASS_OF.values()))

    def cluster(c: Column) -> Column:
        bare = F.substring(c, 1, 1).rlike(f"[{MARKS}]")
        base, marks = F.when(bare, "").otherwise(F.substring(c, 1, 1)), F.when(bare, c).otherwise(F.substring(c, 2, 1 << 30))
        ranked = F.array_sort(F.transform(F.filter(F.split(marks, ""), lambda m: m != ""), lambda m, i: F.struct(level(m).alias("level"), i.alias("i"), m.alias("mark"))))

        def step(acc: Column, m: Column) -> Column:
            whole = F.when((acc["tail"] == "") | (acc["level"] < m["level"]), F.try_element_at(pairs, F.concat(acc["base"], m["mark"])))
            left = whole.isNull()
            return F.struct(F.coalesce(whole, acc["base"]).alias("base"), F.when(left, F.concat(acc["tail"], m["mark"])).otherwise(acc["tail"]).alias("tail"), F.when(left, m["level"]).otherwise(acc["level"]).alias("level"))

        start = F.struct(base.alias("base"), F.lit("").alias("tail"), F.lit("").alias("level"))
        return F.aggregate(ranked, start, step, lambda acc: F.concat(acc["base"], acc["tail"]))

    return F.array_join(F.transform(F.regexp_extract_all(apart, F.lit(f"[^{MARKS}][{MARKS}]*|[{MARKS}]+"), F.lit(0)), cluster), "")


def nfc(text: Column, stripped: bool = False) -> Column:
    """Unicode NFC. Texts of ASCII and the Arabic block stay in the JVM, and those without two marks in a row or a
    composing mark are returned as they are; only other texts are sent to an Arrow helper, which gets nulls for the rest.
    Where ALL_MARKS are ``stripped`` afterwards, their order doesn't matter: composing marks and marks that stay do."""

    other = text.rlike(f"[^{COVERED}]")
    return F.when(other, _nfc_elsewhere(F.when(other, text))).when(text.rlike(_moves(stripped)), _composed(text)).otherwise(text)


def _nfc_elsewhere(text: Column) -> Column:
    @F.pandas_udf("string")
    def elsewhere(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))

    return elsewhere(text)


def _moves(stripped: bool) -> str:
    """What a covered text must have for its composition to differ."""
    return f"[{COMPOSING}\u0610-\u061A]" if stripped else f"[{MARKS}]{{2}}|[{COMPOSING}]|[{''.join(PARTS)}][{MARKS}]"


def normalize_text(text: Column, keep_diacritics: bool = False) -> Column:
    """A word as aligners want it; what is left empty becomes an alef."""
    return _plain(nfc(text, not keep_diacritics), keep_diacritics)


def _plain(composed: Column, keep_diacritics: bool) -> Column:
    out = F.regexp_replace(composed, r"\p{Cf}", "")
    out = F.regexp_replace(out, PAUSE_MARKS if keep_diacritics else ALL_MARKS, "")
    out = F.regexp_replace(F.translate(out, *LETTER_FORMS), r"(?U)^\s+|\s+$", "")
    return F.regexp_replace(out, r"\A\z", ALEF)


def normalize_words(words: Column, keep_diacritics: bool = False) -> Column:
    """``normalize_text`` of each word of an array; words hold no line feeds. The Arrow helper gets them as one text with a line feed
    between, which composes with nothing, and only where some are uncovered."""
    joined = F.array_join(words, "\n")
    other = joined.rlike(f"[^{COVERED}]")
    parts = F.split(F.when(other, _nfc_elsewhere(F.when(other, joined))).otherwise(joined), "\n")

    def of(w: Column) -> Column:
        return _plain(F.when(w.rlike(f"[^{COVERED}]") | ~w.rlike(_moves(not keep_diacritics)), w).otherwise(_composed(w)), keep_diacritics)

    return F.when(F.size(words) > 0, F.transform(parts, of)).otherwise(words)


def join_normalized(words: Column) -> Column:
    return F.array_join(words, " ")


def letter_count(text: Column) -> Column:
    return F.greatest(F.lit(1), F.length(F.regexp_replace(text, "[^\\p{L}\u0600-\u06FF]", "")))


def target_min_ms(text: Column) -> Column:
    return F.least(F.lit(900), F.greatest(F.lit(120), 55 * letter_count(text)))


def has_waqf(text: Column) -> Column:
    return text.rlike(WAQF)


def baseline_key(text: Column) -> Column:
    return F.translate(text, KEY_STRIP, "")


def cluster_texts(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CLUSTER), F.lit(0))


def cluster_kind(cluster: Column) -> Column:
    base = F.substring(cluster, 1, 1)
    return F.when(base.rlike(f"[{COMBINING}]"), "other").when(base == TATWEEL, "tatweel").when(base.rlike("[\u0600-\u06FF]"), "base").otherwise("other")


def joining_type(cluster: Column) -> Column:
    """Of a cluster's base letter; marks without a base don't join."""
    base = F.substring(cluster, 1, 1)
    return (
        F.when(base.rlike(f"[{COMBINING}]") | (base == HAMZA), "nonjoining")
        .when(base == TATWEEL, "dual").when(base.rlike(f"[{RIGHT_JOINING}]"), "right").when(base.rlike("[\u0620-\u06FF]"), "dual").otherwise("nonjoining")
    )


def clusterize(text: Column) -> Column:
    """array<struct<index, kind, base, text, marks, joining>>, index from 0."""
    return F.transform(cluster_texts(text), lambda c, i: F.struct(i.alias("index"), cluster_kind(c).alias("kind"), F.substring(c, 1, 1).alias("base"), c.alias("text"), F.substring(c, F.lit(2), F.length(c)).alias("marks"), joining_type(c).alias("joining")))


def madd_candidates(text: Column) -> Column:
    """array<struct<type, clusterIndex, reason>>: where a word may be drawn out. Of the rules that hold
    for a cluster, the first one of each type gives the reason."""

    def of_cluster(all_: Column, c: Column, i: Column) -> Column:
        before = F.coalesce(F.get(all_, i - 1)["marks"], F.lit(""))
        own, base = c["marks"], c["base"]
        vowel = own.rlike(f"[\u064B-{KASRA}]")
        rest = own.rlike(f"[{SUKUN}{SMALL_SUKUN}]") & ~own.contains(SHADDA)
        lin = lambda letter, mark: (base == letter) & ~before.contains(mark) & before.contains(FATHA) & rest
        drawn = lambda letter, mark: (base == letter) & before.contains(mark)
        rules = [
            ("alif_madd", [(base == ALEF_MADDA, "alef_madda"), (own.contains(DAGGER_ALEF), "dagger_alif"), (own.rlike(f"[{MADDAH}{SMALL_MADDA}]"), "maddah"),
                           ((base == ALEF) & before.contains(FATHA), "fatha_alif"), ((base == ALEF_MAKSURA) & before.contains(FATHA), "fatha_alef_maksura")]),
            ("waw_madd", [(own.contains(SMALL_WAW), "sila_waw"), (drawn(WAW, DAMMA) & own.contains(SHADDA), "damma_before_shadda_waw"), (drawn(WAW, DAMMA) & ~vowel, "damma_waw")]),
            ("ya_madd", [(own.contains(SMALL_YEH), "sila_yeh"), (drawn(YEH, KASRA) & own.contains(SHADDA), "kasra_before_shadda_ya"), (drawn(YEH, KASRA) & ~vowel, "kasra_ya")]),
            ("ya_lin", [(lin(YEH, KASRA), "madd_lin")]),
            ("waw_lin", [(lin(WAW, DAMMA), "madd_lin")]),
        ]
        found = []
        for kind, cases in rules:
            reason = F.when(F.lit(False), "")
            for condition, name in cases:
                reason = reason.when(condition, name)
            found.append(F.struct(F.lit(kind).alias("type"), i.alias("clusterIndex"), reason.alias("reason")))
        return F.when(c["kind"] == "base", F.filter(F.array(*found), lambda x: x["reason"].isNotNull()))

    return let(clusterize(text), lambda all_: F.flatten(F.filter(F.transform(all_, lambda c, i: of_cluster(all_, c, i)), lambda x: x.isNotNull())))


def _boundaries(clusters: Column) -> Column:
    def safe(i: Column) -> Column:
        a, b = clusters[i], clusters[i + 1]
        return a["kind"].isin("base", "tatweel") & (a["joining"] == "dual") & b["kind"].isin("base", "tatweel") & b["joining"].isin("dual", "right")

    n = F.size(clusters)
    return F.when(n > 1, F.filter(F.sequence(F.lit(0), F.greatest(n - 2, F.lit(0))), safe)).otherwise(F.array().cast("array<int>"))


def safe_boundaries(text: Column) -> Column:
    """Indexes of clusters after which the word may be stretched."""
    return let(clusterize(text), _boundaries)


def stretch_positions(text: Column, candidates: Column, most: int = 4) -> Column:
    """array<struct<priority, afterClusterIndex, maxRecommended>> by priority, then index; null if empty."""

    def of(x: Column) -> Column:
        clusters, drawn = x["clusters"], x["drawn"]

        def rank(i: Column) -> Column:
            near = F.array_contains(drawn, i) | F.array_contains(drawn, i + 1)
            return F.when(near, 1).when((clusters[i]["joining"] == "dual") & (clusters[i + 1]["joining"] == "dual"), 2).otherwise(3)

        out = F.array_sort(F.transform(_boundaries(clusters), lambda i: F.struct(rank(i).alias("priority"), i.alias("afterClusterIndex"), F.lit(most).alias("maxRecommended"))))
        return F.when(F.size(out) > 0, out)

    return let(F.struct(clusterize(text).alias("clusters"), F.transform(candidates, lambda c: c["clusterIndex"]).alias("drawn")), of)


def insert_tatweel(text: Column, after: Column, count: Column, strict: bool = True) -> Column:
    """Tatweels after a cluster; a place that isn't between clusters, or a count under 1, is an error, or null if not strict."""

    def of(c: Column) -> Column:
        done = F.concat(F.array_join(F.slice(c, F.lit(1), after + 1), ""), F.repeat(F.lit(TATWEEL), count), F.array_join(F.slice(c, after + 2, F.greatest(F.size(c), F.lit(1))), ""))
        wrong = F.raise_error(F.lit("not a place between clusters")).cast("string") if strict else F.lit(None).cast("string")
        return F.when((after >= 0) & (after < F.size(c) - 1) & (count >= 1), done).otherwise(wrong)

    return let(cluster_texts(text), of)
