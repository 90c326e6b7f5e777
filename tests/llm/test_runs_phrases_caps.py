"""Operators 11 to 13 against slow versions, and on odd rows."""

import hashlib
import random
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordspan.llm import caps, phrases, runs


def slow_runs(w):
    best = {}
    for q in range(1, len(w) // 4 + 1):
        for same, places in groupby(range(len(w) - q), key=lambda i: w[i] == w[i + q]):
            places = list(places)
            if same and len(places) + q >= max(6, 4 * q):
                best.setdefault((places[0], len(places) + q), q)
    return sorted(((s, n, q) for (s, n), q in best.items()), key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    draw = random.Random(1)
    for _ in range(400):
        documents = []
        for _ in range(draw.randint(1, 4)):
            letters = draw.choice([1, 2, 3, 20])
            words = [b"%d" % draw.randrange(letters) for _ in range(draw.randint(0, 60))]
            if words and draw.random() < 0.6:
                at, p = draw.randrange(len(words)), draw.randint(1, 8)
                words = words[:at] + [words[at + i % min(p, len(words) - at)] for i in range(len(words) - at)]
                words += [b"%d" % draw.randrange(letters) for _ in range(draw.randint(0, 9))]
            documents.append(words)
        assert runs.runs_of(documents) == [slow_runs(d) for d in documents]


def test_runs_of_one_word_and_of_many_stretches():
    assert runs.runs_of([[b"a"] * 5000]) == [[(0, 5000, 1)]]
    mixed = [w for k in range(40) for w in [b"a"] * 100 + [b"x%d" % (k % 7)]]
    assert runs.runs_of([mixed, [], [b"a"] * 5]) == [slow_runs(mixed), [], []]


def test_runs_query(spark):
    """The contract, planted stretches included, on nulls, blanks, repeated rows and other columns."""
    texts = [None, "", " \t\n", "a a a a a a", "x y z " * 9 + "end", "one two\x0bthree", "w " * 3000] + [" ".join(f"{k}w{i}" for i in range(k)) for k in range(1, 60)]
    rows = [(k, t, 1) for k, t in enumerate(texts)] + [(3, texts[3], 2)]
    got = runs.digests(runs.periodic_runs(runs.planted(spark.createDataFrame(rows, "doc_id long, text string, runs int")))).collect()
    assert len(got) == len(rows)
    planted = 0
    for r in got:
        w, h = (texts[r.doc_id] or "").split(), zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            planted += 1
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
        own = slow_runs(w)
        gone = {i for s, n, q in own for i in range(s + q, s + n)}
        best = min(own, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(own), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if own else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in own).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()
    assert planted > 3
    assert runs.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def slow_collocations(rows, least):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", "".join(c.lower() if c.isascii() else c for c in text or "")
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, "\n")
        for piece in text.split("\n"):
            w = piece.replace("\t", " ").split(" ")
            w = [x for x in w if x]
            totals[lang] += len(w)
            counts.update((lang, *w[i : i + k]) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = {g: f for g, f in counts.items() if f >= least and len(g) > 2}
    out = []
    for (lang, *w), a in found.items():
        if any(x[0] == lang and len(x) > len(w) + 1 and f >= a and any(list(x[i : i + len(w)]) == w for i in range(1, len(x))) for x, f in found.items()):
            continue
        cuts = [(1000 * a * totals[lang] // (counts[(lang, *w[:k])] * counts[(lang, *w[k:])]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.append((lang, " ".join(w), a, counts[(lang, *w[:k])], counts[(lang, *w[k:])], totals[lang], score))
    return sorted(out)


@pytest.mark.parametrize("batch", [200, phrases.BATCH_BYTES])
def test_collocations_of_random_texts(spark, monkeypatch, batch):
    monkeypatch.setattr(phrases, "BATCH_BYTES", batch)
    draw = random.Random(5)
    rows = [(draw.choice(["en", "de", None]), "".join(draw.choice(["a ", "b ", "the big cat ", "C ", "d\t", "é ", ". ", "\n"]) for _ in range(60))) for _ in range(60)] + [("en", None), (None, ""), ("fr", "...")]
    docs = spark.createDataFrame([(*r, 7) for r in rows], "lang string, text string, phrase int")
    got = phrases.collocations(docs, least=5)
    assert sorted((r.lang, r.phrase, r.a, r.l, r.r, r.n, r.score) for r in got.collect()) == slow_collocations(rows, 5)
    top = phrases.ranked(got, 3).collect()
    assert all(r["rank"] <= 3 for r in top) and Counter(r.lang for r in top) == {"en": 3, "de": 3, "und": 3}


def test_collocations_of_nothing(spark):
    assert phrases.collocations(spark.createDataFrame([(None, None)], "lang string, text string")).count() == 0
    assert phrases.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


def test_scores_pass_64_bits(spark):
    """A count times a total of 10 ** 14 words."""
    levels = [spark.createDataFrame([(1, "en", "a", 10**12), (2, "en", "b", 10**11)], "id long, lang string, word string, f long"), spark.createDataFrame([(3, 1, 2, 10**11)], "id long, left long, right long, f long")]
    kept, phrases.frequent_phrases = phrases.frequent_phrases, lambda *_: (levels, spark.createDataFrame([("en", 10**14)], "lang string, n long"))
    try:
        (row,) = phrases.collocations(spark.createDataFrame([], "lang string, text string"), most_words=2).collect()
    finally:
        phrases.frequent_phrases = kept
    assert row.score == 1000 * 10**11 * 10**14 // (10**12 * 10**11)


def slow_links(rows, least=0.95):
    unit = []
    for key, v in rows:
        x = None if v is None or any(c is None for c in v) or not v else np.array(v, dtype=np.float64)
        unit.append(None if key is None or x is None or not np.isfinite(x).all() or not x.any() else (y := x / np.abs(x).max()) / np.linalg.norm(y))
    near = [[j for j, y in enumerate(unit) if i != j and x is not None and y is not None and len(x) == len(y) and x @ y >= least] for i, x in enumerate(unit)]
    root = [r[0] for r in rows]
    for _ in rows:
        root = [r if r is None else min([r, *(root[j] for j in near[i]), *(root[j] for j, other in enumerate(rows) if other[0] == rows[i][0])]) for i, r in enumerate(root)]
    return sorted(((r[0], len(n), c, r[0] is not None and r[0] == c) for r, n, c in zip(rows, near, root)), key=str)


@pytest.mark.parametrize("block", [40, caps.BLOCK])
def test_links_of_clusters_and_odd_rows(spark, monkeypatch, block):
    monkeypatch.setattr(caps, "BLOCK", block)
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((4, 24))
    rows = [(i, (centres[i % 4] + s * rng.standard_normal(24)).tolist()) for i, s in enumerate([0.05] * 300 + [0.2] * 60)]
    rows += [(1000 + i, rng.standard_normal(24).tolist()) for i in range(40)]
    rows += [(2000, rows[0][1]), (2001, rows[0][1]), (2001, rows[1][1]), (2002, [2 * x for x in rows[5][1]]), (None, rows[0][1])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 24), (3003, [float("nan")] * 24), (3004, [None] + [1.0] * 23), (3005, [1.0, 0.0]), (3006, [1.0, 0.1]), (3007, [-1.0, 0.0]), (3008, [1e300] * 24), (3009, [1e-300] * 24), (3010, [float("inf")] * 24)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n_links int")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in caps.links(df).collect()), key=str)
    assert got == slow_links(rows)


def test_links_of_nothing(spark):
    assert caps.links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


@pytest.mark.parametrize("dim, n", [(5, 1000), (64, 51_000), (64, 10_000_000), (300, 100_000)])
def test_filters_find_the_weakest_pairs(dim, n):
    """Pairs just over the threshold: 0.98 at least share a filter."""
    rng = np.random.default_rng(4)
    a = caps.unit_vectors(rng.standard_normal((600, dim)))
    side = rng.standard_normal((600, dim))
    side = caps.unit_vectors(side - (side * a).sum(1, keepdims=True) * a)
    found = [set(zip(*(x.tolist() for x in caps.product_codes(dim, n, 0.95, caps.MISS, caps.FILTER_ROWS, caps.CODES).filters(v)))) for v in (a, 0.9501 * a + np.sqrt(1 - 0.9501**2) * side)]
    assert len({row for row, _ in found[0] & found[1]}) >= 0.98 * 600
