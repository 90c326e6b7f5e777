"""Each operator on awkward rows and against a brute-force version."""

import collections
import hashlib
import math
import random
import time
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from wordspan.llm import ann, chat, decontaminate, licenses, lines, packing, quality, simhash, suffixes, toxicity
from wordspan.llm.common import FILE_CLEANUP, connected_components, local_roots, shared_folder, stash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, fp int, tokens string"
LONG = " ".join(f"w{i % 997}" for i in range(30_000))


def rows_of(texts):
    return [(i, t, "en", "s", len(t or ""), "x", 1, "y") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    rows = rows_of([None, "", "a", "the quick brown fox jumps", "the quick brown fox jumps", LONG, "é " * 50, "\n\n"])
    return spark.createDataFrame(rows + [rows[3], (None, "null id text", None, None, None, None, None, None), (None, "null id text", None, None, None, None, None, None)], DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(3, 1, 0), (4, 0, 1), (None, 1, 1), (5, None, None)], "doc_id long, quality int, toxic int")


def test_components(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 3), (9, 8), (8, 7), (7, 6), (6, 5), (2, 1)], "u long, v long")
    assert sorted(map(tuple, connected_components(edges).collect())) == [(k, 1) for k in (1, 2, 3)] + [(k, 5) for k in (5, 6, 7, 8, 9)]


def test_shuffle_files_of_a_stash_go_when_it_is_written(spark):
    def files():
        return set(Path(spark.conf.get("spark.local.dir")).glob("blockmgr-*/*/shuffle_*.data"))

    rows = spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.sum("id").alias("n")).join(spark.range(5_000).withColumnRenamed("id", "k").hint("merge"), "k")
    before, choice = files(), spark.conf.get(FILE_CLEANUP)
    back = stash(rows, "cleaned")
    end = time.monotonic() + 10  # they go in the background; nothing is asked to collect garbage meanwhile
    while files() - before and time.monotonic() < end:
        time.sleep(0.1)
    assert not files() - before
    assert spark.conf.get(FILE_CLEANUP) == choice
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect())) and back.count() == 5_000
    with pytest.raises(Exception, match="no such"):
        stash(rows.withColumn("bad", F.raise_error(F.lit("no such"))), "bad")
    assert spark.conf.get(FILE_CLEANUP) == choice


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_simhash(spark, odd):
    got = simhash.near_groups(odd).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    for r in odd.collect():
        if r.doc_id is not None:
            assert int(by_id[r.doc_id].fingerprint, 16) == brute_fingerprint(r.text)
    assert {by_id[k].component_id for k in (0, 1, 7)} == {0} and by_id[4].component_id == 3
    assert by_id[None].component_id is None
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 2, 3, 5, 6]
    assert kept.where("doc_id is null").count() == 1
    assert simhash.near_groups(odd.limit(0)).count() == 0


def test_gray_tree():
    rng = np.random.default_rng(2)
    codes = []
    for base in rng.integers(0, 2**63, 60, dtype=np.uint64):
        for _ in range(9):
            c = int(base)
            for k in rng.integers(0, 64, rng.integers(0, 5)):
                c ^= 1 << int(k)
            codes.append(c)
    codes = np.unique(np.array(codes, dtype=np.uint64))
    u, v = simhash.run_links(codes, np.zeros(len(codes), dtype=np.int64))
    at = {int(c): i for i, c in enumerate(codes)}
    own = local_roots(len(codes), np.arange(len(codes)), np.array([at[int(x)] for x in u]), np.array([at[int(x)] for x in v]))
    a, b = np.nonzero(np.bitwise_count(codes[:, None] ^ codes[None]) <= 3)
    assert (own == local_roots(len(codes), np.arange(len(codes)), a, b)).all()


def test_licences(spark, odd):
    mit = next(t for i, kind, t in licenses.KNOWN if (i, kind) == ("MIT", "licence"))
    texts = ["Copyright (c) 2020 Somebody\n\n" + mit.upper().replace(",", " ,"), mit + " more", "x\nlicenced UNDER the apache licence, version 2.0\ny", None, "", "MIT License\n\nCopyright 2020 me\n\n" + mit, "Released under the MIT License."]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows_of(texts), DOCS), licenses.built_in(spark)).collect()}
    assert [got[i].licence_id for i in range(7)] == ["MIT", None, None, None, None, "MIT", "MIT"]
    assert [got[i].n_notices for i in range(7)] == [0, 0, 1, 0, 0, 0, 1] and got[3].digest is None and got[4].digest is None and got[2].notices == "Apache-2.0"
    assert licenses.scan(odd, licenses.built_in(spark)).count() == odd.count() and licenses.scan(odd.limit(0), licenses.built_in(spark)).count() == 0


def test_licences_of_a_callers_catalog(spark, odd):
    own = licenses.catalog(spark.createDataFrame([("Waived", "notice", "All rights waived by the author."), ("Both", "notice", "Copyright-holder licence: colour"), ("Nothing", "notice", "!?"), ("A", "notice", "all RIGHTS waived -- by the author")], "licence_id string, kind string, text string"))
    texts = ["some text\nAll rights waived by the author.\nall rights waived by the AUTHOR", "copyright owner", "our sub-license\nthe copyright owner license color"]
    rows = rows_of(texts)
    got = sorted(licenses.scan(spark.createDataFrame([*rows, rows[0]], DOCS), own).collect())
    assert [(r.doc_id, r.n_notices, r.notices, r.licence_id) for r in got] == [(0, 2, "A", None), (0, 2, "A", None), (1, 0, "", None), (2, 0, "", None)]
    assert licenses.scan(odd, own.limit(0)).where("n_notices > 0").count() == 0


def slow_lines(rows, min_docs, min_tokens, depth):
    """(id, lines that stay) of rows (id, text), from the rules."""
    places = []
    for doc, text in rows:
        for pos, line in enumerate(text.split("\n") if text is not None else []):
            tokens = ["<*>" if any(c.isdigit() for c in t) else t for t in line.split()]
            if len(tokens) >= min_tokens:
                places.append((doc, pos, tuple(tokens)))
    leaves, shared, width = {}, {}, 1
    for _, _, t in places:
        leaves.setdefault((len(t), t[:depth]), set()).add(t)
    while leaves:
        parts = {}
        for leaf, ts in leaves.items():
            found = [len(set(x)) for x in zip(*ts)]
            fields = sum(d > 1 for d in found)
            if len(ts) > 1 and fields * (8 if len(ts) == 2 else 4) <= len(found):
                shared |= {t: (width, leaf) for t in ts}
            elif len(ts) > 2:
                best = sorted((d, i) for i, d in enumerate(found) if d > 1)[:width]
                for t in ts:
                    parts.setdefault((leaf, tuple(t[i] for _, i in best)), set()).add(t)
        leaves, width = parts, width * 4
    groups = {}
    for doc, pos, t in places:
        groups.setdefault(shared.get(t, t), []).append((doc, pos))
    gone = {p for g in groups.values() if len({d for d, _ in g}) >= min_docs for p in g if p != min(g)}
    return {doc: None if text is None else "\n".join(x for i, x in enumerate(text.split("\n")) if (doc, i) not in gone) for doc, text in rows}


@pytest.mark.parametrize("min_docs, min_tokens, depth", [(2, 5, 2), (2, 5, 1), (3, 2, 3), (2, 5, 4)])
def test_lines_against_slow_version(spark, min_docs, min_tokens, depth):
    rng = random.Random(12)
    names, places = ["Anna", "Ben", "Carl", "Dora", "Emil"], ["Garden", "House", "Roof"]
    texts = []
    for i in range(60):
        own = [f"Posted by {rng.choice(names)} in the category {rng.choice(places)} today", f"page {i} of {i + 7} was read {rng.choice(names)} times", " ".join(rng.choice(["the", "of", "and", "in", "to"]) for _ in range(rng.randrange(1, 9))), f"own line {' '.join(rng.choice('abcdefgh') for _ in range(6))}"]
        rng.shuffle(own)
        texts.append("\n".join(own[: rng.randrange(1, 5)]))
    texts += [None, "", texts[0]]
    got = lines.drop_recurring_lines(spark.createDataFrame(rows_of(texts), DOCS), min_docs, min_tokens, depth)
    assert {r.doc_id: r.text for r in got.collect()} == slow_lines(list(enumerate(texts)), min_docs, min_tokens, depth)


def test_depth_of_the_tree_matters(spark):
    texts = [f"Posted by {x} in the category Garden" for x in ("Anna", "Ben", "Carl")]
    left = lambda depth: lines.drop_recurring_lines(spark.createDataFrame(rows_of(texts), DOCS), depth=depth).where("text <> ''").count()
    assert (left(2), left(3)) == (1, 3)


def test_strays_cost_a_template_nothing(spark):
    """Lines that only begin like those of a template leave it whole, and two unlike lines stay."""
    names = ["Anna", "Ben", "Carl", "Dora"]
    texts = [f"Posted by {x} in the category Garden" for x in names] + ["Posted by a friend of my mother", "Posted by noon or not at all", "Posted by him as he went home"]
    texts += ["see the old mill by the river now", "see the old town by the harbour now"]
    rows = list(enumerate(texts))
    got = {r.doc_id: r.text for r in lines.drop_recurring_lines(spark.createDataFrame(rows_of(texts), DOCS)).collect()}
    assert got == slow_lines(rows, 2, 5, 2)
    assert [i for i, t in got.items() if t == ""] == [1, 2, 3]


def test_lines(spark, odd):
    texts = [f"own line number one here\nsent on day {i} at {i}:00 by me\nshort\nshort" for i in range(3)] + ["sent on day 9 at 8:00 by me", None, "", "once only in this one\nonce only in this one"]
    got = {r.doc_id: r for r in lines.drop_recurring_lines(spark.createDataFrame(rows_of(texts), DOCS)).collect()}
    assert got[0].text == texts[0] and got[1].text == "short\nshort" and got[3].text == "" and got[4].text is None and got[6].text == texts[6]
    assert (got[1].n_lines, got[1].n_dropped, got[5].n_lines, got[4].n_lines) == (4, 2, 1, 0)
    clash = odd.withColumnRenamed("source", "_lost_drop").withColumnRenamed("lang", "text_hash").withColumnRenamed("fp", "lost_doc")
    done = lines.drop_recurring_lines(clash)
    assert done.columns[: len(odd.columns)] == clash.columns and done.count() == odd.count() and lines.drop_recurring_lines(odd.limit(0)).count() == 0


def test_quality(spark, odd, labels):
    got = quality.quality(odd, labels, passes=2).collect()
    assert len(got) == odd.count()
    by_id = {r.doc_id: r for r in got}
    assert by_id[0].perplexity is None and by_id[1].keep == 0 and by_id[3].keep == 1 and by_id[5].n_tokens == 30_000
    assert quality.quality(odd.limit(0), labels, passes=1).count() == 0
    assert {r.keep for r in quality.quality(odd.where("doc_id in (3, 5)"), labels.limit(0), passes=1).collect()} == {1}


def slow_perplexities(texts, trusted, fold, folds, order):
    """Interpolated modified Kneser-Ney by counting dictionaries."""
    out = {}
    words = [["<s>"] * (order - 1) + t.lower().split() + ["</s>"] for t in texts]
    for f in range(folds):
        counts = {order: collections.Counter(tuple(w[j - order + 1 : j + 1]) for i, w in enumerate(words) if i in trusted and fold[i] != f for j in range(order - 1, len(w)))}
        for k in range(order - 1, 0, -1):
            counts[k] = collections.Counter(g[1:] for g in counts[k + 1])
        cuts = {k: quality.discounts(tuple(sum(n == i for n in c.values()) for i in (1, 2, 3, 4))) for k, c in counts.items()}
        after = {k: collections.defaultdict(list) for k in counts}
        for k, c in counts.items():
            for g, n in c.items():
                after[k][g[:-1]].append(n)

        def p(g):
            k, seen = len(g), after[len(g)].get(g[:-1], [])
            low = p(g[1:]) if k > 1 else 1 / (len(seen) + 1)
            if not seen:
                return low
            n = counts[k].get(g, 0)
            return max(n - cuts[k][min(n, 3)], 0) / sum(seen) + sum(cuts[k][min(x, 3)] for x in seen) / sum(seen) * low

        for i, w in enumerate(words):
            if fold[i] == f and len(w) > order:
                logs = [math.log(p(tuple(w[j - order + 1 : j + 1]))) for j in range(order - 1, len(w))]
                out[i] = math.exp(-sum(logs) / len(logs))
    return out


@pytest.mark.parametrize("order, folds", [(2, 2), (3, 2), (2, 3)])
def test_perplexities_against_dictionaries(spark, order, folds, monkeypatch):
    monkeypatch.setattr(quality, "SHARD_KEYS", 64)
    rng = random.Random(3)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.randrange(60))) for _ in range(70)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    fold = {r.doc_id: r.f for r in docs.select("doc_id", F.pmod(F.xxhash64("text"), F.lit(folds)).alias("f")).collect()}
    trusted = spark.createDataFrame([(i,) for i in range(0, 70, 2)], "doc_id long")
    got = {r.doc_id: r.perplexity for r in quality.perplexities(docs, trusted, order, folds, 2).collect() if r.perplexity}
    expected = slow_perplexities(texts, set(range(0, 70, 2)), fold, folds, order)
    assert got.keys() == expected.keys() and max(abs(got[i] / expected[i] - 1) for i in expected) < 1e-9


def test_quality_of_rows_not_seen_in_training(spark):
    path = "/root/testdata/sf0.01/{}.parquet"
    docs, known = spark.read.parquet(path.format("documents")), spark.read.parquet(path.format("labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    scored = quality.quality(docs, known.where(half), passes=1).join(known.where(~half), "doc_id")
    kept = {r.quality: r.k for r in scored.groupBy("quality").agg(F.avg("keep").alias("k")).collect()}
    assert kept[1] >= 0.9 and kept[0] <= 0.4


def test_long_words_and_blanks():
    text = b"a" * 5_000_000 + b"\x0b\x0cB " + b"c" * 300 + b"\r\nd"
    assert len(quality.word_hashes(text)) == 4 and quality.word_hashes(b"A b")[0] == quality.word_hashes(b"a")[0]


def test_grams_of_a_slice_are_those_of_its_texts():
    texts = [b"", b"One two  one", b" \x0b", b"three\n", b"x" * 300_000 + b" y" + b" z" * 200_000, b"one two"]
    whole, at = quality.Grams(texts, 3), 0
    for i, text in enumerate(texts):
        own = quality.Grams([text], 3)
        n = len(own.last)
        assert whole.size[i] == own.size[0] == len(text.split()) and (whole.doc[at : at + n] == i).all()
        places = np.flatnonzero(own.scored)
        for k in (1, 2, 3):
            assert (whole.key(k, at + places) == own.key(k, places)).all()
        at += n
    assert at == len(whole.last) and quality.words_of(b"a bc")[0].tolist() == [0, 2]


def test_toxicity(spark, odd, labels):
    bad = ["plain words then idiot again", "what a moron he is", "some clown came by"]
    rng = random.Random(5)
    texts, marks = [], []
    for i in range(240):
        words = [rng.choice("alpha beta gamma delta omega sigma kappa".split()) + str(rng.randrange(50)) for _ in range(30)]
        toxic = i % 3 == 0
        if toxic:
            words[7:7] = rng.choice(bad).split()[-3:] + ["idiot"]
        texts.append(" ".join(words))
        marks.append((i, 1, int(toxic)))
    docs, known = spark.createDataFrame(rows_of(texts), DOCS), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, known).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.doc_id % 3 == 0) for r in got if r.held_out) and all(0 <= r.score <= 1 for r in got)
    kept = toxicity.without_toxic(docs, known)
    assert kept.columns == docs.columns and kept.where("doc_id % 3 <> 0").count() == 160
    assert toxicity.toxicity(odd, labels).count() == odd.count() and toxicity.toxicity(odd.limit(0), labels.limit(0)).count() == 0


def test_automaton_against_edit_distance():
    def distance(a, b):
        prev = list(range(len(b) + 1))
        for i, x in enumerate(a):
            cur = [i + 1]
            for j, y in enumerate(b):
                cur.append(min(prev[j] + (x != y), prev[j + 1] + 1, cur[j] + 1))
            prev = cur
        return prev[-1]

    terms = ["idiot", "scum", "pathetic"]
    auto = toxicity.Automaton.of([(t, False) for t in terms])
    rng = random.Random(6)
    words = [*terms, "idoit", "idi0t", "idiots", "scm", "pathetik", "patetic", "ppathetic"]
    words += ["".join(rng.choice("idotscum") for _ in range(rng.randrange(1, 8))) for _ in range(500)]
    codes = np.frombuffer(" ".join(words).encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    at, edits = auto.hits(codes, ends - [len(w) for w in words], ends)
    expected = {i: 1 + min(d) for i, w in enumerate(words) if (d := [distance(w, t) for t in terms if distance(w, t) <= toxicity.edits_for(t, False)])}
    assert dict(zip(at.tolist(), edits.tolist())) == expected
    abuse, quoted = toxicity.features(["he is an idiot now", 'she read the word "idiot" aloud'], auto)
    assert abuse[0] > 0 and quoted[0] == 0 and quoted[2] > 0


def test_packing(spark, odd):
    from tokenizers import Tokenizer

    import public_tokenizers

    tok = Tokenizer.from_file(packing.default_tokenizer())
    docs = odd.unionByName(spark.createDataFrame([(90, "a <|endoftext|> b 日本", "en", "s", 1, "", 1, "")], DOCS))
    got = packing.pack(docs, ranks=public_tokenizers.path("byte_bpe_50k.tiktoken"), pattern=public_tokenizers.PATTERN, capacity=64).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    pieces = {}
    for r in got:
        pieces.setdefault(r.doc_id, set()).add((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for doc, text in texts.items():
        ids = tok.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]
        at = sorted(pieces[doc])
        assert sum(p[1] for p in at) == len(ids) == at[0][3]
        assert all(zlib.crc32(np.array(ids[s : s + n], dtype="<u4").tobytes()) == c for s, n, c, _ in at)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 64


def test_closest_fill_is_best():
    rng = random.Random(7)
    for _ in range(200):
        counts = np.zeros(21, dtype=np.int64)
        for _ in range(5):
            counts[rng.randrange(1, 21)] += rng.randrange(1, 4)
        chosen = packing.closest_fill(counts, 20)
        sums = {0}
        for length, n in enumerate(counts):
            for _ in range(n):
                sums |= {s + length for s in sums if s + length <= 20}
        assert sum(k * m for k, m in chosen.items()) == max(sums) and all(m <= counts[k] for k, m in chosen.items())


def test_decontamination(spark, odd):
    rng = random.Random(3)
    voc = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(voc) for _ in range(rng.choice([1, 3, 5, 8, 14, 30])))) for i in range(12)]
    texts = []
    for d in range(60):
        words = [rng.choice(voc) for _ in range(rng.randrange(0, 80))]
        if d % 2:
            own = items[rng.randrange(12)][1].split()
            for _ in range(rng.randrange(0, max(1, len(own) // 5) + 2)):
                p, kind = rng.randrange(len(own)), rng.random()
                own[p : p + 1] = [rng.choice(voc)] if kind < 0.4 else [own[p], rng.choice(voc)] if kind < 0.7 or len(own) == 1 else []
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        texts.append(" ".join(words))

    def fit(a, b):
        prev = [0] * (len(b) + 1)
        for i, x in enumerate(a):
            cur = [i + 1]
            for j, y in enumerate(b):
                cur.append(min(prev[j] + (x != y), prev[j + 1] + 1, cur[j] + 1))
            prev = cur
        return min(prev)

    expected = {(d, i): f for d, x in enumerate(texts) for i, t in items if (f := fit(t.split(), x.split())) <= len(t.split()) // 5}
    docs, bench = spark.createDataFrame(rows_of(texts), DOCS), spark.createDataFrame([*items, (99, None), (98, "")], "item_id long, text string")
    assert {(r.doc_id, r.item_id): r.distance for r in decontaminate.matches(docs, bench).collect()} == expected
    kept = decontaminate.without_leaks(odd, spark.createDataFrame([(1, "Quick, BROWN fox")], "item_id long, text string"))
    assert kept.columns == odd.columns and kept.where("doc_id in (3, 4)").count() == 0 and kept.count() == odd.count() - 3
    assert decontaminate.matches(odd, bench.limit(0)).count() == 0


def test_long_texts_are_searched_whole():
    text = LONG.encode() + b" needle one two three four five six seven " + LONG.encode()
    items = decontaminate.Items([(5, b"needle one two three four five six seven")])
    best = {}
    decontaminate.search(items, [(0, p, n) for p, n in decontaminate.parts(text, 20, 5000)], best)
    assert best[0, 0] == (0, 30_000, 30_008)


def test_chat(spark):
    schema = "conv_id long, turn long, role string, text string"
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "a"), (2, 0, "user", "hi"), (2, 1, "assistant", "b"), (2, 2, "user", "c"), (3, 0, "user", "alone"), (3, 1, "assistant", None), (4, 0, "user", "hi"), (4, 1, "assistant", "a"), (None, 0, "user", "hi")]
    turns += [(5, 0, "user", "other"), (5, 1, "assistant", "x"), (5, 2, "user", "more"), (5, 3, "assistant", "y"), (5, 4, "user", "end"), (6, 0, "user", "nobody answers"), (900, 0, "user", "far"), (900, 1, "assistant", "z")]
    got = {(r.chosen_id, r.rejected_id): r for r in chat.preferences(chat.preference_pairs(spark.createDataFrame(turns, schema))).collect()}
    assert set(got) == {(1, 2), (1, 4), (3, 4), (5, 900), (6, None), (900, 1)}
    r = got[1, 2]
    assert (r.n_prompt_turns, r.prompt, r.chosen) == (1, "<|user|>\nhi<|end|>\n", "<|assistant|>\na<|end|>\n")
    a, b = map(int, r.rejected_mask.split("-"))
    assert r.rejected[a:b] == "b" and got[1, 4].chosen == "" == got[1, 4].rejected and got[6, None].rejected is None
    r = got[5, 900]
    assert (r.n_prompt_turns, r.chosen, r.rejected) == (3, "<|assistant|>\ny<|end|>\n", "<|assistant|>\nz<|end|>\n")
    assert got[900, 1].rejected == "<|assistant|>\na<|end|>\n"
    assert (got[900, 1].prompt, got[900, 1].chosen) == ("<|user|>\nfar<|end|>\n", "<|assistant|>\nz<|end|>\n")
    assert chat.preferences(chat.preference_pairs(spark.createDataFrame([], schema))).count() == 0


def test_chat_against_its_sql(spark):
    """Hot openings, equal sides, prefixes of many turns, repeated and very long rows, roles with line breaks."""
    rng = random.Random(21)
    turns = [(None, 0, "user", "no id"), (400, 0, "user", LONG), (400, 1, "assistant", LONG), (401, 0, "x\ny", "z"), (402, 0, "x", "y\nz"), (403, None, None, None), (403, 0, "assistant", "r"), (403, 0, "assistant", "r")]
    for conv in range(150):
        shared = ["hot", "q2", "q3", "q4"] if conv % 3 else [f"own {conv}"]
        for t in range(rng.randrange(1, 7)):
            turns.append((conv, t, "user" if t % 2 == 0 else rng.choice(["assistant", "assistant", "tool"]), shared[t] if t < len(shared) else rng.choice(["ok", "no", f"text {conv}"])))
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    conversations = df.toPandas()  # noqa: F841
    names = ["chosen_id", "rejected_id", "n_prompt_turns", "prompt", "chosen", "chosen_mask", "rejected", "rejected_mask"]
    plain = lambda rows: sorted(tuple("null" if v is None or v != v else str(v) for v in r) for r in rows)
    con = duckdb.connect()
    con.register("given", conversations)
    con.execute("create view conversations as select cast(conv_id as bigint) as conv_id, cast(turn as bigint) as turn, role, text from given")
    got = chat.preferences(chat.preference_pairs(df)).select(*names).collect()
    assert plain(got) == plain(con.execute(f"select {', '.join(names)} from ({chat.oracle()})").fetchall())
    assert max(r.n_prompt_turns for r in got) >= 4


def test_chat_partners_whatever_the_ids(spark):
    """Dense and hashed ids give every conversation with a reply a partner: the next by id, in a ring."""
    turns = [(c, t, role, f"{role} {c}") for c in range(120) for t, role in enumerate(("user", "assistant"))]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumn("clash", F.lit(1))
    for rows in (df, df.withColumn("conv_id", F.xxhash64("conv_id"))):
        got = {r.conv_id: (r.partner, r.reply) for r in chat.with_drawn_reply(rows.repartition(7)).collect()}
        text = {r.conv_id: r.text for r in rows.where("role = 'assistant'").collect()}
        order = sorted(text)
        assert got == {c: (d, text[d]) for c, d in zip(order, order[1:] + order[:1])}
    one = chat.with_drawn_reply(df.where("conv_id = 3")).collect()
    assert [(r.conv_id, r.partner, r.last, r.reply) for r in one] == [(3, None, None, None)]


def brute_repeats(rows, match):
    seen, out = set(), {}
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), dtype=bool)
        for i in range(len(data) - match + 1):
            w = data[i : i + match]
            if w in seen:
                gone[i : i + match] = True
            seen.add(w)
        runs = int((np.diff(np.concatenate([[0], gone.view(np.int8)])) == 1).sum())
        out.setdefault(doc, []).append((len(data), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(data, dtype=np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("batches", [1, 5])
def test_suffixes(spark, batches):
    rng = random.Random(8)
    shared = ["".join(rng.choice("ab ") for _ in range(rng.randrange(90, 400))) for _ in range(6)]
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(0, 200))) + rng.choice(shared) + "x" * rng.randrange(150) + rng.choice(shared)[: rng.randrange(400)] for _ in range(50)]
    texts += [None, "", "a" * 5000, texts[3], texts[3]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows_of(texts), DOCS)
    parts = [docs.where(F.col("doc_id") % batches == k) for k in range(batches)]
    got = {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())] for r in suffixes.dedup(parts).collect()}
    assert got == brute_repeats(rows, 100)


def test_suffix_arrays_go_once_spans_are_found(spark):
    rng = random.Random(9)
    shared = "".join(rng.choice("abcd ") for _ in range(300))
    docs = spark.createDataFrame([(i, f"{i} " + shared[rng.randrange(100) :]) for i in range(30)], "doc_id long, text string")
    folder = Path(shared_folder(spark).removeprefix("file://"))
    before = set(folder.glob("*")) if folder.exists() else set()
    done = suffixes.dedup([docs.where(F.col("doc_id") % 3 == k) for k in range(3)])
    assert {x.name.split("-")[0] for x in set(folder.glob("*")) - before} == {"repeats"}
    assert done.agg(F.sum("n_removed")).first()[0] > 0


def test_suffixes_with_repeated_and_null_ids(spark, odd):
    got = {}
    for r in suffixes.dedup([odd]).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()))
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in brute_repeats(rows, 100).items()}
    assert suffixes.dedup([odd.limit(0)]).count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(9)
    vectors = rng.normal(size=(900, 16))
    vectors[40:80] = vectors[40]
    rows = [(i, [float(x) for x in v], "x") for i, v in enumerate(vectors)]
    rows += [(2000, None, "x"), (2100, [0.0] * 16, "x"), (2200, [float("nan")] * 16, "x"), (2300, [1.0, None], "x"), (None, [1.0] * 16, "x"), (2400, [1.0] * 3, "x"), (100, [float(x) for x in vectors[100]], "x")]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score string")
    got = ann.neighbours(table, table.where("vec_id % 20 = 0"), shard_bytes=300 * 16 * 8).collect()
    found = {}
    for r in sorted(got, key=lambda r: r["rank"]):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == {i for i in range(900) if i % 20 == 0}
    hits = 0
    for q, have in found.items():
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        best = [i for i in np.lexsort((np.arange(900), d)) if i != q][:10]
        hits += len(set(best) & {v for v, _ in have})
        assert len(have) == 10 and all(abs(d[v] - s) < 1e-9 for v, s in have) and q not in {v for v, _ in have}
    assert hits >= 0.9 * 10 * len(found)
    assert [v for v, _ in found[40]] == list(range(41, 51))
    assert ann.neighbours(table.limit(0), table.limit(0)).count() == 0


def test_neighbours_of_a_whole_shard():
    """Recall in a shard of the production size, of vectors without any structure, by the degree and beam that follow from it."""
    rng = np.random.default_rng(3)
    n = ann.SHARD_BYTES // (64 * 8)
    vectors, asked = rng.normal(size=(n, 64)), rng.normal(size=(100, 64))
    graph, start = ann.build_graph(vectors, ann.degree_for(n))
    found, _, _ = ann.beam_search(vectors, graph, start, asked, ann.beam_for(n))
    nearest = np.argsort((vectors**2).sum(1) - 2 * asked @ vectors.T, axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b[:10])) for a, b in zip(nearest, found)]) >= 9.5


def test_neighbours_tie_across_shards(spark):
    """Different vectors equally near, in different shards: the smaller ids come first."""
    rows = [(0, [0.0, 1.0])] + [(i, [float(x), 1.0 + float(y)]) for i, (x, y) in enumerate([(3, 4), (-3, 4), (3, -4), (-3, -4), (5, 0), (-5, 0), (0, 5), (4, 3)], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = ann.neighbours(table, table.where("vec_id = 0"), k=5, shard_bytes=32).orderBy("rank").collect()
    assert [(r["rank"], r.vec_id, r.score) for r in got] == [(i, i, 5.0) for i in range(1, 6)]
