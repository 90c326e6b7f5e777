"""The pipeline's near-dedup stage against brute force."""

import random

import corpus_pipeline
import numpy as np
import pytest
from wordspan.llm import decontaminate, shingles, simhash


def brute_kept(texts):
    def own(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else {()}

    sets, root = [own(t) for t in texts], list(range(len(texts)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if root[i] != root[j] and 5 * len(a & b) >= 4 * len(a | b):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return sorted(set(root))


def test_near_copies_against_brute_force(spark):
    rng = random.Random(11)
    texts = [None, "", "one two", "One  two", "one two three"]
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([12, 60, 200]))]
        texts.append(" ".join(base))
        for _ in range(8):
            copy = list(base)
            for _ in range(rng.randrange(1, 7)):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            texts.append(" ".join(copy))
            base = copy if rng.random() < 0.3 else base
    base = [f"y{i}" for i in range(200)]
    two = [*base[:60], "other", *base[61:140], "words", *base[141:]]
    texts += [" ".join(base), " ".join(two)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert got == brute_kept(texts) and len(texts) - 1 not in got


def test_split_bands_are_compared_whole():
    import numpy as np

    sets = [shingles.shingles(" ".join(f"w{i}" if i not in gone else f"z{g}{i}" for i in range(150)).encode()) for g, gone in enumerate([(), (10,), (10, 30, 50, 70, 90, 110), (11,)])]
    a, b = shingles.bucket_links(np.array([4, 5, 6, 7]), sets)
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())} in ({(0, 1), (0, 3)}, {(0, 1), (1, 3)})


def similar_sets(rng, size):
    """Two sets of hashes, one of ``size``, whose similarity is 0.8 or little more."""
    both = rng.integers(0, 1 << 63, 2 * size, dtype=np.uint64)
    gone = max(g for g in range(size) if 5 * (size - g) >= 4 * (size + g)) if size >= 9 else 0
    return (both[:size], both[gone : size + gone]) if gone else (both[:size], both[: size + 1])


@pytest.mark.parametrize("width", [8, 16])
def test_wide_fingerprints_find_pairs_of_the_least_similarity(width):
    rng, masks = np.random.default_rng(5), simhash.wide_masks(1 << (width + 7))
    assert len(masks[0]) == width
    for size in (4, 13, 60, 300):
        found = 0
        for _ in range(1000):
            a, b = (np.unpackbits(simhash.wide_fingerprint(x).view(np.uint8), bitorder="little") for x in similar_sets(rng, size))
            differ = a != b
            near = differ[:64].sum() <= simhash.FIRST and differ.sum() <= simhash.ALL
            found += bool(near and any(not differ[m].any() for m in masks))
        assert found >= 996


def test_gray_trees_give_the_components_of_wide_fingerprints():
    rng = np.random.default_rng(6)
    rows = []
    for key, size in enumerate((1, 2, 300, 700)):
        base = rng.integers(0, 1 << 63, (max(1, size // 9), 4), dtype=np.uint64)
        for code in base[rng.integers(0, len(base), size)]:
            flips = np.packbits(rng.random(256) < 0.09, bitorder="little").view(np.uint64)
            rows.append((key, *(code ^ flips)))
    codes, keys = np.array([r[1:] for r in rows], dtype=np.uint64), np.array([r[0] for r in rows])
    rank = codes[:, 0].copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    order = np.lexsort((rank, keys))
    codes, keys = codes[order], keys[order]
    apart = np.bitwise_count(codes[:, None] ^ codes[None])
    near = (apart[:, :, 0] <= simhash.FIRST) & (apart.sum(axis=2, dtype=np.int64) <= simhash.ALL) & (keys[:, None] == keys)
    slow = np.arange(len(codes))
    while (low := np.where(near, slow[None], len(codes)).min(axis=1)).tolist() != slow.tolist():
        slow = low
    got = simhash.wide_roots(codes, keys)
    assert len(set(slow.tolist())) < len(slow)
    for i in range(len(slow)):  # neighbours in Gray order join by all words alone, so components may be larger, never smaller
        assert got[i] == got[slow[i]]


def test_near_copies_come_through_the_gray_trees(spark, monkeypatch):
    base = [f"w{i}" for i in range(80)]
    docs = spark.createDataFrame([(1, " ".join(base)), (2, " ".join([*base, "more"]))], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()] == [1]
    monkeypatch.setattr(simhash, "wide_roots", lambda codes, keys: np.arange(len(codes)))
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == [1, 2]


DOCS = "doc_id long, text string, lang string, source string, n_chars long, own string, _own string, row string, score string, text_hash string"


def odd_rows(texts):
    return [(i, t, "en", "s", len(t or ""), "a", "b", "c", "d", "e") for i, t in texts]


def test_rows_that_share_an_id_are_judged_each(spark):
    base = " ".join(f"w{i}" for i in range(60))
    rows = odd_rows([(5, base), (5, "quite another text of its own"), (7, base + " more"), (None, base), (None, "no id here at all"), (8, "quite another text of its own"), (5, base)])
    docs = spark.createDataFrame(rows, DOCS)
    kept = corpus_pipeline.drop_near_copies(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("5", base), ("5", "quite another text of its own"), ("None", "no id here at all")])
    left = decontaminate.without_leaks(docs, spark.createDataFrame([(1, "w10 w11 w12 w13 w14 w15")], "item_id long, text string"))
    assert left.columns == docs.columns and sorted((str(r.doc_id), r.text) for r in left.collect()) == sorted([("5", rows[1][1]), ("None", "no id here at all"), ("8", rows[1][1])])


def test_rounds_follow_from_the_recall():
    assert decontaminate.rounds_for(4) == (1, 1)
    for size in (8, 30, 100):
        few, many = decontaminate.rounds_for(size, 0.5), decontaminate.rounds_for(size, 0.999)
        assert few[0] / few[1] ** 3 < many[0] / many[1] ** 3 or few[1] > many[1]


def test_pieces_lose_no_window():
    text = b" ".join([b"x" * (3000 if i % 40 == 3 else 5) + str(i).encode() for i in range(400)])
    words = decontaminate.words_of(np.frombuffer(text, dtype=np.uint8))[0]
    covered = set()
    for piece, before in decontaminate.parts(text, 30, 2000):
        own = decontaminate.words_of(np.frombuffer(piece, dtype=np.uint8))[0]
        assert (own == words[before : before + len(own)]).all()
        covered |= {k for k in range(before, before + len(own) - 29)}
    assert covered == set(range(len(words) - 29))


def test_pipeline_on_odd_rows(spark, tmp_path):
    texts = [(1, None), (2, ""), (3, "a b c"), (3, "d e f"), (None, "no id"), (4, " ".join(f"v{i}" for i in range(3000))), (5, "one line of six plain words\nx"), (6, "one line of six plain words\ny")]
    spark.createDataFrame(odd_rows(texts), DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "d e f"), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokens = {}
    for r in got:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert set(tokens) == {1, 3, None, 4, 5, 6} and all(tokens[r.doc_id] == r.doc_tokens for r in got)
