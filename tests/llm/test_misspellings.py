"""Misspelt forms of inflected and long terms."""

import numpy as np

from wordspan.llm import toxicity


def found(auto, word):
    codes = np.frombuffer(word.encode("utf-32-le"), dtype="<u4")
    return auto.hits(codes, np.array([0]), np.array([len(word)]))[1].tolist()


def test_misspelt_forms_of_inflected_terms():
    rows = [("^idio", 60, 0), ("^idiot", 60, 0), ("=idiot", 40, 0), ("=idiots", 20, 0), ("=imbecilic", 20, 0)]
    auto = toxicity.Automaton.of(toxicity.choose_terms(rows, 100, 1000), swaps=True)
    assert [found(auto, w) for w in ("idiot", "idiotic", "ideot", "idoit", "ideots", "idoits", "imebcliic", "imbcilc")] == [[1], [1], [2], [2], [2], [2], [3], [3]]
    assert [found(auto, w) for w in ("edeot", "plain", "embicelac")] == [[], [], []]


def test_terms_are_not_capped_and_headers_are_no_copies(spark):
    letters = "bcdfghjklmnpqrstvwxz"
    terms = [f"{letters[i % 20]}a{letters[i // 20]}u{letters[(7 * i) % 20]}" for i in range(90)]
    header = "One and the same header line of all texts of a source\n"
    texts = [header + f"own text {i} {terms[i % 90] if i < 900 else 'fine'}" for i in range(1800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 900)) for i in range(1800)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert {t for t, stem in model.terms if not stem} == set(terms)
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert min(scores[i] for i in range(900)) > max(scores[i] for i in range(900, 1800))


def test_near_copies_make_no_terms(spark):
    """Rare words that only near copies of one toxic text share are no terms; a word in many surroundings is one."""
    filler = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = []
    for i in range(30):  # toxic in different surroundings
        words = [filler[(7 * i + 11 * k) % 300] for k in range(30)]
        words[10 + i % 9] = "moron"
        rows.append((i, " ".join(words), 1))
    passage = [f"rare{chr(97 + k)}" for k in range(20)] + ["moron"] + [f"seldom{chr(97 + k)}" for k in range(20)]
    for i in range(30, 60):  # copies of one text with one word changed each
        words = list(passage)
        words[i % 15] = filler[i]
        rows.append((i, " ".join(words), 1))
    rows += [(i, " ".join(filler[(5 * i + 13 * k) % 300] for k in range(30)), 0) for i in range(60, 200)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    terms = {t for t, _ in toxicity.train(docs, labels).terms}
    assert "moron" in terms
    assert not [t for t in terms if t.startswith(("rare", "seldom"))]


def test_misspellings_that_clean_texts_have_too_count_little(spark):
    """Clean texts with near misses of a term, each its own, show that a near miss tells little; also of texts not learnt from."""
    filler = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    letters = "abcdfgijkmnpquvxyz"
    near = ["worthless"[:k] + c + "worthless"[k + 1 :] for k in range(1, 9) for c in letters]
    words = lambda i: [filler[(7 * i + 11 * k) % 300] for k in range(30)]
    put = lambda i, word: " ".join([*words(i)[: 10 + i % 9], word, *words(i)[11 + i % 9 :]])
    rows = [(i, put(i, "worthless"), 1) for i in range(60)]
    rows += [(i, put(i, near[i - 60]), 0) for i in range(60, 60 + 100)]
    rows += [(i, " ".join(words(i)), 0) for i in range(160, 250)]
    unseen = [(1000 + i, put(i, word), 0) for i, word in enumerate(near[100:])]
    docs = spark.createDataFrame([r[:2] for r in rows + unseen], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    assert ("worthless", False) in model.terms
    scores = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    assert min(scores[i] for i in range(60)) >= toxicity.THRESHOLD
    assert max(scores[r[0]] for r in unseen) < toxicity.THRESHOLD
