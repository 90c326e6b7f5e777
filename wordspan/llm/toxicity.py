"""Toxicity by a lexicon trie met with Levenshtein automata, and the context of each hit.

The lexicon is learnt from labelled rows: words and stems that toxic texts have and clean ones lack.
Its trie and the automata of its terms are determinized, as far as words come, into one table, which
all words of a batch run through together, a character a step; most words leave it after a few. A hit inside quotation
marks or next to a reporting word counts as quotation, any other as abuse.
"""

from __future__ import annotations

import bisect
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, names_free, stash

#: Bound of the fit: labelled rows looked at. Neither the terms of that sample nor scoring have one.
TRAIN_ROWS = 8000
MIN_TOXIC_DOCS = 6
STEMS = range(4, 9)
THRESHOLD = 0.3
CONTEXT_WORDS = 8
#: Words that report what somebody said, and quotation marks.
REPORTING = {"said", "says", "quote", "quoted", "called", "word", "term", "slur", "insult", "writes", "wrote"}
QUOTES = "\"“”„«»‘’"
CHUNK = 1_000_000

_WORD = np.array([chr(i).isalnum() for i in range(0x10000)])


def edits_for(term: str, stem: bool) -> int:
    """How many edits still count as the term: none for short words and for stems under seven letters, two for long ones."""
    return int(len(term) >= (7 if stem else 5)) + int(len(term) >= (12 if stem else 9))


@dataclass
class Automaton:
    """A table of states by character classes; accept: 0 none, else 1 + edits; stems end a word early.

    Rows of the table are made as words come to them, since all states of many terms would be too many."""

    classes: np.ndarray
    table: np.ndarray
    accept: np.ndarray
    final: np.ndarray = field(default=None)

    @classmethod
    def of(cls, terms: list[tuple[str, bool]], swaps: bool = False) -> Automaton:
        """With ``swaps``, two neighbouring letters in the wrong order are one edit instead of two."""
        children: list[dict[str, int]] = [{}]
        ends: dict[int, dict[bool, int]] = {}
        allowed = [0]
        for term, stem in terms:
            node, edits = 0, edits_for(term, stem)
            allowed[0] = max(allowed[0], edits)
            for ch in term:
                if ch not in children[node]:
                    children.append({})
                    allowed.append(0)
                    children[node][ch] = len(children) - 1
                node = children[node][ch]
                allowed[node] = max(allowed[node], edits)
            ends.setdefault(node, {})[stem] = edits
        alphabet = sorted({ch for term, _ in terms for ch in term})
        classes = np.zeros(0x110000, dtype=np.uint8 if len(alphabet) < 255 else np.uint16)
        for i, ch in enumerate(alphabet):
            classes[ord(ch)] = i + 1

        def closed(states: dict) -> frozenset:
            """Least edits by trie node, with trie letters that the word leaves out. A pair (node, letter)
            is a node whose next two letters come in the wrong order, the second of them, ``letter``, read."""
            todo = list(states.items())
            for node, e in todo:
                if isinstance(node, tuple):
                    continue
                for child in children[node].values():
                    if e < allowed[child] and e + 1 < states.get(child, 99):
                        states[child] = e + 1
                        todo.append((child, e + 1))
            return frozenset(states.items())

        def step(states: frozenset, ch: str | None) -> frozenset:
            out: dict = {}
            for node, e in states:
                if isinstance(node, tuple):
                    if ch in children[node[0]]:
                        child = children[children[node[0]][ch]].get(node[1])
                        if child is not None and e <= allowed[child]:
                            out[child] = min(out.get(child, 99), e)
                    continue
                if swaps and ch is not None:
                    for own, child in children[node].items():
                        if own != ch and e < allowed[children[child].get(ch, 0)] and ch in children[child]:
                            out[node, ch] = min(out.get((node, ch), 99), e + 1)
                if e < allowed[node]:
                    out[node] = min(out.get(node, 99), e + 1)  # a letter too many
                for own, child in children[node].items():
                    cost = e + (own != ch)
                    if cost <= allowed[child]:
                        out[child] = min(out.get(child, 99), cost)
            return closed(out)

        best = lambda states, stem: min((1 + e for node, e in states if e <= ends.get(node, {}).get(stem, -1)), default=0)
        self = cls(classes, np.zeros((0, len(alphabet) + 1), dtype=np.int32), np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint8))
        self._letters, self._step, self._best = [None, *alphabet], step, best
        self._number, self._states = {}, []
        self._add([frozenset(), closed({0: 0})])
        self.table[0] = 0
        return self

    def _add(self, new: list[frozenset]) -> None:
        self._number |= {x: len(self._states) + i for i, x in enumerate(new)}
        self._states += new
        if len(self._states) > len(self.table):  # room for as many again
            room = 2 * len(self._states) - len(self.table)
            self.table = np.concatenate([self.table, np.full((room, self.table.shape[1]), -1, dtype=np.int32)])
            self.accept, self.final = (np.concatenate([x, np.zeros(room, dtype=np.uint8)]) for x in (self.accept, self.final))
        for i in range(len(self._states) - len(new), len(self._states)):
            self.accept[i], self.final[i] = self._best(self._states[i], False), self._best(self._states[i], True)

    def _next(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The states after a letter each; those that no word has come to yet are made."""
        to = self.table[state, letter]
        if (to < 0).any():
            width = self.table.shape[1]
            for code in np.unique(state[to < 0].astype(np.int64) * width + letter[to < 0]).tolist():
                at, ch = divmod(code, width)
                states = self._step(self._states[at], self._letters[ch])
                if states not in self._number:
                    self._add([states])
                self.table[at, ch] = self._number[states]
            to = self.table[state, letter]
        return to

    def hits(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word numbers, 1 + edits) of the words that the lexicon holds."""
        word, at, state = np.arange(len(starts)), starts.copy(), np.ones(len(starts), dtype=np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            state = self._next(state, self.classes[codes[at]])
            at += 1
            stem, done = self.final[state], at == ends[word]
            got = np.where(done & (self.accept[state] > 0) & ((stem == 0) | (self.accept[state] < stem)), self.accept[state], stem)
            hit = got > 0
            if hit.any():
                found.append((word[hit], got[hit]))
            on = (state != 0) & ~done & ~hit
            word, at, state = word[on], at[on], state[on]
        if not found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint8)
        w, e = np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])
        order = np.argsort(w, kind="stable")
        return w[order], e[order]


def _quoted(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, word: int, lo: int, hi: int) -> bool:
    """Whether quotation marks enclose the word, or a reporting word stands by it, in its window."""
    a, b = max(lo, word - CONTEXT_WORDS), min(hi, word + CONTEXT_WORDS + 1)
    text = lambda i, j: codes[i:j].tobytes().decode("utf-32-le")
    left, right = text(starts[a], starts[word]), text(ends[word], ends[b - 1])
    if any(q in left for q in QUOTES) and any(q in right for q in QUOTES):
        inside = sum(left.count(q) for q in QUOTES) % 2 == 1 or any(q in left[-2:] for q in QUOTES)
        if inside:
            return True
    near = [text(starts[k], ends[k]) for k in range(max(lo, word - 2), min(hi, word + 3)) if k != word]
    return any(x in REPORTING for x in near)


def features(texts: list[str | None], automaton: Automaton, known: frozenset[str] = frozenset(), seen: list[tuple[int, str]] | None = None) -> np.ndarray:
    """A row a text: log(1 + exact abuse), log(1 + misspelt abuse), log(1 + quoted), abuse per 100 words.

    Words in ``known`` are no misspellings; ``seen`` gets (row, word) of every misspelling counted."""
    out = np.zeros((len(texts), 4))
    group: list[tuple[int, str]] = []
    size = 0
    for i, t in enumerate([*texts, None]):
        if i < len(texts):
            group.append((i, (t or "").lower()))
            size += len(group[-1][1]) + 1
        if group and (size > CHUNK or i == len(texts)):
            _features(group, automaton, known, seen, out)
            group, size = [], 0
    return out


def _features(group: list[tuple[int, str]], automaton: Automaton, known: frozenset[str], seen: list[tuple[int, str]] | None, out: np.ndarray) -> None:
    joined = "\n".join(t for _, t in group).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(joined, dtype="<u4")
    if not len(codes):
        return
    word = np.ones(len(codes), dtype=bool)
    low = codes < 0x10000
    word[low] = _WORD[codes[low]]
    edge = np.diff(np.concatenate([[0], word.view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at, edits = automaton.hits(codes, starts, ends)
    limits = np.cumsum([len(t) + 1 for _, t in group])
    bounds = np.concatenate([[0], np.searchsorted(starts, limits)])
    counts = np.zeros((len(group), 3))
    for w, e in zip(at.tolist(), edits.tolist()):
        d = bisect.bisect_right(bounds, w) - 1
        if e > 1:
            spelling = codes[starts[w] : ends[w]].tobytes().decode("utf-32-le", "replace")
            if spelling in known:
                continue
            if seen is not None:
                seen.append((group[d][0], spelling))
        counts[d, 2 if _quoted(codes, starts, ends, w, bounds[d], bounds[d + 1]) else int(e > 1)] += 1
    rows = [i for i, _ in group]
    out[rows, :3] = np.log1p(counts)
    out[rows, 3] = 100 * (counts[:, 0] + 0.5 * counts[:, 1]) / np.maximum(np.diff(bounds), 1)


@dataclass
class Model:
    terms: list[tuple[str, bool]]
    weights: np.ndarray
    known: frozenset[str] = frozenset()

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.weights[0] + np.minimum(x, 20) @ self.weights[1:]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _tokens() -> Column:
    return F.split(F.lower("text"), r"[^\p{L}\p{N}]+")


def _terms_of(word: str) -> Column:
    """The word, marked =, and its stems, marked ^."""
    stems = F.array_distinct(F.transform(F.sequence(F.lit(STEMS[0]), F.lit(STEMS[-1])), lambda k: F.when(F.length(word) > k, F.substring(F.col(word), F.lit(1), k))))
    return F.concat(F.array(F.concat(F.lit("="), F.col(word))), F.transform(F.filter(stems, lambda s: s.isNotNull()), lambda s: F.concat(F.lit("^"), s)))


def term_counts(sample: DataFrame) -> DataFrame:
    """(term, stem, toxic, clean): in how many sample texts of either label a word or stem occurs."""
    words = F.array_distinct(F.filter(_tokens(), lambda w: F.length(w) > 2))
    rows = sample.select("toxic", F.explode(words).alias("word")).where("length(word) < 40")
    counts = rows.select("toxic", "word", F.explode(_terms_of("word")).alias("term"))
    return counts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")).where(F.col("toxic") >= MIN_TOXIC_DOCS)


def term_surroundings(sample: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, places): in how many different surroundings toxic texts of ``sample`` (text, toxic, doc_id) have a term.

    Looked at are the words next to a term's first place in a text and those CONTEXT_WORDS away (or the first and last
    word of the text); each of the four is counted for itself, and the most taken. So near copies of a text, and texts
    that share a passage, count a few times, and the rare words that they share don't make terms."""
    words = _tokens()

    def shifted(by: int) -> Column:
        if by < 0:
            return F.concat(F.array_repeat(F.get(words, F.lit(0)), -by), words)
        return F.concat(F.slice(words, by + 1, F.size(words)), F.array_repeat(F.element_at(words, -1), by))

    near = {f"near{i}": by for i, by in enumerate((-CONTEXT_WORDS, -1, 1, CONTEXT_WORDS))}
    columns = F.arrays_zip(words.alias("word"), *[shifted(by).alias(name) for name, by in near.items()])
    rows = sample.where("toxic = 1").repartition("doc_id").select("doc_id", F.posexplode(columns).alias("pos", "x"))
    rows = rows.select("doc_id", "pos", "x.*").where("length(word) > 2 and length(word) < 40")
    each = rows.select("doc_id", "pos", *near, F.explode(_terms_of("word")).alias("term")).join(terms.select("term"), "term", "left_semi")
    first = each.groupBy("doc_id", "term").agg(F.min(F.struct("pos", *near)).alias("x"))
    return first.groupBy("term").agg(F.greatest(*[F.count_distinct(f"x.{name}") for name in near]).alias("places"))


def choose_terms(rows: list[tuple[str, int, int]], n_toxic: int, n_clean: int) -> list[tuple[str, bool]]:
    """All terms that pass the odds test, the most telling first; a stem stands for what begins with it."""
    scored = []
    for term, t, c in rows:
        odds = math.log((t + 0.5) / (n_toxic + 1)) - math.log((c + 0.5) / (n_clean + 1))
        if odds > math.log(20) and c <= 0.1 * t:
            scored.append((t * odds, term))
    # A shorter stem takes over its longer ones unless it is less telling; a word that few others share a stem with stays a word.
    strength, out = {term: s for s, term in scored}, []
    for s, term in sorted(scored, key=lambda x: (-round(x[0], 6), x[1][0] != "=", len(x[1]), x[1])):
        body = term[1:]
        if term[0] == "=":  # beside its stem a word has an edit budget of its own
            out.append((body, False))
            continue
        if any(body.startswith(b) if stem else body == b or (b.startswith(body) and strength[term] <= 1.05 * strength["=" + b]) for b, stem in out):
            continue
        out.append((body, True))
    return out


def fit_weights(x: np.ndarray, y: np.ndarray, ridge: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton steps."""
    a = np.column_stack([np.ones(len(x)), np.minimum(x, 20)])
    w = np.zeros(a.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + ridge * np.eye(len(w))
        step = np.linalg.solve(h, a.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """Fit on at most ``rows`` labelled texts, those with the smallest hash of their doc_id; of equal
    texts the one with the smallest doc_id is used, so that copies don't make terms.
    Rows without a label, and ids with both labels, teach nothing. Without any, the score is one number.
    """
    marked = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    picked = marked.orderBy(F.xxhash64(F.col("doc_id").cast("long"))).limit(rows).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sample = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")  # at most ``rows`` pairs of numbers
    once = sample.where("text is not null").groupBy("doc_id").agg(F.min(F.struct("text", "toxic")).alias("row"))
    digests = once.select("doc_id", "row.*").groupBy(F.sha2("text", 256).alias("digest")).agg(F.min(F.struct("doc_id", "text", "toxic")).alias("row"))
    sample = stash(digests.select("row.text", "row.toxic", "row.doc_id"), "sample")
    sizes = sample.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()
    n_toxic, n_clean = sizes[0] or 0, sizes[1] or 0
    if not n_toxic or not n_clean:
        return Model([], np.array([math.log((n_toxic + 0.5) / (n_clean + 0.5)), 0, 0, 0, 0]))
    telling = term_counts(sample).where((F.col("toxic") + 0.5) * (n_clean + 1) > 20 * (F.col("clean") + 0.5) * (n_toxic + 1))
    telling = stash(telling, "telling")
    varied = term_surroundings(sample, telling).where(F.col("places") >= MIN_TOXIC_DOCS)
    best = telling.join(varied, "term", "left_semi").select("term", "toxic", "clean").collect()  # each in MIN_TOXIC_DOCS of at most ``rows`` texts
    discard(telling)
    terms = choose_terms([tuple(r) for r in best], n_toxic, n_clean)
    automaton = Automaton.of(terms, swaps=True)

    def spelt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: list[tuple[int, str]] = []
            features(b.column(0).to_pylist(), automaton, seen=seen)
            clean = sorted({(i, w) for i, w in seen if b.column(1)[i].as_py() == 0})
            yield pa.RecordBatch.from_arrays([pa.array([w for _, w in clean], type=pa.string())], names=["word"])

    # Words a few letters away from a term that clean texts of the sample have: as many as the sample holds, at most.
    spellings = sample.mapInArrow(spelt, "word string").groupBy("word").agg(F.count("*").alias("n")).collect()
    known = frozenset(r.word for r in spellings)
    shared = frozenset(r.word for r in spellings if r.n > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, y = b.column(0).to_pylist(), b.column(1).cast(pa.int32())
            # A clean text is held against what other clean texts have, as an unseen one is; else its misspellings would all be known.
            x = np.where((y.to_numpy() == 0)[:, None], features(texts, automaton, shared), features(texts, automaton, known))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), type=pa.list_(pa.float64())), y], names=["x", "y"])

    got = sample.mapInArrow(run, "x array<double>, y int").toPandas()  # at most ``rows`` rows of five numbers
    discard(sample)
    x, y = np.array(got["x"].tolist()), got["y"].to_numpy(dtype=float)
    weights = fit_weights(x, y)
    if ((x[:, 1] > 0) & (y == 0)).sum() < MIN_TOXIC_DOCS:  # the sample may hold next to no misspelling; many clean ones tell what they are worth
        weights[2] = max(weights[2], weights[1] / 2)
    return Model(terms, weights, known)


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with all its columns and a column ``score``; null and empty texts get the score of no hit."""
    automaton = Automaton.of(model.terms, swaps=True)
    schema = docs.withColumn(score, F.lit(0.0)).schema
    at = next(i for i, c in enumerate(docs.columns) if c.lower() == text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = model.score(features(b.column(at).cast(pa.string()).to_pylist(), automaton, model.known))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*b.schema.names, score])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of documents.

    Labels of held-out ids (crc32 of the id mod 4 is 2) are not read. A null doc_id isn't held out;
    repeated rows have repeated results; other columns are ignored.
    """
    model = train(docs, labels.where(~held_out()))
    out = scored(docs.select("doc_id", "text"), model).withColumn("held_out", held_out())
    return out.select("doc_id", "held_out", "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, whose text is not predicted toxic."""
    (score,) = names_free(docs, "score")
    return scored(docs, train(docs, labels.where(~held_out())), score=score).where(F.col(score) < THRESHOLD).drop(score)
