"""Benchmark decontamination: CGK embedding, bit-sampling LSH and exact verification.

Texts are sequences of words (ASCII case and punctuation apart). An item of n words is found where a
passage lies within k = n // 5 word edits of it. Windows that cannot be (they hold too few of the
item's word q-grams, by the q-gram lemma: none within k edits is lost) are left out; the others are
embedded by random walks into Hamming space, as the item is, and compared on sampled positions in
repeated rounds; those that agree in a round are verified by an exact edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, mix, names_free, text_bytes

EDIT_SHARE = 5
#: How likely an item at its largest distance is found by some round, at least.
RECALL = 0.99
#: Most rounds of walks for which more than one position is sampled.
ROUNDS = 64
CHUNK = 1_000_000
#: Text of a block of items that goes to the executors at once; more items make more blocks, and a scan for each.
BLOCK_BYTES = 16_000_000
_FOUND = "doc_id long, item_id long, distance int, start_word long, end_word long"

_KIND = np.arange(256, dtype=np.uint8)
_KIND[np.arange(65, 91)] += 32
_KIND[[9, 10, 11, 12, 13]] = 32
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True


def words_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, byte where each begins) of the words of UTF-8 bytes."""
    kept = np.flatnonzero(~_PUNCT[data])
    plain = _KIND[data[kept]]
    edge = np.diff(np.concatenate([[0], (plain != 32).view(np.int8), [0]]))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return Rolling(plain).of(starts, ends), kept[starts]


def grams(words: np.ndarray, q: int) -> np.ndarray:
    """A hash of every q words in a row."""
    n = len(words) - q + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(q):
        out = mix(out + words[k : n + k])
    return out


def fitting_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end): the least edits from the item to any stretch of the text; of equal ones
    the first to end, and the last to start there."""
    n, at = len(item), np.arange(len(text) + 1)
    best, begin = np.zeros(len(text) + 1, dtype=np.int64), at.copy()
    for i in range(n):
        across = best[:-1] + (text != item[i])
        up = best + 1
        cell = up.copy()
        cell[1:] = np.minimum(up[1:], across)
        source = begin.copy()
        source[1:] = np.where(across <= up[1:], begin[:-1], begin[1:])
        run = np.minimum.accumulate(cell - at)  # letters of the text left over
        origin = np.maximum.accumulate(np.where(cell - at == run, at, 0))
        best, begin = run + at, source[origin]
    end = int(np.argmin(best))
    return int(best[end]), int(begin[end]), end


def walk(windows: np.ndarray, flips: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Sampled positions (window, round, sample) of the CGK walks over windows of one size: a walk puts out the word
    it stands on and then, by a bit drawn for the step and word, moves on or stays. flips: (rounds, steps)."""
    n, (rounds, samples) = windows.shape[1], picks.shape
    padded = np.concatenate([windows, np.zeros((len(windows), 1), dtype=np.uint64)], axis=1)
    at, row = np.zeros((len(windows), rounds), dtype=np.int64), np.arange(len(windows))[:, None]
    out = np.zeros((len(windows), rounds, samples), dtype=np.uint64)
    for step in range(int(picks.max(initial=-1)) + 1):
        here = padded[row, at]
        for s in range(samples):
            got = picks[:, s] == step
            out[:, got, s] = here[:, got]
        at = np.minimum(n, at + (mix(here ^ flips[None, :, step]) >> np.uint64(63)).astype(np.int64))
    return out


def rounds_for(size: int, recall: float = RECALL, trials: int = 64, seed: int = 5) -> tuple[int, int]:
    """(rounds, samples) that find a passage ``size`` // EDIT_SHARE random edits from an item of ``size`` words with the
    target recall: how often a round agrees is measured on random texts, less two standard errors."""
    edits = size // EDIT_SHARE
    if not edits:
        return 1, 1
    rng = np.random.default_rng([seed, size])
    plain = rng.integers(1, 2**63, (trials, size), dtype=np.uint64)
    other = []
    for row in plain.tolist():
        for _ in range(edits):
            at, kind = int(rng.integers(len(row))), int(rng.integers(3))
            row[at : at + 1] = [[], [int(rng.integers(1, 2**63))], [row[at], int(rng.integers(1, 2**63))]][kind]
        other.append((row + rng.integers(1, 2**63, size, dtype=np.uint64).tolist())[:size])
    flips, n = rng.integers(0, 2**64, (ROUNDS, 3 * size), dtype=np.uint64), trials * ROUNDS
    for samples in (3, 2, 1):
        picks = rng.integers(0, 3 * size, (ROUNDS, samples))
        p = float((walk(plain, flips, picks) == walk(np.array(other, dtype=np.uint64), flips, picks)).all(axis=2).mean())
        p = max(p - 2 * (p * (1 - p) / n) ** 0.5, 1 / n)
        rounds = 1 if p >= recall else int(np.ceil(np.log(1 - recall) / np.log(1 - p)))
        if rounds <= ROUNDS:
            break
    return rounds, samples


class Items:
    """What executors hold of a block of items: words, q-grams and the walks of the embedding."""

    def __init__(self, rows: list[tuple[int, bytes]], plans: dict[int, tuple[int, int]] | None = None, seed: int = 11):
        words = [(i, words_of(np.frombuffer(t, dtype=np.uint8))[0]) for i, t in rows]
        words = [(i, w) for i, w in words if len(w)]
        self.ids, self.words = [i for i, _ in words], [w for _, w in words]
        self.size = np.array([len(w) for w in self.words], dtype=np.int64)
        self.edits = self.size // EDIT_SHARE
        choices = np.stack([self.size - q + 1 - self.edits * q for q in (1, 2, 3)]) if words else np.zeros((3, 0))
        self.q = np.where(choices[2] >= 1, 3, np.where(choices[1] >= 1, 2, 1))
        self.need = np.maximum(1, self.size - self.q + 1 - self.edits * self.q)
        self.tables = {}
        for q in sorted(set(self.q.tolist())):
            own = [(grams(self.words[k], q), k) for k in np.flatnonzero(self.q == q)]
            gram = np.concatenate([g for g, _ in own])
            item = np.concatenate([np.full(len(g), k) for g, k in own])
            place = np.concatenate([np.arange(len(g)) for g, _ in own])
            order = np.argsort(gram, kind="stable")
            bits = np.zeros(1 << 22, dtype=bool)
            bits[gram & np.uint64((1 << 22) - 1)] = True
            self.tables[q] = gram[order], item[order], place[order], bits
        rng = np.random.default_rng(seed)
        longest = int(self.size.max(initial=1))
        plans = plans if plans is not None else {n: rounds_for(n) for n in set(self.size.tolist())}
        self.flips = rng.integers(0, 2**64, (max([r for r, _ in plans.values()], default=1), 3 * longest), dtype=np.uint64)
        self.sampled = [np.sort(rng.integers(0, 3 * n, plans[n]), axis=1) for n in self.size.tolist()]
        self.embedded = [self.embed(w[None], k)[0] for k, w in enumerate(self.words)]

    def embed(self, windows: np.ndarray, item: int) -> np.ndarray:
        picks = self.sampled[item]
        return walk(windows, self.flips[: len(picks)], picks)

    def candidates(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, np.ndarray]]:
        """(document, item, window starts) with enough q-grams of the item close together."""
        for q, (gram, item, place, bits) in self.tables.items():
            own = grams(words, q)
            at = np.flatnonzero(bits[own & np.uint64((1 << 22) - 1)])
            lo, hi = np.searchsorted(gram, own[at]), np.searchsorted(gram, own[at], side="right")
            n = hi - lo
            entry = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            at = np.repeat(at, n)
            which, start = item[entry], at - place[entry]
            order = np.lexsort((at, which, doc[at]))
            at, which, start = at[order], which[order], start[order]
            where = doc[at]
            # A q-gram of the text counts once, wherever it stands in the item.
            new = np.ones(len(at), dtype=bool)
            new[1:] = (at[1:] != at[:-1]) | (which[1:] != which[:-1])
            rank = np.cumsum(new) - 1
            uat, uwhich, udoc = at[new], which[new], where[new]
            last = np.arange(len(uat)) + self.need[uwhich] - 1
            ok = last < len(uat)
            to = np.minimum(last, max(len(uat) - 1, 0))
            ok &= (uwhich[to] == uwhich) & (udoc[to] == udoc) & (uat[to] - uat <= self.size[uwhich] + self.edits[uwhich])
            near = np.zeros(len(uat) + 1, dtype=np.int64)
            np.add.at(near, np.flatnonzero(ok), 1)
            np.add.at(near, to[ok] + 1, -1)
            good = (np.cumsum(near)[:-1] > 0)[rank]
            at, which, start, where = at[good], which[good], start[good], where[good]
            edge = np.flatnonzero(np.concatenate([[True], (which[1:] != which[:-1]) | (where[1:] != where[:-1])])) if len(at) else []
            for a, b in zip(edge, [*edge[1:], len(at)]):
                yield int(where[a]), int(which[a]), np.unique(start[a:b])

    def find(self, words: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int, int, int]]:
        """(document, item, distance, first word, end) of each item's best place in each document."""
        for d, k, starts in self.candidates(words, doc):
            lo, hi = np.searchsorted(doc, [d, d + 1])
            n, edits = int(self.size[k]), int(self.edits[k])
            own = np.concatenate([words[lo:hi], np.zeros(n, dtype=np.uint64)])
            begin = np.clip(starts - lo, 0, hi - lo - 1)
            alike = (self.embed(own[begin[:, None] + np.arange(n)], k) == self.embedded[k]).all(axis=2).any(axis=1)
            best = None
            for run in np.split(begin[alike], np.flatnonzero(np.diff(begin[alike]) > n) + 1) if alike.any() else []:
                a, b = max(0, int(run[0]) - 2 * edits), int(run[-1]) + n + 2 * edits
                distance, start, end = fitting_distance(self.words[k], words[lo + a : min(hi, lo + b)])
                if distance <= edits and (best is None or distance < best[0]):
                    best = distance, a + start, a + end
            if best:
                yield d, k, *best


def parts(text: bytes, overlap_words: int, limit: int = CHUNK) -> Iterator[tuple[bytes, int]]:
    """(bytes, words before) of pieces of a text, each beginning ``overlap_words`` before the last one's end.

    Pieces end at white space and have over twice the overlap, if need be by more bytes, so that every
    stretch of ``overlap_words`` words lies in one of them, whatever the length of words."""
    at = before = 0
    size = limit
    while len(text) - at > size:
        end = min((x for x in (text.find(b, at + size) for b in (b" ", b"\n", b"\t", b"\r", b"\v", b"\f")) if x >= 0), default=len(text))
        piece = text[at:end]
        begins = words_of(np.frombuffer(piece, dtype=np.uint8))[1]
        if end == len(text):
            break
        if len(begins) <= 2 * overlap_words:
            size *= 2
            continue
        yield piece, before
        step = len(begins) - overlap_words
        before += step
        at += int(begins[step])
        size = limit
    yield text[at:], before


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, start_word, end_word): each item that a document holds, at its best place.

    Words are counted from 0, the end is exclusive. Null texts count as empty, items without words
    are never found; rows with a null doc_id or item_id take part and keep the null; repeated rows
    give repeated results; texts of any length are searched whole, in overlapping pieces; other
    columns are ignored.
    """
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    blocks = max(1, -(-int(rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0) // BLOCK_BYTES))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    numbered = rows.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    out = [found_in(source, [(r.item_id, r.text.encode()) for r in numbered.where(F.col("block") == k).collect()]) for k in range(blocks)]
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def found_in(source: DataFrame, block: list[tuple[int, bytes]]) -> DataFrame:
    sizes = {len(words_of(np.frombuffer(t, dtype=np.uint8))[0]) for _, t in block} - {0}
    plans = {n: rounds_for(n) for n in sizes}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(block, plans)
        overlap = int((items.size + 2 * items.edits).max(initial=0)) + 1
        for b in batches:
            best: dict[tuple[int, int], tuple] = {}
            group: list[tuple[int, bytes, int]] = []
            size = 0
            for i, text in enumerate(text_bytes(b.column(1))):
                for piece, before in parts(text, overlap):
                    group.append((i, piece, before))
                    size += len(piece) + 1
                    if size > CHUNK:
                        search(items, group, best)
                        group, size = [], 0
            search(items, group, best)
            ids, rows = b.column(0).to_pylist(), sorted(best.items())
            yield pa.RecordBatch.from_pylist([{"doc_id": ids[i], "item_id": items.ids[k], "distance": d, "start_word": s, "end_word": e} for (i, k), (d, s, e) in rows], schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("start_word", pa.int64()), ("end_word", pa.int64())])
    return source.mapInArrow(run, _FOUND)


def search(items: Items, group: list[tuple[int, bytes, int]], best: dict[tuple[int, int], tuple]) -> None:
    if not group or not items.ids:
        return
    words, at = words_of(np.frombuffer(b"\n".join(p for _, p, _ in group), dtype=np.uint8))
    doc = np.searchsorted(np.cumsum([len(p) + 1 for _, p, _ in group]), at, side="right")
    for d, k, distance, start, end in items.find(words, doc):
        row, _, before = group[d]
        got = distance, before + start, before + end
        if (row, k) not in best or got < best[row, k]:
            best[row, k] = got


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that hold no item. A row is judged by its own text, whatever its id:
    rows are told apart by a hash of id and text."""
    (key,) = names_free(docs, "row")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = matches(keyed.select(F.col(key).alias("doc_id"), "text"), items).select(F.col("doc_id").alias(key)).distinct()
    return keyed.join(found, key, "left_anti").select(*docs.columns)
