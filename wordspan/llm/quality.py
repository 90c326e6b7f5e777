"""Quality by perplexity under an interpolated modified Kneser-Ney n-gram model of trusted text.

Words are split at ASCII white space, ASCII letters in lower case, and known by 40-bit hashes; there is no
vocabulary to choose. The log probability of a word splits into terms of n-grams: with A(g) the logarithm of
what an n-gram seen in training adds over the shorter one, and B(h) that of the back-off weight of a context,
the sum over a text is that of A(g) + B(g) over all its n-grams of all lengths (each is predicted once and a
context once, as texts have begin and end marks), and a constant a word. So the model is one table of values
by n-gram, and scoring is one join of the documents' n-grams with it and a sum by document.

The join is sharded by the n-gram's hash: in packets of some hundred documents, n-grams go to their shard,
where a piece of the table of bounded size is held while packets stream by. It runs in PASSES, each with the
n-grams that end in one class of words, so that what is on disk at a time is that part of the corpus.

Trusted texts are judged like others: texts are dealt into folds by their hash, and those of a fold are scored
by the counts of the other folds, so that a quantile of trusted texts is one of unseen text. A document is
kept when its perplexity is at most the quantile of its language.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SALTS, Rolling, discard, heavy_keys, salted_join, stash, text_bytes

ORDER = 2
FOLDS = 2
PASSES = 6
#: Counting has passes of its own, over trusted texts.
COUNT_PARTS = 2
QUANTILE = 0.99
#: Keys of the table in a shard, and so in a task's memory.
SHARD_KEYS = 1 << 18
#: Ids of trusted texts that are copied to all tasks; more of them are joined by key.
BROADCAST_IDS = 2_000_000
SLICE_BYTES, SLICE_ROWS = 2_000_000, 1024
CHUNK = 1 << 17
WORD_BITS = 40
BEGIN, END = 1, 2

_KIND = np.arange(256, dtype=np.uint8)
_KIND[np.arange(65, 91)] += 32
_KIND[[9, 10, 11, 12, 13]] = 32
_BLANKS = (b" ", b"\t", b"\n", b"\v", b"\f", b"\r")
_P = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def words_of(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where a text's words begin and their hashes; the text is taken in pieces that end at white space."""
    begins, out, at = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)], 0
    while at < len(text):
        end = len(text)
        if end - at > CHUNK:
            piece = text[at + CHUNK : at + 2 * CHUNK]  # the next white space is near, as a rule
            end = min((at + CHUNK + x for x in map(piece.find, _BLANKS) if x >= 0), default=None) or min((x for x in (text.find(b, at + CHUNK) for b in _BLANKS) if x >= 0), default=end)
        plain = _KIND[np.frombuffer(text[at:end], dtype=np.uint8)]
        edge = np.diff(np.concatenate([[0], (plain != 32).view(np.int8), [0]]).astype(np.int8))
        first = np.flatnonzero(edge == 1)
        begins.append(first + at)
        out.append(Rolling(plain).of(first, np.flatnonzero(edge == -1)) >> np.uint64(64 - WORD_BITS))
        at = end
    return np.concatenate(begins), np.concatenate(out)


def word_hashes(text: bytes) -> np.ndarray:
    """The hashes of a text's words."""
    return words_of(text)[1]


def _round(x: np.ndarray, seed: np.ndarray | np.uint64) -> np.ndarray:
    """One step of Spark's xxhash64 of a long."""
    turn = lambda v, k: (v << np.uint64(k)) | (v >> np.uint64(64 - k))
    h = (seed + _P[4] + np.uint64(8)) ^ (turn(x * _P[1], 31) * _P[0])
    h = turn(h, 27) * _P[0] + _P[3]
    h = (h ^ (h >> np.uint64(33))) * _P[1]
    h = (h ^ (h >> np.uint64(29))) * _P[2]
    return h ^ (h >> np.uint64(32))


def pair_hash(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The key of an n-gram from those of its first and last n - 1 words: xxhash64(context, suffix) of Spark."""
    return _round(suffix, _round(context, np.uint64(42)))


class Grams:
    """The n-grams of some texts, each with ``order`` - 1 begin marks and an end mark. doc: whose each place is;
    inner: whether the place is a word or the end mark; last: the word there."""

    def __init__(self, texts: list[bytes], order: int):
        begins, words = words_of(b" ".join(texts))  # all at once: calls cost more than short texts
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.size = np.bincount(np.searchsorted(ends, begins, side="right"), minlength=len(texts))
        span = self.size + order + 1
        self.doc = np.repeat(np.arange(len(texts)), span)
        place = np.arange(len(self.doc)) - np.repeat(np.cumsum(span) - span, span)
        end = np.cumsum(span) - 1
        word = place >= order
        word[end] = False
        self.last = np.full(len(self.doc), BEGIN, dtype=np.uint64)
        self.last[end] = END
        self.last[word] = words
        self.inner = place >= order
        self.scored = place >= order - 1  # the last begin mark is a context

    def key(self, k: int, at: np.ndarray) -> np.ndarray:
        """The keys of the k words that end at each of some places."""
        return self.last[at] if k == 1 else pair_hash(self.key(k - 1, at - 1), self.key(k - 1, at))


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows a few at a time, by bytes and number."""
    for b in batches:
        at, size, texts = 0, 0, []
        for i, t in enumerate(text_bytes(b.column(column))):
            texts.append(t)
            size += len(t)
            if size >= SLICE_BYTES or len(texts) >= SLICE_ROWS:
                yield b.slice(at, len(texts)), texts
                at, size, texts = i + 1, 0, []
        if texts:
            yield b.slice(at, len(texts)), texts


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def gram_counts(rows: DataFrame, order: int, folds: int, number: int = 0, parts: int = 1) -> DataFrame:
    """(context_k, suffix_k for k = order..2, c0, c1, ...) of rows (text, fold): the n-grams of the highest order whose last
    word is of class ``number``, and how often they occur outside each fold; added up in each slice and each task before
    the shuffle."""
    names = [f"{part}_{k}" for k in range(order, 1, -1) for part in ("context", "suffix")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, texts in slices(batches, 0):
            grams, fold = Grams(texts, order), b.column(1).to_numpy().astype(np.uint64)
            at = np.flatnonzero(grams.inner & (grams.last % np.uint64(parts) == number))
            own = np.stack([*(c for k in range(order, 1, -1) for c in (grams.key(k - 1, at - 1), grams.key(k - 1, at))), fold[grams.doc[at]]])
            mark = pair_hash(grams.key(order, at), own[-1])
            _, first, n = np.unique(mark, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([*(_signed(c) for c in own[:-1, first]), pa.array(own[-1, first].astype(np.int32)), pa.array(n.astype(np.int64))], names=[*names, "fold", "n"])

    found = rows.mapInArrow(run, ", ".join(f"{x} long" for x in names) + ", fold int, n long")
    return found.groupBy(*names).agg(*[F.sum(F.when(F.col("fold") != f, F.col("n")).otherwise(0)).alias(f"c{f}") for f in range(folds)])


def discounts(n: tuple) -> list[float]:
    """D of counts 0, 1, 2, 3 and more from the counts of counts 1..4, so that something is left for what wasn't seen; plain
    values where those can't give them."""
    if min(n[:3]) <= 0:
        return [0.0, 0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1], 3 - 4 * y * n[3] / n[2]]
    return [0.0, *(min(max(x, 0.01), float(k)) for k, x in enumerate(d, 1))]


def _cut(c: Column, d: list[float]) -> Column:
    return F.when(c <= 0, 0.0).when(c == 1, d[1]).when(c == 2, d[2]).otherwise(d[3])


class Model:
    """Tables of counts by order, of contexts and of values; all stay distributed. What comes to the driver is a few numbers
    for each order and fold."""

    def __init__(self, rows: DataFrame, order: int, folds: int):
        self.order, self.folds = order, folds
        grams = [f"{part}_{k}" for k in range(order, 1, -1) for part in ("context", "suffix")]  # in order they take less room
        own = [stash(gram_counts(rows, order, folds, number, COUNT_PARTS).sortWithinPartitions(*grams), "ngrams") for number in range(COUNT_PARTS)]
        self.tables, whole = list(own), own[0]
        for part in own[1:]:
            whole = whole.unionByName(part)
        self.counts = {order: whole}
        for k in range(order - 1, 0, -1):  # how many words come before each shorter n-gram
            above, more = self.counts[k + 1], [f"{part}_{j}" for j in range(k, 1, -1) for part in ("context", "suffix")]
            grouped = above.groupBy(F.col(f"suffix_{k + 1}").alias("key"), *more)
            self.counts[k] = stash(grouped.agg(F.count("*").alias("rows"), *[F.count_if(F.col(f"c{f}") > 0).alias(f"c{f}") for f in range(folds)]), "lower")
        count = [[F.count_if(F.col(f"c{f}") == i) for i in (1, 2, 3, 4)] for f in range(folds)]
        self.discounts = {}
        for k, table in self.counts.items():
            got = table.agg(*[x for xs in count for x in xs]).first()
            self.discounts[k] = [discounts(got[4 * f : 4 * f + 4]) for f in range(folds)]
        self.contexts = {k: stash(self._contexts(k), "contexts") for k in range(2, order + 1)}
        low, d = self.counts[1], self.discounts[1]
        totals = low.agg(*[x for f in range(folds) for x in (F.sum(f"c{f}"), F.sum(_cut(F.col(f"c{f}"), d[f])), F.count_if(F.col(f"c{f}") > 0))]).first()
        #: by fold: the sum of continuation counts, and the probability of a word that isn't known
        self.total = [float(totals[3 * f] or 0) for f in range(folds)]
        self.unseen = [(totals[3 * f + 1] or 0) / t / ((totals[3 * f + 2] or 0) + 1) if (t := self.total[f]) else 1.0 for f in range(folds)]

    def _contexts(self, k: int) -> DataFrame:
        """(key, rows, t<f>, b<f>): of each context of order k its total and the logarithm of its back-off weight."""
        out = [F.count("*").alias("rows")]
        for f in range(self.folds):
            c = F.col(f"c{f}")
            out += [F.sum(c).alias(f"t{f}"), F.sum(_cut(c, self.discounts[k][f])).alias(f"s{f}")]
        got = self.counts[k].groupBy(F.col(f"context_{k}").alias("key")).agg(*out)
        weights = [x for f in range(self.folds) for x in (F.col(f"t{f}"), F.when(F.col(f"t{f}") > 0, F.log(F.col(f"s{f}") / F.col(f"t{f}"))).otherwise(0.0).alias(f"b{f}"))]
        return got.select("key", "rows", *weights)

    def part(self, number: int, passes: int) -> DataFrame:
        """The counts of the highest order that have the n-grams of class ``number``, others too."""
        return self.counts[self.order] if passes % COUNT_PARTS else self.tables[number % COUNT_PARTS]

    def values(self, number: int, passes: int) -> DataFrame:
        """(key, v0, v1, ...): the values of the n-grams whose last word is of class ``number``."""
        folds, own = range(self.folds), lambda word: F.pmod(F.col(word), F.lit(passes)) == number
        low = self.counts[1].where(own("key"))
        p = low.select("key", F.col("rows"), *[(F.greatest(F.col(f"c{f}") - _cut(F.col(f"c{f}"), self.discounts[1][f]), F.lit(0.0)) / max(self.total[f], 1.0) + self.unseen[f]).alias(f"p{f}") for f in folds])
        out = [self._with_weights(p, [(F.log(F.col(f"p{f}") / self.unseen[f])).alias(f"a{f}") for f in folds], 1, number, passes)]
        for k in range(2, self.order + 1):
            table = (self.part(number, passes) if k == self.order else self.counts[k]).where(own("suffix_2"))
            contexts, shorter = self.contexts[k], p
            near = salted_join(table.withColumnRenamed("rows", "own_rows") if k < self.order else table, contexts.drop("rows").withColumnRenamed("key", f"context_{k}"), f"context_{k}", F.col(f"suffix_{k}"), heavy_keys(contexts.withColumnRenamed("key", f"context_{k}"), f"context_{k}", "rows"))
            both = salted_join(near, shorter.drop("rows").withColumnRenamed("key", f"suffix_{k}"), f"suffix_{k}", F.col(f"context_{k}"), heavy_keys(shorter.withColumnRenamed("key", f"suffix_{k}"), f"suffix_{k}", "rows"))
            over = lambda f: F.exp(F.col(f"b{f}")) * F.col(f"p{f}")
            full = lambda f: F.greatest(F.col(f"c{f}") - _cut(F.col(f"c{f}"), self.discounts[k][f]), F.lit(0.0)) / F.greatest(F.col(f"t{f}"), F.lit(1)) + over(f)  # noqa: B023, E731
            key = F.xxhash64(f"context_{k}", f"suffix_{k}").alias("key")
            rows = both.select(key, *([F.col("own_rows").alias("rows")] if k < self.order else []), *[full(f).alias(f"q{f}") for f in folds], *[F.log(full(f) / over(f)).alias(f"a{f}") for f in folds])
            out.append(self._with_weights(rows, [F.col(f"a{f}") for f in folds], k, number, passes))
            if k < self.order:
                p = rows.select("key", "rows", *[F.col(f"q{f}").alias(f"p{f}") for f in folds])
        whole = out[0]
        for x in out[1:]:
            whole = whole.unionByName(x)
        return whole

    def _with_weights(self, rows: DataFrame, terms: list[Column], k: int, number: int, passes: int) -> DataFrame:
        """Adds what the n-grams are worth as contexts; a context may be no n-gram of its own (the begin marks)."""
        folds = range(self.folds)
        mine = rows.select("key", *terms)
        if k == self.order:
            return mine.select("key", *[F.col(f"a{f}").alias(f"v{f}") for f in folds])
        contexts = self.contexts[k + 1]
        if k == 1:
            contexts = contexts.where(F.pmod("key", F.lit(passes)) == number)
        else:  # by the last word, which a longer key doesn't show: only those that are in this class, and the begin marks once
            contexts = contexts.join(mine.select("key"), "key", "left_semi").unionByName(contexts.where(F.col("key") == _begins(k)).where(F.lit(BEGIN % passes == number)))
        sums = [(F.coalesce(F.col(f"a{f}"), F.lit(0.0)) + F.coalesce(F.col(f"b{f}"), F.lit(0.0))).alias(f"v{f}") for f in folds]
        return mine.join(contexts.select("key", *[f"b{f}" for f in folds]), "key", "full_outer").select("key", *sums)


def _begins(k: int) -> int:
    """The key of k begin marks, signed."""
    key = np.array([BEGIN], dtype=np.uint64)
    for _ in range(k - 1):
        key = pair_hash(key, key)
    return int(key.view(np.int64)[0])


_PACKET = "shard int, kind int, packet long, keys binary, sizes binary, folds binary, owners binary, words binary, worth binary"
_FIELDS = ["shard", "kind", "packet", "keys", "sizes", "folds", "owners", "words", "worth"]


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    """Of a hash of the key: a word's key has zeros where others have bits."""
    return (_round(keys, np.uint64(7)) % np.uint64(shards)).astype(np.int64)


def _five(keys: np.ndarray) -> np.ndarray:
    """The five low bytes of each key."""
    return np.ascontiguousarray(keys.view(np.uint8).reshape(-1, 8)[:, :5])


def _wide(low: bytes) -> np.ndarray:
    out = np.zeros((len(low) // 5, 8), dtype=np.uint8)
    out[:, :5] = np.frombuffer(low, dtype=np.uint8).reshape(-1, 5)
    return out.view(np.int64).ravel()


def _packets(shards: np.ndarray, kind: int, packet: int, **columns: list) -> pa.RecordBatch:
    n = len(shards)
    rest = [pa.array(columns.get(name, [None] * n), type=pa.binary()) for name in _FIELDS[3:]]
    return pa.RecordBatch.from_arrays([pa.array(shards.astype(np.int32)), pa.array(np.full(n, kind, dtype=np.int32)), pa.array(np.full(n, packet, dtype=np.int64)), *rest], names=_FIELDS)


def asked(rows: DataFrame, order: int, shards: int, number: int, passes: int) -> DataFrame:
    """Packets of rows (row, fold, text): the n-grams of a slice of documents whose last word is of class ``number``, five
    bytes each, by shard and document. The slice's first packet has the rows and how many words of the class each has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packet = TaskContext.get().partitionId() << 32
        for b, texts in slices(batches, 2):
            grams, n = Grams(texts, order), b.num_rows
            mine = grams.scored & (grams.last % np.uint64(passes) == number)
            use = np.flatnonzero(mine)
            if not len(use):
                continue
            keys, doc = np.stack([grams.key(k, use) for k in range(1, order + 1)], axis=1).ravel(), np.repeat(grams.doc[use], order)
            shard = shard_of(keys, shards)  # documents are in order, so that only shards are sorted
            low = _five(keys[np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")])
            mark = shard * n + doc
            sizes = np.bincount(mark, minlength=shards * n).astype("<u4").reshape(shards, n)
            full = np.flatnonzero(sizes.any(axis=1))
            ends = np.concatenate([[0], np.cumsum(sizes.sum(1, dtype=np.int64))])
            words = np.bincount(grams.doc[mine & grams.inner & (grams.last != END)], minlength=n).astype("<u4")
            once = lambda x: [x.tobytes(), *[None] * (len(full) - 1)]
            yield _packets(
                full, 1, packet, keys=[low[ends[s] : ends[s + 1]].tobytes() for s in full], sizes=[sizes[s].tobytes() for s in full], folds=[b.column(1).to_numpy().astype(np.uint8).tobytes()] * len(full),
                owners=once(b.column(0).to_numpy()), words=once(words),
            )
            packet += 1

    return rows.mapInArrow(run, _PACKET)


def held(values: DataFrame, folds: int, shards: int) -> DataFrame:
    """The table of values as packets, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column(0).to_numpy().view(np.uint64)
            shard = shard_of(keys, shards)
            order = np.argsort(shard, kind="stable")
            low, worth = _five(keys[order]), np.stack([b.column(1 + f).to_numpy() for f in range(folds)], axis=1)[order]
            ends = np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])
            full = np.flatnonzero(np.diff(ends))
            yield _packets(full, 0, 0, keys=[low[ends[s] : ends[s + 1]].tobytes() for s in full], worth=[worth[ends[s] : ends[s + 1]].tobytes() for s in full])

    return values.mapInArrow(run, _PACKET)


def summed(values: DataFrame, packets: DataFrame, folds: int, shards: int) -> DataFrame:
    """(row, logs, words): the sums of the values of what the packets ask for. They are joined shard by shard: of a shard the
    values come first and are held; packets stream by and leave a sum for each of their documents. What a slice of
    documents has got from all shards is then added up."""
    spread = packets.unionByName(held(values, folds, shards)).repartition("shard").sortWithinPartitions("shard", "kind")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known, worth = None, [], None, None
        for b in batches:
            out = []
            for shard, kind, packet, keys, sizes, fold, owners, words, value in zip(*(b.column(k) for k in range(9))):
                if shard != now:
                    now, parts, known = shard, [], None
                if kind.as_py() == 0:
                    parts.append((keys.as_py(), value.as_py()))
                    continue
                if known is None:
                    known = _wide(b"".join(x for x, _ in parts))
                    order = np.argsort(known)
                    known, worth, parts = known[order], np.frombuffer(b"".join(x for _, x in parts), dtype=np.float64).reshape(-1, folds)[order], []
                n, low = np.frombuffer(sizes.as_py(), dtype="<u4").astype(np.int64), _wide(keys.as_py())
                sums = np.zeros(len(n))
                if len(known):
                    at = np.minimum(np.searchsorted(known, low), len(known) - 1)
                    got = np.where(known[at] == low, worth[at, np.repeat(np.frombuffer(fold.as_py(), dtype=np.uint8), n)], 0.0)
                    some = np.flatnonzero(n)
                    sums[some] = np.add.reduceat(got, (np.cumsum(n) - n)[some])
                out.append((packet.as_py(), sums.tobytes(), owners.as_py(), words.as_py()))
            columns = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], type=pa.int64()), *(pa.array(c, type=pa.binary()) for c in columns[1:])], names=["packet", "sums", "owners", "words"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total, owners, words = None, None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.frombuffer(owners, dtype=np.int64)), pa.array(total), pa.array(np.frombuffer(words, dtype="<u4").astype(np.int64))], names=["row", "logs", "words"])

        for b in batches:
            for packet, sums, own, n in zip(*(b.column(k).to_pylist() for k in range(4))):
                if packet != now:
                    if now is not None:
                        yield done()
                    now, total = packet, 0.0
                total = total + np.frombuffer(sums, dtype=np.float64)
                owners, words = own or owners, n or words
        if now is not None:
            yield done()

    sums = spread.mapInArrow(join, "packet long, sums binary, owners binary, words binary")
    return sums.repartition("packet").sortWithinPartitions("packet").mapInArrow(added, "row long, logs double, words long")


def perplexities(docs: DataFrame, trusted: DataFrame, order: int = ORDER, folds: int = FOLDS, passes: int = PASSES) -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity) of every row of documents under the model of the trusted ids' texts of the other folds."""
    if order < 2:
        raise ValueError("the order is 2 at least")
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), text.alias("text"))
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text")).withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(folds)).cast("int"))
    few = trusted.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    known = rows.join(F.broadcast(trusted) if few else trusted, "doc_id", "left_semi")
    model = Model(known.select("text", "fold"), order, folds)
    keys = sum(model.counts[k].count() for k in model.counts)
    shards = max(1, -(-keys // (passes * SHARD_KEYS)))
    parts = []
    order_of_passes = sorted(range(passes), key=lambda number: number % COUNT_PARTS)
    for at, number in enumerate(order_of_passes):
        if passes % COUNT_PARTS == 0 and order == 2 and at and number % COUNT_PARTS != (done := order_of_passes[at - 1] % COUNT_PARTS):
            discard(model.tables[done])  # its classes have been scored
        values = stash(model.values(number, passes), "values")
        packets = asked(rows.select("row", "fold", "text"), order, shards, number, passes)
        parts.append(stash(summed(values, packets, folds, shards), "sums"))
        discard(values)
    for table in [*model.tables, *model.counts.values(), *model.contexts.values()]:
        discard(table)
    sums = parts[0]
    for part in parts[1:]:
        sums = sums.unionByName(part)
    # Rows with the same id and text have one sum, as many times over as there are rows.
    named = rows.select("row", "fold", "doc_id", "lang")
    copies = named.groupBy("row").agg(F.count("*").alias("copies")).where("copies > 1")
    once = sums.groupBy("row").agg(F.sum("logs").alias("logs"), F.sum("words").alias("words")).join(copies, "row", "left")
    once = once.select("row", *[(F.col(c) / F.coalesce("copies", F.lit(1))).alias(c) for c in ("logs", "words")])
    joined = named.join(once, "row", "left").withColumn("n_tokens", F.coalesce(F.rint("words"), F.lit(0)).cast("long"))
    base = F.element_at(F.array(*[F.lit(float(np.log(x))) for x in model.unseen]), F.col("fold") + 1)
    mean = F.coalesce("logs", F.lit(0.0)) / (F.col("n_tokens") + 1) + base
    return joined.select("doc_id", "lang", "n_tokens", F.when(F.col("n_tokens") > 0, F.exp(-mean)).alias("perplexity"))


def quality(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER, folds: int = FOLDS, passes: int = PASSES) -> DataFrame:
    """(doc_id, lang, n_tokens, perplexity, threshold, keep) of every row of documents.

    Trusted are the ids whose labels all say quality 1; their texts are scored without the counts of their
    own fold, as all others are. Null and empty texts have no perplexity and are not kept; a language without
    trusted texts takes the quantile over all of them, and without any trusted text everything with a word is
    kept. A null doc_id is scored and never trusted; a null language is one of its own; repeated rows are scored
    each and count in training as often; other columns are ignored. The end of a text is predicted like a word.
    """
    trusted = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    scores = stash(perplexities(docs, trusted, order, folds, passes), "perplexity")
    known = scores.where("n_tokens > 0").join(trusted, "doc_id", "left_semi")
    by_lang = known.groupBy("lang").agg(F.percentile_approx("perplexity", quantile, 10_000).alias("own")).withColumnRenamed("lang", "of")
    overall = known.agg(F.percentile_approx("perplexity", quantile, 10_000).alias("any"))
    limits = scores.select("lang").distinct().join(by_lang, F.col("lang").eqNullSafe(F.col("of")), "left").join(F.broadcast(overall), how="left")  # one row
    limits = limits.select(F.col("lang").alias("of"), F.coalesce("own", "any").alias("threshold"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keep = F.col("perplexity").isNotNull() & (F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold")))
    dealt = scores.withColumn("dealt", F.pmod(F.xxhash64("doc_id", "n_tokens", "perplexity"), F.lit(SALTS)).cast("int"))  # a language may hold most rows
    return dealt.join(limits, F.col("lang").eqNullSafe(F.col("of")) & (F.col("dealt") == F.col("salt")), "left").select("doc_id", "lang", "n_tokens", "perplexity", "threshold", keep.cast("int").alias("keep"))
