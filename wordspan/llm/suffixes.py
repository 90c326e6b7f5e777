"""Repeated passages by a logarithmic family of suffix arrays.

The arrays are sparse: of all suffixes they hold those that begin at the smallest-hashed 24-byte gram
of some 100-byte window, so that equal windows, wherever they stand, come with equal sampled suffixes
(one in forty of all; a full array would be several times the input). A sampled suffix has its gram's
hash as its key, and the hash of its run, the bytes of all windows that chose it. Suffixes are kept in
order of key, run and place in the corpus.

A new batch of documents gets its array and is merge-scanned with the arrays of all levels: of equal
runs the earliest stays and the others are repeats; a key with different runs is noted, since their
windows may still be equal in part. Levels of equal size merge, so that there are only logarithmically
many. At the end, noted runs are fetched from their texts and their windows compared one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Rolling, discard, mix, stash, sweep, text_bytes

MATCH = 100
GRAM = 24
BATCHES = 3
CHUNK = 1 << 20
HOLD = 20_000
_ENTRY = "h long, r long, doc long, start long, len int, span boolean"


def runs(data: np.ndarray, limits: np.ndarray, match: int = MATCH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, run hash, document, start, length) of the sampled suffixes of texts that end at ``limits``."""
    width, n = match - gram + 1, len(data)
    if n < match:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    key = Rolling(data, 0).windows(gram)
    low = (mix(key ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(24) << np.uint64(24)) | np.arange(len(key), dtype=np.uint64)
    have = 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    chosen = (low[: n - match + 1] & np.uint64((1 << 24) - 1)).astype(np.int64)
    doc = np.searchsorted(limits, np.arange(len(chosen)), side="right")
    valid = np.arange(len(chosen)) + match <= limits[doc]
    first = valid.copy()
    first[1:] &= ~valid[:-1] | (chosen[1:] != chosen[:-1])
    last = valid.copy()
    last[:-1] &= ~valid[1:] | (chosen[1:] != chosen[:-1])
    a, b = np.flatnonzero(first), np.flatnonzero(last) + match
    begins = np.concatenate([[0], limits[:-1]])
    return key[chosen[a]], Rolling(data, 1).of(a, b), doc[a], a - begins[doc[a]], b - a


def merged(doc: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The maximal intervals that given ones cover in each document."""
    if not len(doc):
        return doc, start, length
    order = np.lexsort((start, doc))
    doc, start, end = doc[order], start[order], (start + length)[order]
    number = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))
    far = np.maximum.accumulate(end + number * (1 << 40)) - number * (1 << 40)  # the furthest end so far, by document
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > far[:-1])])
    at = np.flatnonzero(new)
    return doc[at], start[at], np.maximum.reduceat(end, at) - start[at]


def batch_array(docs: DataFrame, match: int = MATCH, gram: int = GRAM) -> DataFrame:
    """The sampled suffixes of a batch (doc, text); of equal runs that meet in one buffer the earliest
    is an entry and the others are spans already, so that a hot run leaves each task once or so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            group: list[tuple[int, int, bytes]] = []
            size = 0
            for doc, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1))):
                for at in range(0, max(1, len(text) - match + 1), CHUNK):
                    part = text[at : at + CHUNK + match - 1]
                    group.append((doc, at, part))
                    size += len(part)
                    if size >= CHUNK:
                        yield entries(group)
                        group, size = [], 0
            if group:
                yield entries(group)

    def entries(group: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
        docs_, offsets = np.array([x[0] for x in group], dtype=np.int64), np.array([x[1] for x in group], dtype=np.int64)
        h, r, doc, start, length = runs(np.frombuffer(b"".join(x[2] for x in group), dtype=np.uint8), np.cumsum([len(x[2]) for x in group]), match, gram)
        start, doc = start + offsets[doc], docs_[doc]
        order = np.lexsort((start, doc, r, h))
        h, r, doc, start, length = (x[order] for x in (h, r, doc, start, length))
        again = np.zeros(len(h), dtype=bool)
        again[1:] = (h[1:] == h[:-1]) & (r[1:] == r[:-1])
        sd, ss, sl = merged(doc[again], start[again], length[again])
        spread = mix(sd.astype(np.uint64) ^ ss.astype(np.uint64))  # spans go along, to anywhere
        columns = [
            pa.array(np.concatenate([h[~again], spread]).view(np.int64)), pa.array(np.concatenate([r[~again], np.zeros(len(sd), dtype=np.uint64)]).view(np.int64)),
            pa.array(np.concatenate([doc[~again], sd])), pa.array(np.concatenate([start[~again], ss])), pa.array(np.concatenate([length[~again], sl]).astype(np.int32)),
            pa.array(np.concatenate([np.zeros(int((~again).sum()), dtype=bool), np.ones(len(sd), dtype=bool)])),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["h", "r", "doc", "start", "len", "span"])

    return docs.mapInArrow(run, _ENTRY)


class SuffixFamily:
    """Levels of sampled suffix arrays over the batches added so far, a level twice the one below."""

    def __init__(self, match: int = MATCH, gram: int = GRAM):
        self.match, self.gram = match, gram
        self.levels: dict[int, DataFrame] = {}
        self.spans: list[DataFrame] = []
        self.noted: list[DataFrame] = []
        self.tables: dict[int, DataFrame] = {}  # of each level, with spans and noted runs of its batch
        self.done: list[DataFrame] = []

    def add(self, docs: DataFrame) -> None:
        """Scan a batch (doc long, text string) against all levels, and merge levels of its size."""
        level = 0
        while level in self.levels:
            level += 1
        rows = batch_array(docs, self.match, self.gram).withColumn("stays", F.lit(True))
        for k, old in self.levels.items():
            rows = rows.unionByName(old.select("h", "r", "doc", "start", "len", F.lit(False).alias("span"), F.lit(k < level).alias("stays")))
        order = Window.partitionBy("h").orderBy("span", "r", "doc", "start")
        whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        key = F.when(~F.col("span"), F.col("r"))
        rows = rows.withColumn("again", ~F.col("span") & F.coalesce((F.lag("r").over(order) == F.col("r")) & ~F.lag("span").over(order), F.lit(False)))
        rows = rows.withColumn("mixed", F.min(key).over(whole) != F.max(key).over(whole))
        part = F.when(F.col("span") | F.col("again"), "span").when(F.col("stays"), "level").when(F.col("mixed"), "noted")
        done = stash(rows.withColumn("part", part).where("part is not null").select("h", "r", "doc", "start", "len", F.coalesce("mixed", F.lit(False)).alias("mixed"), "part"), "suffixes", ("part",))
        for k in [k for k in self.levels if k < level]:
            self.levels.pop(k)  # its entries are in the new level; the rest of its table is still read
            discard(self.tables.pop(k), "part=level")
        self.levels[level], self.tables[level] = done.where("part = 'level'"), done
        self.done.append(done)
        self.spans.append(done.where("part = 'span'").select("doc", "start", "len"))
        self.noted.append(done.where("part = 'noted'"))

    def repeats(self, docs: DataFrame) -> DataFrame:
        """(doc, start, len), overlapping and with repetitions: bytes of windows that start earlier too. The family ends
        with it: its arrays are deleted."""
        noted = [x.where("mixed") for x in self.levels.values()] + self.noted
        out = self._union(self.spans)
        wanted = stash(self._union([x.select("h", "doc", "start", "len") for x in noted]).distinct(), "noted")
        for table in self.done:  # spans are all that is read of them from here on
            discard(table, "part=level")
            discard(table, "part=noted")
        self.levels, self.tables, self.noted = {}, {}, []
        self.done.append(wanted)
        return out.unionByName(equal_windows(docs, wanted, self.match))

    @staticmethod
    def _union(parts: list[DataFrame]) -> DataFrame:
        whole = parts[0]
        for x in parts[1:]:
            whole = whole.unionByName(x)
        return whole


def equal_windows(docs: DataFrame, wanted: DataFrame, match: int = MATCH) -> DataFrame:
    """(doc, start, len) of windows that an earlier run of the same key holds too.

    ``wanted`` (h, doc, start, len) names the runs; their bytes are fetched by one join. Rows of a key
    come in the order of the corpus, so what has been seen of the key is all that a run is held against.
    """
    joined = wanted.join(docs, "doc").select("h", "doc", "start", F.substring(F.col("text").cast("binary"), F.col("start").cast("int") + 1, F.col("len")).alias("bytes"))
    ordered = joined.repartition("h").sortWithinPartitions("h", "doc", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, np.zeros((0, 2), dtype=np.uint64)
        for b in batches:
            for at in range(0, b.num_rows, HOLD):
                part = b.slice(at, HOLD)
                h, doc, start = (part.column(k).to_numpy() for k in range(3))
                texts = list(text_bytes(part.column(3)))
                size = np.array([len(t) for t in texts])
                data = np.frombuffer(b"".join(texts), dtype=np.uint8)
                n = np.maximum(size - match + 1, 0)
                row = np.repeat(np.arange(len(h)), n)
                place = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                at_ = (np.cumsum(size) - size)[row] + place
                w = np.stack([Rolling(data, k).windows(match)[at_] for k in (0, 1)], axis=1)
                old = seen if last == h[0] else seen[:0]
                both = np.concatenate([old, w])
                group = np.concatenate([np.full(len(old), h[0]), h[row]])
                order = np.lexsort((np.arange(len(both)), both[:, 1], both[:, 0], group))
                g, s = group[order], both[order]
                again = np.zeros(len(s), dtype=bool)
                again[1:] = (g[1:] == g[:-1]) & (s[1:] == s[:-1]).all(axis=1)
                lost = order[again] - len(old)  # what was seen comes first and is there once
                last = h[-1]
                seen = s[(g == last) & ~again]
                columns = merged(doc[row[lost]], start[row[lost]] + place[lost], np.full(len(lost), match))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0]), pa.array(columns[1]), pa.array(columns[2].astype(np.int32))], names=["doc", "start", "len"])

    return ordered.mapInArrow(run, "doc long, start long, len int")


def file_batches(spark: SparkSession, path: str, batches: int = BATCHES) -> list[DataFrame]:
    """A table's files in at most so many groups, read one by one."""
    files = sorted(spark.read.parquet(path).inputFiles())
    schema = spark.read.parquet(path).schema
    step = -(-len(files) // batches) if files else 1
    return [spark.read.schema(schema).parquet(*files[at : at + step]) for at in range(0, len(files), step)]


def _numbered(parts: list[DataFrame]) -> tuple[list[DataFrame], DataFrame, bool]:
    """Batches as (doc, text), and all rows with doc_id. doc is the id where ids are unique and not null;
    else the place in the order of id (null first) and text."""
    rows = [p.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")) for p in parts]
    whole = SuffixFamily._union(rows)
    odd = whole.select("doc_id").groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if odd:
        whole = stash(whole.orderBy("doc_id", "text").withColumn("doc", F.monotonically_increasing_id()), "numbered")
        return [whole.select("doc", "text")], whole, True
    return [r.select(F.col("doc_id").alias("doc"), "text") for r in rows], whole.withColumn("doc", F.col("doc_id")), False


def removed_spans(parts: list[DataFrame], match: int = MATCH, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """(spans, rows): spans (doc, spans array of (start, len)) of the bytes to remove, not yet merged,
    and the rows (doc_id, text, doc) that they belong to."""
    batches, whole, _ = _numbered(parts)
    family = SuffixFamily(match, gram)
    for batch in batches:
        family.add(batch)
    found = stash(family.repeats(whole.select("doc", "text")), "repeats")
    for table in family.done:
        discard(table)
    sweep(whole.sparkSession)  # texts were shuffled for it, and are again for the result
    return found.groupBy("doc").agg(F.collect_list(F.struct("start", "len")).alias("spans")), whole


def dedup(parts: list[DataFrame], match: int = MATCH, gram: int = GRAM) -> DataFrame:
    """(doc_id, kept binary, n_bytes, n_removed, n_spans) of every row of the batches ``parts``.

    Bytes covered by a ``match``-byte string that starts earlier too (in a row before, in the order of
    doc_id, or in the same text) are removed; strings are judged on the input. Null texts are empty;
    a null doc_id comes before all others; rows that repeat an id are documents of their own, in the
    order of their texts; other columns are ignored; texts of any length are taken whole.
    """
    spans, rows = removed_spans(parts, match, gram)
    joined = rows.join(spans, "doc", "left").select("doc_id", "text", F.col("spans.start").alias("starts"), F.col("spans.len").alias("lens"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, starts, lens in zip(text_bytes(b.column(1)), b.column(2), b.column(3)):
                kept, removed, n = text, 0, 0
                if starts.is_valid:
                    a = starts.values.to_numpy()
                    _, a, length = merged(np.zeros(len(a), dtype=np.int64), a, lens.values.to_numpy().astype(np.int64))
                    edges = [0, *np.stack([a, a + length], axis=1).ravel().tolist(), len(text)]
                    kept = b"".join(text[i:j] for i, j in zip(edges[::2], edges[1::2]))
                    removed, n = int(length.sum()), len(a)
                out.append((kept, len(text), removed, n))
            columns = list(zip(*out)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(columns[0], type=pa.binary()), *(pa.array(c, type=pa.int64()) for c in columns[1:])], names=["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    return joined.mapInArrow(run, "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")
