"""Runs of repeated words by maximal pairs.

A run of smallest period q is a stretch in which words q apart are equal and that no neighbour extends.
Its first word and the word q later form a maximal pair: equal stretches that differ in the word to
their left and in the word after them. Such pairs are read off a bottom-up tree of LCP intervals whose
nodes keep their suffixes in classes by the word to the left; a pair whose distance is at most a third
of its length is a run as it stands. Where several distances give the same stretch, the smallest is its
period.

Suffixes that no pair of that kind can touch never enter the tree: the words at a run's start repeat at
its period, so each of them sees its own five words again within that distance, and so do all its
neighbours inside the run.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, text_bytes

#: Words analysed together; a longer document is analysed alone.
BATCH_WORDS = 400_000
#: A run holds its period at least so many times, and at least so many words.
TIMES, LEAST = 4, 6


class Node:
    """Suffixes below an LCP interval: all of them by place, and the same in classes by the word to the left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.classes = {left: [place]}


def join(a: Node, b: Node, depth: int, reach: int, left: list[int], found: list[tuple[int, int, int]]) -> Node:
    """One node of two that share ``depth`` words. Adds to ``found`` the pairs (place, distance, depth) between
    them that differ to the left and lie within ``reach``: the places of the smaller node are looked up in the
    larger one, class by class or, where a class search would take longer, place by place."""
    if len(a.places) < len(b.places):
        a, b = b, a
    places, classes = a.places, a.classes
    for place in b.places:
        own = left[place]
        low, high = bisect_left(places, place - reach), bisect_right(places, place + reach)
        if high - low <= 2 * len(classes):
            for other in places[low:high]:
                if left[other] != own:
                    found.append((min(place, other), abs(place - other), depth))
        else:
            for word, members in classes.items():
                if word != own:
                    for other in members[bisect_left(members, place - reach) : bisect_right(members, place + reach)]:
                        found.append((min(place, other), abs(place - other), depth))
    for place in b.places:
        insort(places, place)
    for word, members in b.classes.items():
        mine = classes.get(word)
        if mine is None:
            classes[word] = members
        else:
            if len(mine) < len(members):
                mine, members = members, mine
                classes[word] = mine
            for place in members:
                insort(mine, place)
    return a


def maximal_pairs(order: list[int], lcp: list[int], left: list[int], times: int, shallow: int) -> list[tuple[int, int, int]]:
    """Maximal pairs (place, distance, length) with distance <= length / (times - 1), from suffixes in
    lexical order and the lengths that neighbours share; intervals of fewer than ``shallow`` words aren't built."""
    found: list[tuple[int, int, int]] = []
    open_: list[tuple[int, Node]] = []  # intervals around the current suffix, outermost first, with the children that are complete
    node = Node(order[0], left[order[0]])
    for k in range(1, len(order) + 1):
        depth = lcp[k - 1] if k < len(order) else 0
        while open_ and open_[-1][0] > depth:
            d, siblings = open_.pop()
            node = join(siblings, node, d, d // (times - 1), left, found)
        if depth < shallow:
            open_.clear()
        elif open_ and open_[-1][0] == depth:
            open_[-1] = (depth, join(open_[-1][1], node, depth, depth // (times - 1), left, found))
        else:
            open_.append((depth, node))
        if k < len(order):
            node = Node(order[k], left[order[k]])
    return found


def shallowest(times: int, least: int) -> int:
    """The fewest words that a run's maximal pair shares."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def candidates(words: np.ndarray, doc: np.ndarray, times: int, least: int) -> np.ndarray:
    """Places in ascending order that hold both ends of every pair which makes a run; times must be 3 at least.

    words has a number of its own after each document, doc the document of each place."""
    gram, n = shallowest(times, least), len(words)
    if n < gram:
        return np.zeros(0, dtype=np.int64)
    # what a place shares with the next one that has the same words: equal grams always meet, unequal ones may
    hashed = doc[: n - gram + 1].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for k in range(gram):
        hashed = mix(hashed + words[k : n - gram + 1 + k].astype(np.uint64) + np.uint64(1))
    bits = np.uint64(max(1, (n - 1).bit_length()))
    keys = np.sort((hashed >> bits << bits) | np.arange(len(hashed), dtype=np.uint64))
    place = (keys & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    same = (keys[1:] >> bits == keys[:-1] >> bits) & (doc[place[1:]] == doc[place[:-1]])
    ahead = np.zeros(n + 1, dtype=np.int64)  # distance to the next one, 0: none
    ahead[place[:-1][same]] = (place[1:] - place[:-1])[same]
    while True:
        on = np.flatnonzero(ahead)
        if not len(on):
            return on
        starts = np.flatnonzero(np.r_[True, np.diff(on) > 1])
        length = np.diff(np.r_[starts, len(on)])
        most = np.repeat((length + gram - 1) // (times - 1), length)  # the largest period that a stretch has room for
        far = ahead[on] > most
        if not far.any():
            return np.union1d(on, on + ahead[on])
        ahead[on[far]] = 0


def lexical(words: np.ndarray, places: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, lcp): the places of each document by the words from there on, and the words each shares with the one before it
    in that order. Ranks of 1, 2, 4, ... words are kept until those of all places differ."""
    n, step, tables = len(words), 1, []
    rank = np.zeros(n + 1, dtype=np.int32)  # one place more, for what lies behind the end
    rank[:n] = np.unique(words, return_inverse=True)[1] + 1
    while True:
        own = np.sort(rank[places])
        if (own[1:] != own[:-1]).all():
            break
        tables.append((step, rank))
        behind = np.zeros(n + 1, dtype=np.int64)
        behind[: max(n + 1 - step, 0)] = rank[step:]
        key = (rank.astype(np.int64) << 32) | behind
        by = np.argsort(key[:n])
        rank = np.zeros(n + 1, dtype=np.int32)
        rank[by] = np.cumsum(np.r_[1, key[by][1:] != key[by][:-1]])
        step *= 2
    order = places[np.lexsort((rank[places], doc[places]))]
    a, b, lcp = order[:-1].copy(), order[1:].copy(), np.zeros(max(len(order) - 1, 0), dtype=np.int64)
    for width, table in reversed(tables):
        equal = (table[a] == table[b]) * width
        a, b, lcp = a + equal, b + equal, lcp + equal
    return order, np.r_[0, lcp] if len(order) else lcp


def runs_of(documents: list[list[bytes]], times: int = TIMES, least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """For each document, its runs (start, length, period) by start, then period."""
    codes = {w: k for k, w in enumerate(set(chain.from_iterable(documents)))}
    sizes = np.array([len(d) + 1 for d in documents], dtype=np.int64)
    firsts = np.cumsum(sizes) - sizes
    words = np.empty(int(sizes.sum()), dtype=np.int64)
    for k, (first, doc) in enumerate(zip(firsts.tolist(), documents)):
        words[first : first + len(doc)] = np.fromiter(map(codes.__getitem__, doc), dtype=np.int64, count=len(doc))
        words[first + len(doc)] = len(codes) + k
    home = np.repeat(np.arange(len(documents), dtype=np.int32), sizes)
    places = candidates(words, home, times, least)
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not len(places):
        return out
    # only documents with such places are sorted
    kept = np.unique(home[places])
    inside = np.isin(home, kept)
    moved = np.cumsum(inside) - 1
    small, owner, at = words[inside], home[inside], moved[places]
    order, lcp = lexical(small, at, owner)
    left = np.r_[len(codes) + len(documents), small[:-1]]
    bounds = np.flatnonzero(np.r_[True, owner[order][1:] != owner[order][:-1], True])
    begins = firsts[np.unique(owner)]
    for k, (low, high) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
        doc = int(owner[order[low]])
        base = int(moved[begins[k]])
        around = left[base : base + int(sizes[doc])].tolist()
        found = maximal_pairs((order[low:high] - base).tolist(), lcp[low + 1 : high].tolist(), around, times, shallowest(times, least))
        best: dict[tuple[int, int], int] = {}
        for start, q, shared in found:
            if shared >= (times - 1) * q and q + shared >= least:
                span = (start, start + q + shared)
                best[span] = min(q, best.get(span, q))
        out[doc] = sorted(((s, e - s, q) for (s, e), q in best.items()), key=lambda r: (r[0], r[2]))
    return out


def periodic_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", times: int = TIMES, least: int = LEAST) -> DataFrame:
    """(key, n_words, runs, collapsed): the runs of each row's text, an array of (start, length, period) in words by
    start, then period, and the text without the words that a run repeats, its words joined by one space.

    Words are split at ASCII white space. A run is a stretch of smallest period q of ``least`` words and
    ``times`` periods at least (3 or more) that no neighbour extends. Null and blank texts have no words, no runs
    and an empty collapsed text. Rows are told apart by nothing: null or repeated keys are rows like others.
    Other columns of ``docs`` aren't returned. One row is analysed by one task; nothing is shuffled.
    """
    if times < 3:
        raise ValueError("times must be 3 at least")
    runs_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def analysed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, held, room = 0, [], 0
            for k, text_ in enumerate(text_bytes(batch.column(1))):
                held.append(text_.split())
                room += len(held[-1])
                if room >= BATCH_WORDS or k + 1 == batch.num_rows:
                    runs, collapsed = runs_of(held, times, least), []
                    for words, own in zip(held, runs):
                        if own:
                            stays = np.ones(len(words), dtype=bool)
                            for start, length, q in own:
                                stays[start + q : start + length] = False
                            words = [words[i] for i in np.flatnonzero(stays).tolist()]
                        collapsed.append(b" ".join(words))
                    arrays = [batch.column(0).slice(low, len(held)), pa.array([len(w) for w in held], pa.int64())]
                    arrays += [pa.array([[dict(zip(("start", "length", "period"), r)) for r in own] for own in runs], runs_type), pa.array(collapsed, pa.binary()).cast(pa.string())]
                    yield pa.RecordBatch.from_arrays(arrays, names=[key, "n_words", "runs", "collapsed"])
                    low, held, room = k + 1, [], 0

    fields = docs.select(key).schema.fields[0]
    schema = f"`{key}` {fields.dataType.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return docs.select(key, text).mapInArrow(analysed, schema)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): every tenth document by its checksum, from some word on, repeats a stretch to its end."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    chosen = F.when(h % 10 == 0, F.struct(words.alias("w"), F.floor(h / 10).alias("g")))

    def repeat(x):  # a column of one element stands for a local name: nothing is worked out twice
        n = F.size(x.w).cast("long")
        a = x.g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + x.g % 8))
        return F.struct(x.w.alias("w"), a.alias("a"), p.alias("p"))

    def written(x):
        return F.array_join(F.transform(x.w, lambda w, i: F.when(i >= x.a, F.get(x.w, (x.a + (i - x.a) % x.p).cast("int"))).otherwise(w)), " ")

    tail = F.transform(F.transform(F.array(chosen), repeat), written)[0]
    return docs.select("doc_id", F.when((h % 10 == 0) & (F.length(F.regexp_replace("text", r"[\x20\x09-\x0D]+", "")) > 0), tail).otherwise(F.col("text")).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """The longest run, the number of runs and digests of runs and collapsed text."""
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r.length).alias("n"), r.start.alias("start"), r.period.alias("period"))))
    text = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n")
    return found.withColumn("b", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("b.start").alias("start"), (-F.col("b.n")).alias("length"), F.col("b.period").alias("period"),
        F.floor(F.lit(1000) * -F.col("b.n") / F.col("b.period")).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(text, F.lit("\n"))).otherwise(F.lit("")).cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def oracle() -> str:
    """Brute force: every distance of every document, stretches of equal words by their gaps."""
    return """
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w0,
    list_reduce([4294967295::BIGINT] || [ascii(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')],
      lambda acc, c: list_reduce([xor(acc, c)] || [0::BIGINT FOR b IN range(8)], lambda v, z: xor(v // 2, (v % 2) * 3988292384 + z))) AS v
  FROM documents),
e AS (SELECT doc_id, w0, len(w0)::BIGINT AS n, xor(v, 4294967295) AS h FROM d),
k AS (SELECT *, h // 10 AS g, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM e),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM k),
t AS (SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN [w0[(CASE WHEN i >= a THEN a + (i - a) % p ELSE i END + 1)::BIGINT] FOR i IN range(n)] ELSE w0 END AS w FROM p),
x AS (SELECT doc_id, n, unnest(w) AS w, unnest(range(n)) AS i FROM t),
q AS (SELECT l.doc_id, l.i, r.i - l.i AS q FROM x l JOIN x r ON l.doc_id = r.doc_id AND l.w = r.w AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM q) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
c AS (SELECT x.doc_id, string_agg(w, ' ' ORDER BY i) AS text FROM x ANTI JOIN gone USING (doc_id, i) GROUP BY x.doc_id),
a AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS text,
  min({'n': -length, 'start': start, 'period': period}) AS b FROM r GROUP BY doc_id)
SELECT t.doc_id, coalesce(a.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, (-b.n)::BIGINT AS length, b.period::BIGINT AS period, (1000 * -b.n // b.period)::BIGINT AS exponent_milli,
  sha256(coalesce(a.text, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM t LEFT JOIN a USING (doc_id) LEFT JOIN c USING (doc_id)"""
