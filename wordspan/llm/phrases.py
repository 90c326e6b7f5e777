"""Phrases that occur together more often than their parts suggest.

Counts go level by level: a phrase of n words can be frequent only where the two phrases of n - 1 words inside it are.
A batch of text is a row that holds, for each place, which of the batch's own distinct phrases starts there. The batch
sends each distinct phrase once, with its count, into one stream ordered by phrase; there the counts of all batches meet
in a running order, and the frequent ones go back to their batch by number. So a phrase has one row a batch at most,
however common it is, no table of phrases is ever broadcast, and phrases are compared by exact ids of their parts.

The streams of frequent phrases are then kept in order of prefix and of suffix and merge-joined in step: a phrase takes the
counts of all its left parts from the stream of its prefix, those of its right parts from that of its suffix, and gives its own
count to both as their extension.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, names_free, stash

#: Bytes of text of one language in a batch; a longer text is a batch of its own.
BATCH_BYTES = 8_000_000
#: Passes over the phrases of two words, by hash: the level with most of them, whose stream would take as much disk as the texts.
PASSES = 4
#: A phrase's id is the smallest (batch, number there) that holds it; a batch has fewer distinct phrases than 2 ** NUMBER_BITS.
NUMBER_BITS, SEQUENCE_BITS = 30, 12
MOST_WORDS, LEAST_COUNT, SHARE, TOP = 5, 100, 100, 2000

_BREAK = b"\xff"  # no byte of UTF-8
_BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r", _BREAK * 10)


def tokens(texts: list[bytes]) -> list[bytes]:
    """Lower-cased words of all texts in order, with a break between pieces and texts."""
    whole = _BREAK.join(texts).lower().translate(_BREAKS)
    return whole.replace(_BREAK, b" " + _BREAK + b" ").split()


def counted(sequence: np.ndarray, distinct: int) -> np.ndarray:
    return np.bincount(sequence[sequence >= 0], minlength=distinct)


def planes(sequence: np.ndarray) -> bytes:
    """Numbers of 32 bits, packed, all their lowest bytes first: the upper ones are mostly equal."""
    data = sequence.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(sequence).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def from_planes(data: bytes) -> np.ndarray:
    data = pa.decompress(data[8:], decompressed_size=4 * int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(4, -1).T).view("<i4").ravel()


_LEVEL = "batch long, lang string, sequence binary, left array<long>, right array<long>, words array<string>, counts array<long>"


def _row(batch: int, lang: str, sequence: np.ndarray, left: np.ndarray, right: np.ndarray, words: list[bytes] | None, counts: np.ndarray) -> pa.RecordBatch:
    at, values = planes(sequence), [left, right, counts]
    listed = [pa.array([v], pa.list_(pa.int64())) for v in values]
    said = pa.array([words or []], pa.list_(pa.binary())).cast(pa.list_(pa.string()))
    return pa.RecordBatch.from_arrays([pa.array([batch], pa.int64()), pa.array([lang], pa.string()), pa.array([at], pa.binary()), listed[0], listed[1], said, listed[2]], names=["batch", "lang", "sequence", "left", "right", "words", "counts"])


def _first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) -> batches of single words."""
    held: dict[str, list[bytes]] = {}
    room: dict[str, int] = {}
    part, sent = TaskContext.get().partitionId(), 0

    def made(lang: str) -> pa.RecordBatch:
        nonlocal sent
        if sent >> SEQUENCE_BITS:
            raise ValueError("a partition has too many batches: read smaller splits")
        all_, empty = tokens(held.pop(lang)), np.zeros(0, dtype=np.int64)
        room.pop(lang)
        distinct = sorted(set(all_) - {_BREAK})
        codes = {w: k for k, w in enumerate(distinct)} | {_BREAK: -1}
        sequence = np.fromiter(map(codes.__getitem__, all_), dtype=np.int32, count=len(all_))
        sent += 1
        return _row(part << SEQUENCE_BITS | sent - 1, lang, sequence, empty, empty, distinct, counted(sequence, len(distinct)))

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())):
            text = text.as_py()
            if text:
                if room.get(lang, 0) + len(text) > BATCH_BYTES and lang in held:
                    yield made(lang)
                held.setdefault(lang, []).append(text)
                room[lang] = room.get(lang, 0) + len(text)
                if sum(room.values()) > 2 * BATCH_BYTES:
                    yield made(max(room, key=room.get))
    for lang in list(held):
        yield made(lang)


def _next_level(level: pa.Table, frequent: pa.Table) -> pa.Table:
    """One batch and the numbers and ids of its frequent phrases -> the batch of phrases one word longer."""
    schema = pa.schema([("batch", pa.int64()), ("lang", pa.string()), ("sequence", pa.binary()), ("left", pa.list_(pa.int64())), ("right", pa.list_(pa.int64())), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
    if not level.num_rows or not frequent.num_rows:
        return schema.empty_table()
    sequence = from_planes(level.column("sequence")[0].as_py())
    numbers, ids = frequent.column("number").to_numpy(), frequent.column("id").to_numpy()
    by = np.full(int(max(numbers.max(), sequence.max(initial=0))) + 2, -1, dtype=np.int64)  # its last place stands for -1
    by[numbers] = np.arange(len(numbers))
    now = by[sequence]
    both = (now[:-1] >= 0) & (now[1:] >= 0)
    if not both.any():
        return schema.empty_table()
    pairs, number = np.unique(now[:-1][both] * len(ids) + now[1:][both], return_inverse=True)
    after = np.full(len(both) + 1, -1, dtype=np.int64)
    after[:-1][both] = number
    after = after[(after >= 0) | np.r_[True, after[:-1] >= 0]]  # one -1 stands for several
    counts = np.bincount(number, minlength=len(pairs))
    made = _row(level.column("batch")[0].as_py(), level.column("lang")[0].as_py(), after, ids[pairs // len(ids)], ids[pairs % len(ids)], None, counts)
    return pa.Table.from_batches([made]).cast(schema)


def frequent_phrases(docs: DataFrame, text: str = "text", group: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST_COUNT) -> tuple[list[DataFrame], DataFrame]:
    """([level 1, level 2, ...], totals): for each number of words, (id, left, right, lang, word, f) of the phrases that
    occur ``least`` times or more in their group, overlaps included, left and right being the ids of their first and last
    n - 1 words, and word that of level 1; totals has (lang, n), the words of each group.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line breaks, and into words at space and tab; a phrase lies
    within a piece. A null group is ``und``; null texts count as empty."""
    lang = F.coalesce(F.col(group).cast("string"), F.lit("und"))
    (a, b) = names_free(docs, "group_", "text_")
    level = stash(docs.select(lang.alias(a), F.col(text).alias(b)).mapInArrow(_first_level, _LEVEL), "phrases-1")
    levels, totals = [], None
    for n in range(1, most_words + 1):
        each = F.posexplode(F.arrays_zip("words", "counts") if n == 1 else F.arrays_zip("left", "right", "counts"))
        keys = ["lang", "word"] if n == 1 else ["left", "right"]
        parts = [F.col("lang"), F.col("x.words").alias("word")] if n == 1 else [F.col("x.left").alias("left"), F.col("x.right").alias("right")]
        own = (F.col("batch") * F.lit(1 << NUMBER_BITS) + F.col("number")).alias("own")
        rows = level.select("batch", "lang", each.alias("number", "x")).select(own, *parts, F.col("x.counts").cast("int").alias("c"))
        key, met = Window.partitionBy(*keys), []
        for k in range(passes := PASSES if n == 2 else 1):
            some = rows.where(F.pmod(F.xxhash64(*keys), F.lit(passes)) == k) if passes > 1 else rows
            met.append(stash(some.withColumn("f", F.sum("c").over(key)).where(F.col("f") >= least).withColumn("id", F.min("own").over(key)), f"phrases-frequent-{n}"))
        met = reduce(DataFrame.unionByName, met)
        if n == 1:
            totals = stash(rows.groupBy("lang").agg(F.sum("c").alias("n")), "phrases-totals")
        levels.append(met.where("id = own").select("id", *keys, "f"))
        if n < most_words:
            back = met.select(F.shiftright("own", NUMBER_BITS).alias("batch"), F.col("own").bitwiseAND(F.lit((1 << NUMBER_BITS) - 1)).alias("number"), "id")
            after = stash(level.select("batch", "lang", "sequence").groupBy("batch").cogroup(back.groupBy("batch")).applyInArrow(_next_level, _LEVEL), f"phrases-{n + 1}")
            discard(level)
            level = after
    discard(level)
    return levels, totals


def collocations(docs: DataFrame, text: str = "text", group: str = "lang", most_words: int = MOST_WORDS, least: int = LEAST_COUNT, share: int = SHARE) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, cut, score, extension): every phrase of 2 to ``most_words`` words that occurs ``least``
    times or more in its group and isn't covered by a longer one.

    a is its count, n the group's words, l and r the counts of the parts of its weakest cut, score floor(1000 a n / (l r)) in
    exact integers; of cuts with the same score the earliest counts. A phrase is covered if a candidate that contains it has at
    least ``share`` per cent of its count: then so has one that is just one word longer, since counts only fall with length. extension is
    the largest count of such a one (0: none). Empty tables, null texts and blank texts give no rows."""
    levels, totals = frequent_phrases(docs, text, group, most_words, least)
    stream = levels[0].select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("starts"), F.array("f").alias("ends"), "f")
    streams = []
    for level in levels[1:]:
        prefix = stream.select(F.col("id").alias("left"), "lang", F.col("phrase").alias("before"), F.col("starts").alias("of_left"))
        suffix = stream.select(F.col("id").alias("right"), F.col("last"), F.col("ends").alias("of_right"))
        stream = stash(
            level.join(prefix.hint("merge"), "left").join(suffix.hint("merge"), "right").select(
                "id", "lang", F.concat_ws(" ", "before", "last").alias("phrase"), "last", F.concat("of_left", F.array("f")).alias("starts"), F.concat("of_right", F.array("f")).alias("ends"), "f", "left", "right"
            ),
            "phrases-stream",
        )
        streams.append(stream)
    found = []
    for n, stream in enumerate(streams, start=2):
        extension = F.lit(0).cast("long")
        if n < most_words:
            longer = streams[n - 1]
            ends = longer.select(F.col("left").alias("id"), "f").unionByName(longer.select(F.col("right").alias("id"), "f")).groupBy("id").agg(F.max("f").alias("longest"))
            stream, extension = stream.join(ends.hint("merge"), "id", "left"), F.coalesce("longest", F.lit(0)).cast("long")
        found.append(stream.select("lang", "phrase", F.lit(n).alias("words"), F.col("f").alias("a"), "starts", "ends", extension.alias("extension")))
    rows = reduce(DataFrame.unionByName, found).where(F.lit(100) * F.col("extension") < F.lit(share) * F.col("a")).join(F.broadcast(totals) if _few(totals) else totals, "lang")
    pairs = F.sequence(F.lit(1), F.col("words") - 1)
    cuts = rows.select("*", F.posexplode(F.transform(pairs, lambda k: F.struct(F.get("starts", k - 1).alias("l"), F.get("ends", F.col("words") - k - 1).alias("r")))).alias("k", "x"))
    wide = cuts.select("lang", "phrase", "words", "a", "n", "extension", (F.col("k") + 1).alias("cut"), F.col("x.l").alias("l"), F.col("x.r").alias("r")).withColumn(
        # decimal(38, 0) holds both products exactly: counts are below 2 ** 47 where their products pass it
        "score", F.expr("cast(1000 * cast(a as decimal(17, 0)) as decimal(20, 0)) * cast(n as decimal(17, 0)) div (cast(l as decimal(18, 0)) * cast(r as decimal(18, 0)))")
    )
    best = F.min_by(F.struct("l", "r", "cut", "score"), F.struct("score", "cut"))
    return wide.groupBy("lang", "phrase", "words", "a", "n", "extension").agg(best.alias("best")).select("lang", "phrase", "words", "a", "best.l", "best.r", "n", "best.cut", "best.score", "extension")


def _few(totals: DataFrame) -> bool:
    return totals.count() <= 10_000


def ranked(found: DataFrame, top: int = TOP) -> DataFrame:
    """The first ``top`` of each group by score, then count, then phrase in byte order."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return kept.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle() -> str:
    """All phrases counted as they are, all cuts tried, all longer candidates searched for the shorter ones."""
    return """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS piece, words FROM (
    SELECT lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\\x0A-\\x0D]')), '[ \\x09]+'), lambda w: w <> '') AS words FROM documents) WHERE len(words) > 0),
t AS (SELECT lang, sum(len(words))::HUGEINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, list_slice(words, i, i + k - 1) AS w FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(words) >= k)),
f AS (SELECT lang, k, w, count(*)::HUGEINT AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, k, w, f AS a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
s AS (SELECT c.lang, c.w, c.a, c.cut, x.f AS l, y.f AS r, t.n, 1000 * c.a * t.n // (x.f * y.f) AS score
  FROM c JOIN f x ON x.lang = c.lang AND x.w = list_slice(c.w, 1, c.cut) JOIN f y ON y.lang = c.lang AND y.w = list_slice(c.w, c.cut + 1, c.k) JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, cut) = 1),
inner_ AS (SELECT lang, f, list_slice(w, i, j) AS w FROM (SELECT lang, f, w, k, unnest(range(1, k + 1)) AS i FROM f), (SELECT unnest([1, 2, 3, 4, 5]) AS j) WHERE j > i AND j <= k AND j - i + 1 < k),
covered AS (SELECT DISTINCT b.lang, b.w FROM b JOIN inner_ ON inner_.lang = b.lang AND inner_.w = b.w AND 100 * inner_.f >= 100 * b.a),
o AS (SELECT lang, array_to_string(w, ' ') AS phrase, a, l, r, n, score FROM b ANTI JOIN covered USING (lang, w))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM o QUALIFY rank <= 2000"""
