"""Packing of tokenized documents into fixed windows by minimum bin slack.

Whole windows are cut off long documents; what remains has one of ``capacity`` lengths. Only the
histogram of lengths is planned, on the driver: it has at most ``capacity`` numbers for any input.
Each step takes the longest length left and, by a bitset subset-sum program over the others, the
multiset that fills its window closest to capacity, as often as the counts allow. Pieces find their
window by their rank among the pieces of their length.
"""

from __future__ import annotations

import array
import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

CAPACITY = 2048
END_ID = 1
SALTS = 256
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
#: Both tokenizer libraries read these characters alike; texts with others go to the reference library.
_COMMON = re.compile("[^\x00-ɏ‐-‧€]")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Ids of the tokenizer file as the tokenizers library gives them, without special tokens added.

    With ``ranks`` and ``pattern``, the same vocabulary for a faster library, common texts go there;
    those with a special token's string or rare characters don't."""

    def __init__(self, tokenizer: str, ranks: str | None = None, pattern: str | None = None):
        from tokenizers import Tokenizer

        self.full, self.fast = Tokenizer.from_file(tokenizer), None
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> list[int]:
        if self.fast and not _COMMON.search(text) and not any(s in text for s in self.special):
            return self.fast.encode_ordinary(text)
        return self.full.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None, pattern: str | None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document's ids and END_ID, cut at the capacity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, out = Encoder(tokenizer, ranks, pattern), []
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = array.array("I", encode(text.as_py() or ""))
                ids.append(END_ID)
                view, n = memoryview(ids), len(ids)
                for at in range(0, n, capacity):
                    part = view[at : at + capacity]
                    out.append((doc_id, at, len(part), zlib.crc32(part), n))
            yield batch_of(out)
            out = []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, _PIECES)


def closest_fill(counts: np.ndarray, room: int) -> dict[int, int]:
    """The multiset of available lengths with the largest sum up to ``room``: length -> how many.

    reach has a bit for each sum; a length's copies are added in doubling shifts."""
    reach, full, steps = 1, (1 << (room + 1)) - 1, []
    for length in np.flatnonzero(counts[: room + 1])[::-1].tolist():
        before, left, part = reach, min(int(counts[length]), room // length), 1
        steps.append((length, before, left))
        while left > 0:
            take = min(part, left)
            reach |= (reach << (take * length)) & full
            left, part = left - take, part * 2
        if reach >> room & 1:
            break
    sum_, chosen = reach.bit_length() - 1, {}
    for length, before, most in reversed(steps):
        copies = next(m for m in range(most + 1) if sum_ >= m * length and before >> (sum_ - m * length) & 1)
        if copies:
            chosen[length] = copies
            sum_ -= copies * length
    return chosen


def plan(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(multiset, times) of windows that use up the counts of lengths 0..capacity."""
    counts, out = counts.copy(), []
    counts[0] = 0
    for longest in range(capacity, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            chosen = closest_fill(counts, capacity - longest)
            counts[longest] += 1
            chosen[longest] = chosen.get(longest, 0) + 1
            times = min(int(counts[k]) // m for k, m in chosen.items())
            for k, m in chosen.items():
                counts[k] -= m * times
            out.append((chosen, times))
    return out


def segments(windows: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first rank, copies, first sequence, offset), sorted: where the pieces of a length go."""
    used, rows, sequence = {}, [], 0
    for chosen, times in windows:
        offset = 0
        for length, copies in sorted(chosen.items(), reverse=True):
            rows.append((length, used.get(length, 0), copies, sequence, offset))
            used[length] = used.get(length, 0) + copies * times
            offset += copies * length
        sequence += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None, pattern: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece of every row.

    Null and empty texts have the end id only; a null doc_id stays null; repeated rows are packed as
    often as they are there; texts of any length are cut; other columns are ignored; an empty table
    gives no rows.
    """
    cut = stash(pieces(docs, tokenizer or default_tokenizer(), ranks, pattern, capacity), "pieces")
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start"), F.lit(SALTS)))
    counts = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = stash(counts.select("length", "salt", "n", before.alias("before")), "counts")  # SALTS rows a length at most
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in firsts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # one row a length: capacity at most
        histogram[row.length] = row.n
    where = segments(plan(histogram, capacity))  # bounded by the windows planned, each of which uses up a length's copies
    keys = where[:, 0] << 44 | where[:, 1]
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = salted.join(firsts.select("length", "salt", "before").hint("merge"), ["length", "salt"])  # by the keys that the ranks need anyway
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.row_number().over(own) - 1).alias("rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(2).to_numpy(), b.column(5).to_numpy()
            _, first, copies, sequence, offset = where[np.searchsorted(keys, length << 44 | rank, side="right") - 1].T
            at = rank - first
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence + at // copies), pa.array(offset + at % copies * length)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(run, f"{_PIECES}, sequence_id long, offset long")
