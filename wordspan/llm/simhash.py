"""SimHash near-dedup with a Gray-order hierarchical index.

Upper nodes are shared masked bit patterns: two levels of four blocks each. Fingerprints that differ
in at most three bits agree in one of four 16-bit blocks and then in one of four 12-bit blocks of
the other 48 bits, so each such pair meets below at least one of sixteen masks. Below a mask, the
fingerprints are sorted by Gray rank, runs of neighbours are factored into nodes that hold the bits
all of them share, and a search adds up differences from the root down, leaving a node with all its
fingerprints as soon as more than three have come together.

The same index finds near copies by Jaccard similarity (``near_classes``): there a fingerprint is of five-word
shingles and has 256 bits, since texts of similarity 0.8 differ in some 15 % of the bits. Masks have few bits
then, about as many as leave some 256 fingerprints to a mask's pattern, and their number follows from a target
recall. What the trees hold together is compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, heavy_keys, local_roots, mix, names_free, salted_join, stash, text_bytes, unsigned_hex
from .shingles import linked, linked_in_groups, shingles

FANOUT = 4
BATCH_ENTRIES = 200_000
FRONTIER = 2_000_000

#: Wide fingerprints, for similarity: 64-bit words, and the differing bits allowed in the word that has the tree and in all.
WORDS = 4
FIRST, ALL = 22, 66
#: How often a bit differs at most between sets of similarity 0.8 (small sets; 0.15 in large ones).
DIFFER = 0.16
#: How many pairs of that share of differing bits may lie below no common mask.
MISSED = 1 / 2500
#: Smaller sets have no other set that is similar enough.
LEAST = 4
MASKS_A_PASS = 16
SLICE = 1 << 14
_WORD = mix(np.arange(200, 200 + WORDS, dtype=np.uint64))


def fingerprint(text: bytes, words: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of one text; 0 without words."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    if len(tokens) < words:
        tokens = [b" ".join(tokens)]
        words = 1
    total, ones, digest, step = len(tokens) - words + 1, np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest, 1 << 15
    for at in range(0, total, step):
        parts = [tokens[at + k : min(at + step, total) + k] for k in range(words)]
        hashes = np.array([digest(x, seed) for x in map(b" ".join, zip(*parts))], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """(doc_id, fp long) for every row of documents; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(x, words) for x in text_bytes(b.column(1))], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """Where a code stands in the reflected Gray order (prefix xor of its bits)."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code


def masks() -> list[tuple[int, list[tuple[int, int]]]]:
    """Each mask as (number, [(shift, width), ...]): one 16-bit block and one quarter of the rest."""
    out = []
    for i in range(4):
        rest = [b for b in range(64) if not 16 * i <= b < 16 * i + 16]
        for j in range(4):
            bits, spans = rest[12 * j : 12 * j + 12], [(16 * i, 16)]
            start = bits[0]
            for a, b in zip(bits, bits[1:] + [None]):
                if b != a + 1:
                    spans.append((start, a - start + 1))
                    start = b
            out.append((4 * i + j, spans))
    return out


def mask_keys(code: Column) -> Column:
    """The sixteen upper nodes of a code, each as one long: mask number, then its 28 masked bits."""
    keys = []
    for number, spans in masks():
        key = F.lit(number).cast("long")
        for shift, width in spans:
            part = F.shiftrightunsigned(code, shift).bitwiseAND(F.lit((1 << width) - 1))
            key = F.shiftleft(key, width).bitwiseOR(part)
        keys.append(key)
    return F.array(*keys)


class GrayTree:
    """Trees over runs of codes (``starts`` and ``ends`` of the runs), each run sorted by Gray rank.

    levels, from the leaves up: pattern and mask of the bits that no node above holds, first and end
    of each parent's children. below: the end of the leaves under each node of a level.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        self.codes, size = codes, ends - starts
        ones, zeros = codes, ~codes
        pattern, mask = codes, np.full(len(codes), ~np.uint64(0))
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.below = [np.arange(1, len(codes) + 1)]
        while size.max(initial=1) > 1:
            blocks = -(-size // FANOUT)
            first, base = np.cumsum(blocks) - blocks, np.cumsum(size) - size
            run = np.repeat(np.arange(len(blocks)), blocks)
            lo = base[run] + (np.arange(len(run)) - first[run]) * FANOUT
            hi = np.minimum(lo + FANOUT, base[run] + size[run])
            ones, zeros = np.bitwise_and.reduceat(ones, lo), np.bitwise_and.reduceat(zeros, lo)
            shared = ones | zeros  # these bits go up; the children keep the rest
            self.levels.append((pattern, mask & ~np.repeat(shared, hi - lo), lo, hi))
            self.below.append(self.below[-1][hi - 1])
            pattern, mask, size = ones & shared, shared, blocks
        self.root = pattern, mask

    def uniform(self, label: np.ndarray) -> list[np.ndarray]:
        """For the nodes of each level, from the leaves to the roots, the label that all leaves below share; else -1."""
        out = [label]
        for _, _, lo, _ in self.levels:
            low, high = np.minimum.reduceat(out[-1], lo), np.maximum.reduceat(out[-1], lo)
            out.append(np.where(low == high, low, -1))
        return out

    def links(self, query: np.ndarray, root: np.ndarray, distance: int, known: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, later leaf) at most ``distance`` apart, searching each query from its root; with ``known``
        (see ``uniform``) nodes are left whose leaves all have the query's label."""
        pattern, mask = self.root
        node, apart = root, np.bitwise_count((self.codes[query] ^ pattern[root]) & mask[root])
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask, lo, hi = self.levels[depth]
            n = hi[node] - lo[node]
            child = np.repeat(lo[node] - np.concatenate([[0], np.cumsum(n)])[:-1], n) + np.arange(int(n.sum()))
            query, apart = np.repeat(query, n), np.repeat(apart, n)
            apart = apart + np.bitwise_count((self.codes[query] ^ pattern[child]) & mask[child])
            keep = (apart <= distance) & (self.below[depth][child] > query + 1)
            if known is not None:
                keep &= known[depth][child] != known[0][query]
            query, node, apart = query[keep], child[keep], apart[keep]
        return query, node


def run_links(codes: np.ndarray, keys: np.ndarray, distance: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links among the codes of each run of equal keys (sorted by key, then Gray rank)."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, dtype=np.int64)
    size = np.diff(np.concatenate([edge, [len(keys)]]))
    edge, size = edge[size > 1], size[size > 1]
    if not len(edge):
        return codes[:0], codes[:0]
    inside = np.repeat(edge - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(int(size.sum()))
    codes, ends = codes[inside], np.cumsum(size)
    tree = GrayTree(codes, ends - size, ends)
    run = np.repeat(np.arange(len(size)), size)
    roots, work = np.arange(len(codes)), np.cumsum(size[run])
    at = 0
    while at < len(codes):
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + FRONTIER)))
        a, b = tree.links(np.arange(at, to), run[at:to], distance)
        roots = local_roots(len(codes), roots, a, b)
        at = to
    moved = np.flatnonzero(roots != np.arange(len(codes)))
    return codes[moved], codes[roots[moved]]


def fingerprint_links(nodes: DataFrame, distance: int = 3) -> DataFrame:
    """Links (u, v) that span every group of distinct fingerprints with at most 3 differing bits."""
    if distance > 3:
        raise ValueError("the masks hold for at most 3 differing bits")
    keyed = nodes.select("fp", gray_rank(F.col("fp")).alias("rank"), F.explode(mask_keys(F.col("fp"))).alias("key"))
    spread = keyed.repartition("key").sortWithinPartitions("key", "rank").select("key", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, codes, held = [], [], 0
        for b in batches:
            keys.append(b.column(0).to_numpy())
            codes.append(b.column(1).to_numpy().view(np.uint64))
            held += b.num_rows
            if held >= BATCH_ENTRIES:
                k, c = np.concatenate(keys), np.concatenate(codes)
                cut = int(np.searchsorted(k, k[-1]))  # the last run may go on
                if cut:
                    yield linked(k[:cut], c[:cut])
                keys, codes, held = [k[cut:]], [c[cut:]], len(k) - cut
        if held:
            yield linked(np.concatenate(keys), np.concatenate(codes))

    def linked(k: np.ndarray, c: np.ndarray) -> pa.RecordBatch:
        u, v = run_links(c, k, distance)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return spread.mapInArrow(run, "u long, v long")


def near_groups(docs: DataFrame, words: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of documents.

    component_id is the smallest doc_id reachable over links of at most ``distance`` bits. Null and
    empty texts have fingerprint zero and are linked like others; repeated rows give repeated
    results; a row without doc_id takes its group's component, null if no row of the group has an
    id; other columns are ignored; no rows give no rows.
    """
    fps = stash(fingerprints(docs, words), "fingerprints")
    nodes = stash(fps.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n")), "nodes")
    roots = connected_components(fingerprint_links(nodes.select("fp"), distance))
    classes = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"), F.count("*").alias("n"))
    heavy = heavy_keys(lowest, "root")
    named = stash(salted_join(classes.select("fp", "root"), lowest.select("root", "component_id"), "root", F.xxhash64("fp"), heavy).select("fp", "component_id"), "classes")
    copies = heavy_keys(nodes, "fp")  # texts that are copied very often, empty ones among them
    return salted_join(fps, named, "fp", F.xxhash64("doc_id"), copies).select("doc_id", unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


# -- near copies by similarity ---------------------------------------------------------------------


def wide_fingerprint(own: np.ndarray) -> np.ndarray:
    """The SimHash of a set of 64-bit shingle hashes, in words. A mark that all texts have counts as a shingle, so that
    there are fewer ties in small sets."""
    ones = np.unpackbits(_WORD.view(np.uint8), bitorder="little").astype(np.int64)
    for at in range(0, len(own), SLICE):
        hashes = mix(own[at : at + SLICE, None] ^ _WORD)
        ones += np.unpackbits(hashes.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(own) + 1, bitorder="little").view(np.uint64)


def wide_masks(nodes: int) -> list[np.ndarray]:
    """The bits of each mask for so many fingerprints."""
    bits, width = 64 * WORDS, max(4, nodes.bit_length() - 8)
    apart = [math.comb(bits, d) * DIFFER**d * (1 - DIFFER) ** (bits - d) for d in range(bits + 1)]
    shared = [math.comb(bits - d, width) / math.comb(bits, width) for d in range(bits + 1)]
    number = 1
    while sum(a * (1 - s) ** number for a, s in zip(apart, shared)) > MISSED:
        number += 1
    rng, out = np.random.default_rng(20), []
    while len(out) < number:
        out += np.split(rng.permutation(bits)[: bits // width * width], bits // width)
    return out[:number]


def wide_roots(codes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """For each of some fingerprints (rows of words, sorted by key, then Gray rank of the first word) the first one that it
    reaches, below its key, over fingerprints within ALL bits. Trees are of the first word."""
    start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    ends = np.concatenate([start[1:], [len(keys)]])
    tree, run = GrayTree(codes[:, 0], start, ends), np.repeat(np.arange(len(start)), ends - start)

    def near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(codes[a] ^ codes[b]).sum(axis=1, dtype=np.int64) <= ALL

    at = np.flatnonzero(run[1:] == run[:-1])
    at = at[near(at, at + 1)]  # neighbours in Gray order first: what they join isn't searched
    roots = local_roots(len(codes), np.arange(len(codes)), at, at + 1)
    rest = np.flatnonzero(tree.uniform(roots)[-1][run] == -1)
    work = np.cumsum((ends - start)[run[rest]])
    at = 0
    while at < len(rest):
        to = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + FRONTIER)))
        a, b = tree.links(rest[at:to], run[rest[at:to]], FIRST, tree.uniform(roots))
        close = near(a, b)
        roots = local_roots(len(codes), roots, a[close], b[close])
        at = to
    return roots


def wide_groups(nodes: DataFrame, masks: list[np.ndarray], first: int) -> DataFrame:
    """(key, node) of nodes (node, fp), with repetitions: the groups, of two or more, that the trees below ``masks`` (from
    number ``first``) hold together. Equal groups have equal keys."""
    words = [f"w{k}" for k in range(WORDS)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = np.stack([b.column(1 + k).to_numpy() for k in range(WORDS)], axis=1).view(np.uint64)
            bits = np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little")
            for number, mask in enumerate(masks, first):
                key = bits[:, mask].astype(np.int64) @ (np.int64(1) << np.arange(len(mask))) + (number << 48)
                yield pa.RecordBatch.from_arrays([pa.array(key), *b.columns], names=["key", "node", *words])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for b in batches:
            parts.append(np.stack([c.to_numpy() for c in b.columns], axis=1))
            held += b.num_rows
            if held >= BATCH_ENTRIES:
                rows = np.concatenate(parts)
                cut = int(np.searchsorted(rows[:, 0], rows[-1, 0]))  # the last run may go on
                if cut:
                    yield grouped(rows[:cut])
                parts, held = [rows[cut:]], len(rows) - cut
        if held:
            yield grouped(np.concatenate(parts))

    def grouped(rows: np.ndarray) -> pa.RecordBatch:
        roots = wide_roots(np.ascontiguousarray(rows[:, 2:]).view(np.uint64), rows[:, 0])
        some, key = np.flatnonzero(np.bincount(roots, minlength=len(roots))[roots] > 1), np.zeros(len(roots), dtype=np.uint64)
        np.add.at(key, roots[some], mix(rows[some, 1].view(np.uint64)))
        return pa.RecordBatch.from_arrays([pa.array(mix(key[roots[some]]).view(np.int64)), pa.array(rows[some, 1])], names=["key", "node"])

    keyed = nodes.select("node", *[F.col("fp")[k].alias(w) for k, w in enumerate(words)]).mapInArrow(spread, "key long, node long, " + ", ".join(f"{w} long" for w in words))
    ordered = keyed.withColumn("rank", gray_rank(F.col("w0"))).repartition("key").sortWithinPartitions("key", "rank").select("key", "node", *words)
    return ordered.mapInArrow(run, "key long, node long")


def sketches(docs: DataFrame) -> DataFrame:
    """(own, text_hash, node, fp) for every row of (own long, text_hash long, text): node is of the set of shingles, fp its
    wide fingerprint, null where no other set can be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingles(x) for x in text_bytes(b.column(2))]
            node = np.array([xxhash.xxh64_intdigest(s.tobytes()) for s in sets], dtype=np.uint64).view(np.int64)
            codes = pa.array([wide_fingerprint(s).view(np.int64) if len(s) >= LEAST else None for s in sets], type=pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(node), codes], names=["own", "text_hash", "node", "fp"])

    return docs.mapInArrow(run, "own long, text_hash long, node long, fp array<long>")


def candidates(nodes: DataFrame) -> DataFrame:
    """(key, node): the groups of nodes (node, fp) that are to be compared exactly, found by the Gray trees below all masks."""
    some = nodes.where("fp is not null")
    masks, parts = wide_masks(some.count()), []
    for first in range(0, len(masks), MASKS_A_PASS):
        parts.append(stash(wide_groups(some, masks[first : first + MASKS_A_PASS], first).distinct(), "groups"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    whole = stash(whole.distinct(), "groups")
    for part in parts:
        discard(part)
    return whole


def near_classes(docs: DataFrame) -> DataFrame:
    """(own, text_hash, first) for every row of (own long, text): the smallest (own, text_hash) reachable over similar texts.

    Texts without words are one class."""
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    sketch = stash(sketches(rows.select("own", "text_hash", F.col("text").cast("string"))), "sketches")
    nodes = stash(sketch.groupBy("node").agg(F.min(F.struct("own", "text_hash", "fp")).alias("low")).select("node", "low.*"), "nodes")
    keyed = candidates(nodes.select("node", "fp"))
    leaders = stash(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("u")).where("n > 1"), "leaders")
    shared = stash(salted_join(keyed, leaders, "key", F.xxhash64("node"), heavy_keys(leaders, "key")), "shared")
    pairs = stash(shared.where("node <> u").select("u", F.col("node").alias("v")).distinct(), "pairs")
    wanted = nodes.join(shared.select("node").distinct(), "node", "left_semi").select("node", "own", "text_hash")
    texts = stash(rows.join(wanted, ["own", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "texts")
    heavy = heavy_keys(pairs.groupBy("u").agg(F.count("*").alias("n")), "u")
    both = salted_join(pairs.join(texts.select(F.col("node").alias("v"), F.col("text").alias("b")), "v"), texts.select(F.col("node").alias("u"), F.col("text").alias("a")), "u", F.xxhash64("v"), heavy)
    links = stash(linked(both), "links")
    classes = stash(connected_components(links), "components")
    rooted = shared.select("key", "node").join(classes, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    split = rooted.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("key")
    rest = stash(rooted.join(split, "key", "left_semi"), "split")
    more = stash(linked_in_groups(rest.join(texts, "node")), "links")
    ends = stash(connected_components(links.unionByName(more)), "components")
    named = nodes.join(ends, "node", "left").select("node", "own", "text_hash", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.count("*").alias("n"), F.min(F.struct("own", "text_hash")).alias("first"))
    heavy = heavy_keys(lowest.select("root", "n"), "root")
    classes = stash(salted_join(named.select("node", "root"), lowest.select("root", "first"), "root", F.xxhash64("node"), heavy).select("node", "first"), "classes")
    sizes = sketch.groupBy("node").agg(F.count("*").alias("n"))
    return salted_join(sketch.select("own", "text_hash", "node"), classes, "node", F.xxhash64("own", "text_hash"), heavy_keys(sizes, "node")).select("own", "text_hash", "first")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with their columns, that are the smallest doc_id of their near-duplicate group.

    Here near means five-word shingles of Jaccard similarity 0.8 or more: candidates are found by fingerprints of
    256 bits in Gray trees and compared exactly.
    A row is known by its id and its text, so texts that share an id are judged each; ids are below 2**62, and
    rows without one come after all others of their group. Of rows that repeat id and text, the one whose other
    columns come first in order stays."""
    own, text_hash, row = names_free(docs, "own", "text_hash", "row")
    late = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("text"), 2)
    keyed = docs.withColumn(own, F.coalesce(F.col("doc_id").cast("long"), late)).withColumn(text_hash, F.xxhash64("text"))
    classes = near_classes(keyed.select(F.col(own).alias("own"), "text"))
    stay = classes.where((F.col("own") == F.col("first.own")) & (F.col("text_hash") == F.col("first.text_hash")))
    stay = stay.select(F.col("own").alias(own), F.col("text_hash").alias(text_hash)).distinct()
    kept = keyed.join(stay, [own, text_hash], "left_semi")
    return kept.groupBy(own, text_hash).agg(F.min(F.struct(*docs.columns)).alias(row)).select(f"{row}.*")
