"""The exact Jaccard similarity of sets of word shingles.

Texts whose sets of five-word shingles are equal are one node. Candidates come as groups of nodes (see
``simhash``); none counts before its sets are compared. First every node of a group is compared with the
group's first one; what groups are still split after that are compared whole, but for pairs that are
linked already.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from .common import local_roots, mix, text_bytes

WORDS = 5
#: Least similarity of a link, as a fraction of whole numbers.
SIMILAR = (4, 5)

_PLACE = mix(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles; a shorter text is one, one without words none."""
    tokens = text.lower().split()
    if not tokens:
        return np.zeros(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens), dtype=np.uint64, count=len(tokens))
    words = min(words, len(tokens))
    total = len(tokens) - words + 1
    out = np.full(total, _PLACE[words], dtype=np.uint64)  # so that lengths differ
    for k in range(words):
        out += mix(hashes[k : k + total] * _PLACE[k])
    return np.unique(mix(out))


def similar(inter: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int):
    """Whether sets of a and b elements that share ``inter`` have the least similarity."""
    part, whole = SIMILAR
    return whole * inter >= part * (a + b - inter)


def bucket_links(roots: np.ndarray, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (places in ``sets``) that link members of different roots; each cross pair is looked at but those linked on the way."""
    n = len(sets)
    _, group, members = np.unique(roots, return_inverse=True, return_counts=True)
    first = np.full(len(members), n)
    np.minimum.at(first, group, np.arange(n))
    label = first[group]
    size = np.array([len(s) for s in sets])
    _, number = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(number, kind="stable")
    posted, starts = owner[order], np.concatenate([[0], np.cumsum(np.bincount(number))])
    edge = np.concatenate([[0], np.cumsum(size)])
    out: list[tuple[int, int]] = []
    for i in np.flatnonzero(group != int(members.argmax())).tolist():  # a cross pair has one outside the largest group
        if (label == label[0]).all():
            break
        own = number[edge[i] : edge[i + 1]]
        count = starts[own + 1] - starts[own]
        at = np.repeat(starts[own] - np.concatenate([[0], np.cumsum(count)])[:-1], count) + np.arange(int(count.sum()))
        hit = np.flatnonzero(similar(np.bincount(posted[at], minlength=n), size[i], size) & (label != label[i]))
        for j in hit.tolist():
            if label[j] != label[i]:
                out.append((i, j))
                label = local_roots(n, label, np.array([i]), np.array([j]))
    a, b = np.array(out, dtype=np.int64).reshape(-1, 2).T
    return a, b


def linked(pairs: DataFrame) -> DataFrame:
    """The pairs (u, v) of (u, v, a, b) whose texts a and b are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(text_bytes(b.column(2)), text_bytes(b.column(3))):
                x, y = shingles(x), shingles(y)
                keep.append(bool(similar(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))))
            yield b.select(["u", "v"]).filter(pa.array(keep, type=pa.bool_()))

    return pairs.select("u", "v", "a", "b").mapInArrow(run, "u long, v long")


def linked_in_groups(members: DataFrame) -> DataFrame:
    """Links (u, v) among all members of each group of (key, node, root, text); holds the sets of one group."""

    def links(nodes: list[int], roots: list[int], sets: list[np.ndarray]) -> pa.RecordBatch:
        a, b = bucket_links(np.array(roots), sets)
        nodes = np.array(nodes, dtype=np.int64)
        return pa.RecordBatch.from_arrays([pa.array(nodes[a]), pa.array(nodes[b])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, roots, sets = None, [], [], []
        for batch in batches:
            for key, node, root, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), text_bytes(batch.column(3))):
                if key != now and nodes:
                    yield links(nodes, roots, sets)
                    nodes, roots, sets = [], [], []
                now = key
                nodes.append(node)
                roots.append(root)
                sets.append(shingles(text))
        if nodes:
            yield links(nodes, roots, sets)

    return members.repartition("key").sortWithinPartitions("key").select("key", "node", "root", "text").mapInArrow(run, "u long, v long")
