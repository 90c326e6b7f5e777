"""Nearest neighbours by a robust-pruned directed graph in each shard of the vectors.

Equal vectors are one node with its smallest ids. A shard's graph starts with random edges; greedy
searches from the medoid propose neighbours for each node, pruning drops a candidate that is closer
to a kept neighbour (by a factor) than to the node, and kept edges are offered back. Every query then
beam-searches each shard, and the shards' best are merged.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

#: Bytes of the distinct vectors of a shard, as doubles: 8,192 vectors of 64 components. It follows from the table alone, never
#: from the cluster, so that results don't either.
SHARD_BYTES = 4 << 20
BEAM = 64
RELAX = 1.2
BLOCK = 256
QUERY_BLOCK = 20_000


def degree_for(rows: int) -> int:
    """Edges a node of a shard with so many nodes: four for each doubling, so that paths stay short as shards grow."""
    return max(16, 4 * math.ceil(math.log2(max(rows, 2))))


def beam_for(rows: int) -> int:
    """Width of the search in a shard with so many nodes, growing with its square root: at a fixed width recall falls with
    the size of a shard (README has the figures)."""
    return max(64, 2 * math.ceil(math.sqrt(rows)))


def beam_search(vectors: np.ndarray, graph: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, squared distances, visited): per query the ``beam`` best nodes found, nearest first, from
    ``start`` along the edges (-1: none), and the nodes expanded on the way. All queries go in step."""
    n, q = len(vectors), len(queries)
    width = beam + graph.shape[1]
    ids = np.full((q, width), -1, dtype=np.int32)
    dist = np.full((q, width), np.inf)
    done = np.ones((q, width), dtype=bool)
    seen = np.zeros((q, n + 1), dtype=bool)
    rows = np.arange(q)
    norms, query_norms = (vectors**2).sum(1), (queries**2).sum(1)
    ids[:, 0], done[:, 0], seen[:, start] = start, False, True
    dist[:, 0] = norms[start] - 2 * queries @ vectors[start] + query_norms
    visited: list[np.ndarray] = []
    while True:
        at = np.argmax(~done[:, :beam], axis=1)
        live = ~done[rows, at]
        if not live.any():
            break
        act = rows[live]
        node = ids[act, at[live]]
        done[act, at[live]] = True
        step = np.full(q, -1, dtype=np.int32)
        step[act] = node
        visited.append(step)
        near = graph[node]
        fresh = (near >= 0) & ~seen[act[:, None], near]
        seen[act[:, None], np.where(fresh, near, n)] = True
        seen[:, n] = False
        got = np.where(fresh, near, 0)
        d = norms[got] - 2 * np.einsum("qrd,qd->qr", vectors[got], queries[act]) + query_norms[act, None]
        ids[act, beam:], dist[act, beam:], done[act, beam:] = np.where(fresh, near, -1), np.where(fresh, d, np.inf), ~fresh
        order = np.argsort(dist[act], axis=1, kind="stable")
        for a in (ids, dist, done):
            a[act] = np.take_along_axis(a[act], order, axis=1)
    return ids[:, :beam], dist[:, :beam], np.stack(visited, axis=1)


def robust_prune(vectors: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """For each node, at most ``degree`` of its candidates (rows padded with -1), nearest first: each
    one kept drops those that it is nearer to, by the factor ``relax``, than the node is."""
    cand = np.sort(candidates, axis=1)
    bad = (cand < 0) | (cand == nodes[:, None])
    bad[:, 1:] |= cand[:, 1:] == cand[:, :-1]
    own = vectors[cand]
    d = np.where(bad, np.inf, ((own - vectors[nodes][:, None]) ** 2).sum(2))
    order = np.argsort(d, axis=1, kind="stable")
    cand, d = np.take_along_axis(cand, order, axis=1), np.take_along_axis(d, order, axis=1)
    own = np.take_along_axis(own, order[:, :, None], axis=1)
    norms = (own**2).sum(2)
    apart = norms[:, :, None] + norms[:, None] - 2 * own @ own.transpose(0, 2, 1)
    kept, alive, rows = np.full((len(nodes), degree), -1, dtype=np.int32), np.isfinite(d), np.arange(len(nodes))
    for k in range(degree):
        live = rows[alive.any(axis=1)]
        if not len(live):
            break
        best = np.argmax(alive[live], axis=1)
        kept[live, k] = cand[live, best]
        alive[live] &= relax**2 * apart[live, best] > d[live]
        alive[live, best] = False
    return kept


def build_graph(vectors: np.ndarray, degree: int, beam: int = BEAM, relax: float = RELAX, seed: int = 7) -> tuple[np.ndarray, int]:
    """(graph, medoid): rows of at most ``degree`` out-neighbours, filled up with -1."""
    n = len(vectors)
    start = int(np.argmin(((vectors - vectors.mean(0)) ** 2).sum(1)))
    rng = np.random.default_rng(seed)
    graph = np.full((n, degree), -1, dtype=np.int32)
    few = min(degree // 2, n - 1)
    if few > 0:
        graph[:, :few] = (np.arange(n)[:, None] + 1 + rng.integers(0, n - 1, (n, few))) % n
    order = rng.permutation(n)
    for at in range(0, n, BLOCK):
        block = order[at : at + BLOCK]
        ids, _, visited = beam_search(vectors, graph, start, vectors[block], beam)
        graph[block] = robust_prune(vectors, block, np.concatenate([ids, visited, graph[block]], axis=1), degree, relax)
        # Kept edges are offered back, all of a node at once: into its free places, or by pruning where there are too few.
        node, to = np.repeat(block, degree), graph[block].ravel()
        real = to >= 0
        node, to = node[real], to[real]
        new = ~(graph[to] == node[:, None]).any(axis=1)
        order_ = np.argsort(to[new], kind="stable")
        node, to = node[new][order_], to[new][order_]
        target, first, count = np.unique(to, return_index=True, return_counts=True)
        have = (graph[target] >= 0).sum(axis=1)
        nth = np.arange(len(to)) - np.repeat(first, count)
        free = np.repeat(have + count <= degree, count)
        graph[to[free], (np.repeat(have, count) + nth)[free]] = node[free]
        full = np.flatnonzero(have + count > degree)
        for part in range(0, len(full), BLOCK):
            some = full[part : part + BLOCK]
            offered = np.full((len(some), int(count[some].max())), -1, dtype=np.int32)
            for row, k in enumerate(some):
                offered[row, : count[k]] = node[first[k] : first[k] + count[k]]
            graph[target[some]] = robust_prune(vectors, target[some], np.concatenate([graph[target[some]], offered], axis=1), degree, relax)
    return graph, start


def usable(vector: str = "embedding"):
    """Whether a vector takes part: not null or empty, all components finite, not all zero."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def neighbours(table: DataFrame, queries: DataFrame, k: int = 10, shard_bytes: int = SHARD_BYTES, beam: int | None = None, degree: int | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries``, the ``k`` nearest others found in ``table``.

    Both have vec_id and embedding; distances are Euclidean in double precision; ties go to the
    smaller vec_id. Rows with a null id or without a usable vector take no part; only vectors of the
    query's length are candidates; a repeated (id, vector) row counts once; other columns are ignored.
    All vectors are indexed: a shard holds about ``shard_bytes`` of distinct ones, dealt out by hash; degree and beam
    follow from the nodes of a shard unless they are given. Of equal vectors, the k + 1 smallest ids are kept with their node: no answer can hold more of them.
    """
    plain = lambda df: df.where(usable() & F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"))
    own = Window.partitionBy("vector").orderBy("vec_id")
    first = plain(table).dropDuplicates(["vec_id", "vector"]).withColumn("n", F.row_number().over(own)).where(F.col("n") <= k + 1)
    nodes = stash(first.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")  # k + 1 ids at most
    size = nodes.agg(F.sum(F.size("vector").cast("long") * 8)).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    placed = nodes.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int")).withColumn("dim", F.size("vector"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        vectors = np.stack(pdf["vector"])
        graph, start = build_graph(vectors, degree or degree_for(len(vectors)))
        return pd.DataFrame({"shard": pdf["shard"], "dim": pdf["dim"], "node": np.arange(len(pdf)), "start": start, "vector": pdf["vector"], "ids": pdf["ids"], "edges": list(graph)})

    index = stash(placed.groupBy("shard", "dim").applyInPandas(build, "shard int, dim int, node int, start int, vector array<double>, ids array<long>, edges array<int>"), "graph")
    asked = plain(queries).dropDuplicates(["vec_id", "vector"]).withColumn("dim", F.size("vector"))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) if blocks > 1 else index.withColumn("block", F.lit(0))

    def search(graph: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        asked_by, near, scores = [], [], []
        if len(graph) and len(asking):
            graph = graph.sort_values("node")
            vectors, edges = np.stack(graph["vector"]), np.stack(graph["edges"]).astype(np.int32)
            ids, start = graph["ids"].tolist(), int(graph["start"].iloc[0])
            width = max(beam or beam_for(len(graph)), k + 1)
            for at in range(0, len(asking), BLOCK):
                part = asking.iloc[at : at + BLOCK]
                q = np.stack(part["vector"])
                found, _, _ = beam_search(vectors, edges, start, q, width)
                for query, own, nodes_ in zip(part["vec_id"].tolist(), q, found):
                    nodes_ = nodes_[nodes_ >= 0]
                    score = np.sqrt(((vectors[nodes_] - own) ** 2).sum(1))
                    for s, v in sorted((s, v) for s, n in zip(score.tolist(), nodes_.tolist()) for v in ids[n] if v != query)[:k]:
                        asked_by.append(query), near.append(v), scores.append(s)
        return pd.DataFrame({"query_id": np.array(asked_by, dtype=np.int64), "vec_id": np.array(near, dtype=np.int64), "score": np.array(scores, dtype=np.float64)})

    found = copies.groupBy("shard", "dim", "block").cogroup(dealt.groupBy("shard", "dim", "block")).applyInPandas(search, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
