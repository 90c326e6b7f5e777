"""Near copies among vectors by filters on spherical caps.

A filter is a direction of a random product code: a random unit vector for each half of the coordinates, after a
rotation. A vector belongs to every filter whose direction it is close enough to; which ones these are
is decoded by list from the halves, without trying all directions. Vectors that share a filter are compared
exactly. The threshold follows from the number of vectors (a filter then holds a few unrelated ones,
whatever the size), the number of directions from the wanted probability to miss a pair.

A pair that shares several filters counts in the first of them only, so that links are counted where they
are found and no list of pairs is ever written. Large filters are cut into blocks, and every two blocks
are a task's work of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import connected_components, discard, heavy_keys, local_roots, names_free, salted_join, stash

LEAST = 0.95
#: Probability to miss a pair at the threshold, were filters independent. Those of one code aren't, so several codes with rotations of
#: their own share the work: of pairs at the threshold, 16 codes found 0.994 to 0.998 for 500 to 10 million vectors, one code 0.91 to 0.94.
MISS, CODES = 1e-6, 16
#: Unrelated vectors that a filter holds on average.
FILTER_ROWS = 4
#: Members of a filter that are compared as one block.
BLOCK = 1024
PAIRS = 40_000
SEED = 20_250_117


def _tail(dim: int, at: np.ndarray, points: int = 40_001) -> np.ndarray:
    """P(first coordinate > at) on the unit sphere of ``dim`` dimensions (3 or more)."""
    x = np.linspace(-1, 1, points)
    density = (1 - x**2) ** ((dim - 3) / 2)
    above = np.cumsum(density[::-1])[::-1]
    return np.interp(at, x, (above - density / 2) / above[0], left=1.0, right=0.0)


def _both(dim: int, at: float, cosine: float) -> float:
    """P(a random direction is closer than ``at`` to both of two vectors)."""
    x = np.linspace(at, 1, 2001)[:-1]
    density = (1 - x**2) ** ((dim - 3) / 2)
    whole = np.linspace(-1, 1, 40_001)
    weight = ((1 - whole**2) ** ((dim - 3) / 2)).sum() * (whole[1] - whole[0])
    rest = _tail(dim - 1, (at - cosine * x) / np.sqrt((1 - cosine**2) * (1 - x**2)))
    return float((density * rest).sum() * (x[1] - x[0]) / weight)


class Codes:
    """Product codes for ``n`` vectors of ``dim`` components: threshold, rotations, directions."""

    def __init__(self, dim: int, n: int, least: float, miss: float, filter_rows: float, codes: int):
        self.dim = dim
        self.width = 1 << max(4, (dim - 1).bit_length())  # padded with zeros, which changes no angle
        share = min(filter_rows / max(n, 1), 0.01)
        low, high = 0.0, 1.0
        for _ in range(50):
            mid = (low + high) / 2
            low, high = (mid, high) if _tail(self.width, np.array(mid)) > share else (low, mid)
        self.threshold = low
        filters = -math.log(miss) / _both(self.width, low, min(least, 1 - 1e-9))
        self.size = max(2, math.ceil(math.sqrt(filters / codes)))
        rng = np.random.default_rng(SEED)
        self.signs = rng.choice([-1.0, 1.0], (codes, 3, self.width))
        words = rng.standard_normal((codes, 2, self.size, self.width // 2))
        self.words = words / np.linalg.norm(words, axis=3, keepdims=True) / math.sqrt(2)

    def rotated(self, unit: np.ndarray, signs: np.ndarray) -> np.ndarray:
        """Three rounds of signs and a Hadamard transform: neither half keeps a vector's weight to itself."""
        x = np.zeros((len(unit), self.width))
        x[:, : self.dim] = unit
        for row in signs:
            x, step = x * row, 1
            while step < self.width:
                x = x.reshape(len(unit), -1, 2, step)
                x = np.concatenate([x[:, :, :1] + x[:, :, 1:], x[:, :, :1] - x[:, :, 1:]], axis=2).reshape(len(unit), -1)
                step *= 2
            x = x / math.sqrt(self.width)
        return x

    def filters(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of every filter that a row of ``unit`` vectors belongs to, in ascending order."""
        rows, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        step = max(1, 2_000_000 // self.size)
        for at in range(0, len(unit), step):
            for k, (signs, words) in enumerate(zip(self.signs, self.words)):
                x = self.rotated(unit[at : at + step], signs)
                left, right = (part @ w.T for part, w in zip(np.split(x, 2, axis=1), words))
                # only the words of a half that some word of the other half can lift over the threshold
                a_row, a = np.nonzero(left >= (self.threshold - right.max(1))[:, None])
                b_row, b = np.nonzero(right >= (self.threshold - left.max(1))[:, None])
                first = np.searchsorted(b_row, np.arange(len(x) + 1))
                many = (first[1:] - first[:-1])[a_row]
                which = np.repeat(np.arange(len(a)), many)
                other = b[first[a_row][which] + np.arange(len(which)) - np.repeat(np.cumsum(many) - many, many)]
                row, own = a_row[which], a[which]
                over = left[row, own] + right[row, other] >= self.threshold
                rows.append(row[over] + at)
                found.append((k * self.size + own[over]) * self.size + other[over])
        row, filters = np.concatenate(rows), np.concatenate(found)
        order = np.lexsort((filters, row))
        return row[order], filters[order]


@lru_cache(maxsize=8)
def product_codes(dim: int, n: int, least: float, miss: float, filter_rows: float, codes: int) -> Codes:
    return Codes(dim, n, least, miss, filter_rows, codes)


def unit_vectors(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # so that no square overflows
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def usable(vector: Column) -> Column:
    """Neither null nor zero, and all components are finite numbers."""
    finite = F.forall(vector, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _signatures(kind: str, *design):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            sizes, flat = column.value_lengths().to_numpy(zero_copy_only=False), column.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                vectors = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                row, filters = product_codes(int(dim), *design).filters(unit_vectors(vectors.astype(np.float64)))
                bounds = np.searchsorted(row, np.arange(len(at) + 1)).astype(np.int32)
                own = batch.take(pa.array(at))
                listed = pa.ListArray.from_arrays(pa.array(bounds), pa.array(filters, pa.int64()))
                packed = pa.array([v.tobytes() for v in vectors.astype(kind)], pa.binary())
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(2), packed, listed], names=["rep", "mark", "n", "packed", "filters"])

    return run


def _first_shared(held: np.ndarray, a: np.ndarray, b: np.ndarray, filter_: np.ndarray) -> np.ndarray:
    """Whether the pairs a-b share no filter before ``filter_``; held has each member's filters, padded with -1."""
    out = np.empty(len(a), dtype=bool)
    step = max(1, 8_000_000 // held.shape[1] ** 2)
    for at in range(0, len(a), step):
        x, y = held[a[at : at + step]], held[b[at : at + step]]
        same = (x[:, :, None] == y[:, None]) & ((x >= 0) & (x < filter_[at : at + step, None]))[:, :, None]
        out[at : at + step] = ~same.any((1, 2))
    return out


def _earlier(held: np.ndarray, filter_: int) -> np.ndarray:
    """A column for each filter before ``filter_`` that two members hold at least, 1 where a member holds it."""
    row, at = np.nonzero((held >= 0) & (held < filter_))
    _, column, many = np.unique(held[row, at], return_inverse=True, return_counts=True)
    number = np.cumsum(many > 1) - 1
    out = np.zeros((len(held), int(number[-1]) + 1 if len(number) else 0), dtype=np.float32)
    several = many[column] > 1
    out[row[several], number[column[several]]] = 1
    return out


def _close(unit: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    cosine = np.einsum("ij,ij->i", unit[a], unit[b])
    for k in np.flatnonzero(np.abs(cosine - least) < 1e-13):  # too near for a sum in any order
        cosine[k] = math.fsum(unit[a[k]] * unit[b[k]])
    return cosine >= least


def _cells(kind: str, least: float):
    """Rows sorted by (dim, filter, low, high), chunk of their own, -> links and spanning edges of each row that has any."""

    def compare(rows: dict) -> pa.RecordBatch | None:
        cell, chunk = rows["cell"], rows["chunk"]
        starts = np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)])
        sizes = np.diff(np.r_[starts, len(cell)])
        n = len(cell)
        links, roots = np.zeros(n, dtype=np.int64), np.arange(n)
        big = sizes > 64
        # small cells: all their pairs together
        first, size = starts[~big], sizes[~big]
        member = np.repeat(first, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        end = np.repeat(first + size, size)
        many = end - member - 1
        edges = np.cumsum(many)
        for low in range(0, int(edges[-1]) if len(edges) else 0, PAIRS):
            pair = np.arange(low, min(low + PAIRS, int(edges[-1])))
            k = np.searchsorted(edges, pair, side="right")
            a = member[k]
            b = a + 1 + pair - (edges[k] - many[k])
            ok = (cell[a, 2] == cell[a, 3]) | (chunk[a] != chunk[b])
            a, b = a[ok], b[ok]
            ok = np.einsum("ij,ij->i", rows["unit"][a], rows["unit"][b]) >= least - 1e-9
            a, b = a[ok], b[ok]
            ok = _first_shared(rows["held"], a, b, cell[a, 1])
            count(rows, a[ok], b[ok], links, roots)
        for first, size in zip(starts[big].tolist(), sizes[big].tolist()):
            whole = slice(first, first + size)
            unit, before, within = rows["unit"][whole], _earlier(rows["held"][whole], cell[first, 1]), cell[first, 2] == cell[first, 3]
            for low in range(0, size, 128):
                part = slice(low, low + 128)
                take = (unit[part] @ unit.T >= least - 1e-9) & (before[part] @ before.T == 0)
                a, b = np.nonzero(take)
                a += low
                ok = (b > a) if within else (chunk[first + a] < chunk[first + b])
                count(rows, first + a[ok], first + b[ok], links, roots)
        keep = (links > 0) | (roots != np.arange(n))
        if not keep.any():
            return None
        to = rows["rep"][roots[keep]]
        return pa.RecordBatch.from_arrays([pa.array(rows["rep"][keep]), pa.array(rows["mark"][keep]), pa.array(links[keep]), pa.array(to)], names=["rep", "mark", "links", "other"])

    def count(rows: dict, a: np.ndarray, b: np.ndarray, links: np.ndarray, roots: np.ndarray) -> None:
        ok = _close(rows["unit"], a, b, least)
        a, b = a[ok], b[ok]
        np.add.at(links, a, rows["n"][b])
        np.add.at(links, b, rows["n"][a])
        roots[:] = local_roots(len(roots), roots, a, b)

    def read(batch: pa.RecordBatch, low: int, high: int) -> Iterator[dict]:
        part = batch.slice(low, high - low)
        dims = part.column("dim").to_numpy()
        for dim in np.unique(dims):
            own = part.take(pa.array(np.flatnonzero(dims == dim)))
            vectors = np.frombuffer(b"".join(own.column("packed").to_pylist()), dtype=kind).reshape(own.num_rows, -1).astype(np.float64)
            lists = own.column("filters")
            sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False), lists.flatten().to_numpy(zero_copy_only=False)
            held = np.full((own.num_rows, int(sizes.max())), -1, dtype=np.int64)
            held[np.arange(held.shape[1]) < sizes[:, None]] = flat
            yield {"cell": np.stack([own.column(c).to_numpy() for c in ("dim", "filter", "low", "high")], axis=1), "unit": unit_vectors(vectors), "held": held} | {c: own.column(c).to_numpy() for c in ("chunk", "rep", "mark", "n")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.RecordBatch | None = None
        for batch in batches:
            if rest is not None:
                batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
            cell = np.stack([batch.column(c).to_numpy() for c in ("dim", "filter", "low", "high")], axis=1)
            last = int(np.flatnonzero(np.r_[True, (cell[1:] != cell[:-1]).any(1)])[-1])  # the last cell may go on
            rest = batch.slice(last)
            for rows in read(batch, 0, last) if last else ():
                if (out := compare(rows)) is not None:
                    yield out
        if rest is not None and rest.num_rows:
            for rows in read(rest, 0, rest.num_rows):
                if (out := compare(rows)) is not None:
                    yield out

    return run


def links(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST, miss: float = MISS, filter_rows: float = FILTER_ROWS, codes: int = CODES) -> DataFrame:
    """(key, n_links, component_id, kept), one row for each of ``rows``: with how many other vectors it has a cosine of ``least``
    or more, the smallest key that links reach, and whether that is its own.

    Each link is found with a probability that ``miss`` sets for the weakest ones; none is reported that isn't one. Equal vectors
    are compared once and all count. Vectors that are null, zero, or hold null or non-finite components, and rows
    without a key, link with nothing and are their own component (without a key: null, not kept). Rows that share a key count
    one by one and are one node of the components. Vectors of different lengths don't link. Other columns aren't returned."""
    kind = "<f8" if dict(rows.dtypes)[vector] == "array<double>" else "<f4"
    base = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v"))
    good = usable(F.col("v")) & F.col("id").isNotNull()
    classes = stash(base.where(good).groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")).select("rep", F.xxhash64("v").alias("mark"), "n", "v"), "caps-classes")
    signed = stash(classes.mapInArrow(_signatures(kind, classes.count(), least, miss, filter_rows, codes), "rep long, mark long, n long, packed binary, filters array<long>"), "caps-signed")
    dim = (F.length("packed") / np.dtype(kind).itemsize).cast("int").alias("dim")
    members = signed.select(dim, F.explode("filters").alias("filter")).groupBy("dim", "filter").agg(F.count("*").alias("members"))
    large = stash(members.where(F.col("members") > BLOCK).select("dim", "filter", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "caps-large")
    met = signed.select(dim, F.explode("filters").alias("filter"), "rep", "mark", "n", "packed", "filters").join(large, ["dim", "filter"], "left")
    met = met.withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("chunk", F.pmod(F.xxhash64("mark", "rep"), F.col("blocks")).cast("int"))
    cells = met.withColumn("x", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("low", F.least("chunk", "x")).withColumn("high", F.greatest("chunk", "x"))
    cells = cells.select(*(F.col(c).cast("long").alias(c) for c in ("dim", "filter", "low", "high", "chunk")), "rep", "mark", "n", "packed", "filters")
    dealt = cells.repartition("dim", "filter", "low", "high").sortWithinPartitions("dim", "filter", "low", "high")
    found = stash(dealt.mapInArrow(_cells(kind, least), "rep long, mark long, links long, other long"), "caps-links")
    discard(signed)
    discard(large)
    edges = found.where("rep <> other").select(F.col("rep").alias("u"), F.col("other").alias("v"))
    # a key with several vectors holds their classes together
    shared = base.where(good).groupBy("id").agg(F.min(F.xxhash64("v")).alias("a"), F.max(F.xxhash64("v")).alias("b")).where("a <> b").select("id")
    held = base.where(good).join(shared, "id").join(classes.select("v", "rep"), "v").select(F.col("id").alias("u"), F.col("rep").alias("v"))
    roots = connected_components(edges.unionByName(held))
    linked = found.groupBy("rep", "mark").agg(F.sum("links").alias("links"))
    judged = classes.join(linked, ["rep", "mark"], "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    judged = judged.select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    known = salted_join(base.where(good), judged, "v", F.xxhash64("id"), heavy_keys(classes, "v")).select("id", "n_links", "component_id")
    rest = base.where(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return known.unionByName(rest).select(F.col("id").alias(key), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def oracle() -> str:
    """All pairs."""
    return """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE len(embedding) > 0
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS size FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.size * b.size) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n_links, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN n USING (vec_id)"""
