"""What the operators of this package share: tables in the shared folder, byte buffers, hashes, components."""

from __future__ import annotations

import contextlib
import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# -- tables that cut lineage ----------------------------------------------------------------------


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; a temporary folder only for a local master that names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="wordspan-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Spark's own setting: at the end of a query its shuffle files go.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def files_cleaned(spark: SparkSession) -> Iterator[None]:
    """Queries run inside delete their shuffle files when they end; the session's own choice holds again afterwards."""
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)


def sweep(spark: SparkSession) -> None:
    """Let shuffle files go that no plan refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


def stash(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: the lineage ends there, so a lost executor
    costs a re-read at most. The shuffle files of the writing go when it ends. Those of earlier jobs go as
    soon as the driver has collected the plans that nothing refers to any more; it is asked to before each
    table, but on a cluster that may leave files of the job just ended to the next time."""
    spark = df.sparkSession
    sweep(spark)
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    with files_cleaned(spark):
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._stash = path
    return back


def discard(df: DataFrame | None, part: str = "") -> None:
    """Delete the files of a table made by ``stash``, or of one folder of it, that nothing reads any more."""
    path = getattr(df, "_stash", None)
    if path:
        path = f"{path}/{part}" if part else path
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        with contextlib.suppress(Exception):
            target.getFileSystem(conf).delete(target, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- joins on keys that may hold a large part of the rows -------------------------------------------

SALTS = 32
HEAVY_SHARE = 1000


def heavy_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """(key): those that hold more than 1 / HEAVY_SHARE of all rows, so fewer than HEAVY_SHARE keys.

    counts has one row a key."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return counts.where(F.col(n) > max(total // HEAVY_SHARE, 1)).select(key)


def salted_join(rows: DataFrame, single: DataFrame, key: str, deal: Column, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """Equi-join (inner or left) of ``rows`` with ``single`` (one row a key). The rows of the ``heavy`` keys are dealt
    over SALTS tasks by the hash ``deal``, and only the single rows of those keys are copied to them."""
    (mark, salt) = names_free(rows.join(single, key), "heavy", "salt")
    known = F.broadcast(heavy.select(key, F.lit(True).alias(mark)))  # fewer than HEAVY_SHARE rows
    dealt = rows.join(known, key, "left").withColumn(salt, F.when(F.col(mark), F.pmod(deal, F.lit(SALTS))).otherwise(F.lit(0)).cast("int")).drop(mark)
    copies = F.when(F.col(mark), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    return dealt.join(single.join(known, key, "left").withColumn(salt, F.explode(copies)).drop(mark), [key, salt], how).drop(salt)


# -- connected components -------------------------------------------------------------------------


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges (u, v) of long nodes -> (node, root): the smallest node that each node reaches.

    Alternating large-star and small-star rounds: every round is a grouped minimum (combined before
    the shuffle) and an equi-join, and the table of a round replaces that of the round before.
    Nothing but two numbers a round comes to the driver. Self-loops and repeated edges do no harm;
    nodes without an edge are not returned.
    """

    def oriented(e: DataFrame) -> DataFrame:
        return e.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        return e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))

    def digest(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stash(oriented(edges), "edges")
    seen = digest(now)
    while True:
        after = stash(oriented(small_star(oriented(large_star(now)))), "edges")
        mark = digest(after)
        discard(now)
        now = after
        if mark == seen:
            break
        seen = mark
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return pairs.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def local_roots(n: int, roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the links a-b into ``roots``, an array of n labels (each the smallest index of its set)."""
    while True:
        ra, rb = roots[a], roots[b]
        open_ = ra != rb
        if not open_.any():
            return roots
        ra, rb = ra[open_], rb[open_]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots = up


# -- bytes and rolling hashes ---------------------------------------------------------------------

_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of uint64 that spreads every bit (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """B**i and B**-i modulo 2**64 for i < n, at least."""
    have = _POWERS.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        base = _ODD[which]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            row = np.full(size, b, dtype=np.uint64)
            row[0] = 1
            out.append(np.multiply.accumulate(row))
        have = _POWERS[which] = (out[0], out[1])
    return have


class Rolling:
    """Polynomial hashes modulo 2**64 of any byte range of one buffer, after one pass over it."""

    _tables = [mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(k)) for k in (0xA24BAED4963EE407, 0x9FB21C651E98DF25)]

    def __init__(self, data: np.ndarray, which: int = 0):
        n = len(data)
        up, self.down = powers(which, n + 1)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self._tables[which][data] * up[:n], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mix((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, dtype=np.uint64)


def text_bytes(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of a string column, null as the empty string."""
    for x in column.cast(pa.binary()):
        yield x.as_py() or b""


def unsigned_hex(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def names_free(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of ``df``'s."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
