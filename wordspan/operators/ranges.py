"""Ordered work on groups of any size: running totals and sliding sums that no single task holds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.core import free_names
from ..sources.tables import written


def _within(n_keys: int, value: int, names: list[str]):  # the value's place among the columns
    """Sorted rows of one partition -> the same with the partition's number and each group's running total there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, 0
        for batch in batches:
            n = batch.num_rows
            keys = [batch.column(i) for i in range(n_keys)]
            values = batch.column(value).fill_null(0).to_numpy()
            change = np.zeros(n, dtype=bool)
            for k in keys:
                differs = pc.fill_null(pc.not_equal(k[1:], k[:-1]), False).to_numpy(zero_copy_only=False)
                absent = k.is_null().to_numpy(zero_copy_only=False)
                change[1:] |= differs | (absent[1:] != absent[:-1])
            first = tuple(k[0].as_py() for k in keys) if n else None
            if n and first != last:
                total = 0
            sums = np.cumsum(values)
            starts = np.flatnonzero(change)
            before = np.zeros(n, dtype=sums.dtype)
            before[starts] = np.diff(np.r_[0, sums[starts - 1]]) if len(starts) else 0
            running = sums - np.cumsum(before)
            running[: starts[0] if len(starts) else n] += total
            if n:
                last, total = tuple(k[n - 1].as_py() for k in keys), int(running[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(running.astype(np.int64))], names=names)

    return run


def running_total(rows: DataFrame, keys: list[str], order: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the sum of the integer column ``value`` over the rows of the same keys up to and with this one.

    Rows are dealt by ranges of keys and order, whatever lies in them, and summed there as they stream by; then each range
    is raised by the totals of the group's ranges before it, a row for each group and range. So a group may hold all
    rows. Null keys are a group, null values count as 0; rows equal in keys and order stand in an arbitrary order."""
    part, total, low = free_names(rows, "part", "total", "low")
    spread = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    spread = spread.select(*keys, *[c for c in rows.columns if c not in keys], F.spark_partition_id().alias(part))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in spread.schema] + [f"`{total}` long"]
    summed = written(spread.mapInArrow(_within(len(keys), spread.columns.index(value), [*spread.columns, total]), ", ".join(fields)))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    totals = summed.groupBy(*keys, part).agg(F.sum(value).alias(low)).withColumn(low, F.coalesce(F.sum(low).over(before), F.lit(0)))
    totals = totals.toDF(*[f"{i}_of" for i in range(len(keys) + 1)], "low_of")
    same = [summed[k].eqNullSafe(F.col(f"{i}_of")) for i, k in enumerate([*keys, part])]
    return summed.join(totals, same, "left").select(*[summed[c] for c in rows.columns], (summed[total] + F.col("low_of")).alias(out))


def sliding_sum(rows: DataFrame, key: str, place: str, value: str, wide: int, out: str, block: int = 4096) -> DataFrame:
    """(key, place, out): the sum of ``value`` over ``wide`` places from each one that has so many ahead of it.

    Places are numbered without gaps. A key is cut into blocks of ``block`` places, and the first wide - 1 places of a block go
    to the block before as well (or to several, if the window is wider than a block), so that a block is summed by itself."""
    at = F.floor(F.col(place) / block)
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col(place) - (wide - 1)) / block))
    own, n = free_names(rows, "block", "n")
    dealt = rows.select(key, place, value, F.explode(F.sequence(first, at)).alias(own))
    ahead = Window.partitionBy(key, own).orderBy(place).rowsBetween(0, wide - 1)
    sums = dealt.select(key, place, own, F.sum(value).over(ahead).alias(out), F.count("*").over(ahead).alias(n))
    return sums.where((F.col(n) == wide) & (F.floor(F.col(place) / block) == F.col(own))).select(key, place, out)
