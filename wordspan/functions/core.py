"""Helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value made once even where body uses it in a lambda for each element."""
    return F.transform(F.array(value), body)[0]


def half_even(numerator: Column, denominator: Column, places: int) -> Column:
    """numerator / denominator (integers, the denominator positive) rounded half to even, as a double."""
    k = 10**places
    n, d = numerator.cast("long") * k, denominator.cast("long")
    q = F.floor(n / d).cast("long")
    q = q + F.when(n - q * d < 0, -1).when(n - q * d >= d, 1).otherwise(0)
    r = n - q * d
    up = (2 * r > d) | ((2 * r == d) & (F.pmod(q, F.lit(2)) == 1))
    return (q + up.cast("long")) / F.lit(float(k))


def fixed(value: Column, places: int) -> Column:
    """A double as text with ``places`` decimals, rounded by its exact binary value, ties to even, as C and Python write it.

    ``format_string`` rounds the shortest decimal notation instead, ties up: 0.3125 to 0.313, 0.4125 (which is less) to 0.413.
    For values under 2^52 / 10^places."""
    k = float(10**places)

    def of(x: Column) -> Column:
        scaled, high = x * k, x * 134217729.0 - (x * 134217729.0 - x)  # high: the upper half of the digits
        rest = (high * k - scaled) + (x - high) * k  # what the product lost, exactly
        tie = scaled - F.floor(scaled) == 0.5
        whole = F.when(tie & (rest > 0), F.ceil(scaled).cast("double")).when(tie & (rest < 0), F.floor(scaled).cast("double")).otherwise(F.rint(scaled))
        return F.when(x.isNotNull(), F.format_string(f"%.{places}f", whole / k))

    return let(value, of)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for helper columns that clash with none of ``df``'s."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
