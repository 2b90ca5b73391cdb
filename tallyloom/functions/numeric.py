"""Numeric helpers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _unless_any_null(args: tuple[Column, ...], value: Column) -> Column:
    return F.when(reduce(lambda a, b: a & b, [a.isNotNull() for a in args]), value)


def strict_least(*args: Column) -> Column:
    """Smallest argument, NULL if any is NULL (Spark's ``least`` skips NULLs)."""
    return _unless_any_null(args, F.least(*args))


def strict_greatest(*args: Column) -> Column:
    """Largest argument, NULL if any is NULL (Spark's ``greatest`` skips NULLs)."""
    return _unless_any_null(args, F.greatest(*args))


def next_pow2(n: Column) -> Column:
    """Smallest power of two that is at least ``n``, and 1 below that.

    Counts binary digits instead of taking logarithms, so it is exact.
    """
    n = n.cast("long")
    return F.when(n <= 1, F.lit(1).cast("long")).when(
        n > 1, F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n - 1)))
    )
