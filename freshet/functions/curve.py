"""A space-filling curve: one number whose order keeps together what is close in several dimensions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def interleaved(*values: Column) -> Column:
    """The bits of some whole numbers taken in turn, the first one's first from above: their Morton number of 63 bits.

    Of each number its lowest 63 // n bits count, by two's complement if it is negative; null if any is.
    """
    n = len(values)
    if not 1 <= n <= 8:
        raise ValueError("a curve has one to eight dimensions")

    def bit(v: Column, of: int, at: int) -> Column:
        return F.shiftleft(F.shiftright(v, of).bitwiseAND(F.lit(1).cast("long")), at)

    bits = (bit(v.cast("long"), b, b * n + (n - 1 - d)) for b in range(63 // n) for d, v in enumerate(values))
    return reduce(Column.bitwiseOR, bits)
