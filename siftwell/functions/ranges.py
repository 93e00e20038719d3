"""Range lookup in a short sorted list of bounds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def range_of(c: Column, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most ``c``, as a balanced tree of comparisons."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(c >= F.lit(bounds[mid]), tree(mid + 1, high)).otherwise(tree(low, mid))

    return tree(0, len(bounds))
