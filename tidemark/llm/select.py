"""The k-th largest value of a distributed column, by counting."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def at_least_kth(values: DataFrame, k: int) -> float:
    """The largest cut that at least ``k`` values of the one double column reach.

    Each pass counts the values in equal bins of the open range and goes on in the bin with the
    k-th one, until that bin has a single value; only bin counts reach the driver.
    Null and NaN are left out. ``-inf`` for all or more, ``inf`` for none.
    """
    name = values.columns[0]
    column = F.col(name)
    values = values.where(column.isNotNull() & ~F.isnan(column))
    low, high, n = values.agg(F.min(name), F.max(name), F.count(name)).first()
    if k <= 0:
        return math.inf
    if n is None or k >= n:
        return -math.inf
    while low < high:
        width = (high - low) / BINS
        inside = values.where((column >= low) & (column <= high))
        bin_of = F.least(F.floor((column - low) / width), F.lit(BINS - 1)) if width > 0 else F.lit(0)
        counts = inside.groupBy(bin_of.alias("bin")).agg(F.count("*").alias("n"), F.min(name).alias("low"), F.max(name).alias("high"))
        for row in sorted(counts.collect(), key=lambda r: -r["bin"]):
            if row["n"] >= k:
                if (row["low"], row["high"]) == (low, high):  # neighbours in floating point
                    return low
                low, high = row["low"], row["high"]
                break
            k -= row["n"]
    return low
