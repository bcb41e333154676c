"""Exact order statistics without funnelling a column through one task.

``kth_smallest`` narrows a value range by histogram refinement: each round is one distributed
aggregate returning at most ``buckets`` rows (count, min, max per bucket); the bucket holding
the wanted rank becomes the next range, until that bucket holds a single distinct value. The
driver receives bucket counts only, however many values there are and however skewed.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kth_smallest(df: DataFrame, col: str, k: int, buckets: int = 4096,
                 n: int | None = None) -> float:
    """The value at 0-based rank ``k`` of the non-NULL values of ``col``.

    Cache or checkpoint ``df`` first when it is expensive: every round rescans it."""
    x = F.col(col).cast("double")
    base = df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
    if n is None:
        n = base.count()
    if not 0 <= k < n:
        raise ValueError(f"rank {k} outside 0..{n - 1}")
    stats = base.agg(F.min("_x").alias("lo"), F.max("_x").alias("hi")).first()
    lo, hi = float(stats["lo"]), float(stats["hi"])
    below = 0
    while True:
        if lo == hi:
            return lo
        sub = base.filter((F.col("_x") >= F.lit(lo)) & (F.col("_x") <= F.lit(hi)))
        width = hi - lo
        b = F.least(F.floor((F.col("_x") - F.lit(lo)) / F.lit(width) * F.lit(buckets)),
                    F.lit(buckets - 1)).cast("int")
        hist = sorted(sub.groupBy(b.alias("b")).agg(
            F.count(F.lit(1)).alias("c"), F.min("_x").alias("mn"), F.max("_x").alias("mx"))
            .collect(), key=lambda r: r["b"])
        cum = below
        for r in hist:
            if cum + r["c"] > k:
                if r["mn"] == r["mx"]:
                    return float(r["mn"])
                lo, hi, below = float(r["mn"]), float(r["mx"]), cum
                break
            cum += r["c"]
        else:  # pragma: no cover - counts always cover rank k
            raise RuntimeError("rank not found")


def exact_percentile(df: DataFrame, col: str, q: float, **kw) -> float:
    """Linear-interpolated percentile (the NumPy default) of ``col`` at fraction ``q``."""
    x = F.col(col)
    n = df.filter(x.isNotNull()).count()
    if n == 0:
        return float("nan")
    pos = q * (n - 1)
    i, j = math.floor(pos), math.ceil(pos)
    a = kth_smallest(df, col, i, n=n, **kw)
    b = a if j == i else kth_smallest(df, col, j, n=n, **kw)
    return a if j == i else a + (b - a) * (pos - i)
