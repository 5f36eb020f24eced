"""Exact quantiles of a whole column without gathering it: ranks found by counting.

A histogram pass counts the values of every bin between the least and the greatest value (partial counts before the shuffle, a row a bin to the
driver) and tells in which bin each wanted rank lies, and its rank there. Only those bins are counted again, finer, until a
bin holds one distinct value or few enough values to sort. Ties are one value however many there are, so no task ever holds a group that grows
with the data. The result equals ``percentile`` (linear interpolation between neighbouring ranks).
"""

from __future__ import annotations

from functools import reduce
from math import ceil, floor
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bins of a pass, and the most values that are sorted at once.
BINS, FEW = 1024, 4096


def order_statistics(df: DataFrame, col: str, ranks: list[int], n: int, least: float, greatest: float, bins: int = BINS, few: int = FEW) -> dict:
    """rank (from 0) -> value, over the n non-null values of ``col`` between ``least`` and ``greatest``."""
    x = F.col(col).cast("double")
    left = {r: (least, greatest, r, n) for r in ranks}   # rank -> (bounds of its bin, rank in the bin, values in the bin)
    out: dict = {}
    while left:
        out.update({r: a for r, (a, b, _, _) in left.items() if a == b})
        left = {r: v for r, v in left.items() if v[0] != v[1]}
        for a, b in {v[:2] for v in left.values() if v[3] <= few}:
            values = sorted(row[0] for row in df.where(x.between(a, b)).select(x).collect())
            out.update({r: values[k] for r, (lo, hi, k, _) in left.items() if (lo, hi) == (a, b)})
        left = {r: v for r, v in left.items() if r not in out}
        spans = sorted({v[:2] for v in left.values()})
        if not spans:
            break
        # Monotone in x; halves keep the widest range finite. The ends fall into different bins, so every pass narrows.
        place = [F.least(F.floor((x / 2 - a / 2) / (b / 2 - a / 2) * bins), F.lit(bins - 1)) for a, b in spans]
        which = reduce(lambda c, i: c.when(x.between(*spans[i]), F.struct(F.lit(i).alias("span"), place[i].alias("bin"))), range(1, len(spans)),
                       F.when(x.between(*spans[0]), F.struct(F.lit(0).alias("span"), place[0].alias("bin"))))
        counted = df.where(reduce(or_, [x.between(a, b) for a, b in spans])).groupBy(which.alias("at")).agg(
            F.count(F.lit(1)).alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi"))
        found: dict = {}
        for row in sorted(counted.collect(), key=lambda r: (r["at"]["span"], r["at"]["bin"])):
            found.setdefault(spans[row["at"]["span"]], []).append((row["n"], row["lo"], row["hi"]))
        for r, (a, b, k, _) in list(left.items()):
            for count, lo, hi in found[a, b]:
                if k < count:
                    left[r] = (lo, hi, k, count)
                    break
                k -= count
    return out


def exact_quantiles(df: DataFrame, col: str, ps: list[float], bins: int = BINS, few: int = FEW) -> list:
    """The quantiles ``ps`` of a numeric column (None each if it has no values); NaN counts as no value."""
    x = F.col(col).cast("double")
    df = df.where(x.isNotNull() & ~F.isnan(x))
    n, least, greatest = df.agg(F.count(F.lit(1)), F.min(x), F.max(x)).first()
    if not n:
        return [None] * len(ps)
    at = [p * (n - 1) for p in ps]
    value = order_statistics(df, col, sorted({f(h) for h in at for f in (floor, ceil)}), n, least, greatest, bins, few)
    return [value[floor(h)] if h == floor(h) else (ceil(h) - h) * value[floor(h)] + (h - floor(h)) * value[ceil(h)] for h in at]
