"""Exact quantiles without gathering a column's values in one task.

A sketch brackets each rank, one aggregate counts what lies below and inside the bracket, and
brackets are narrowed until the distinct values inside are few; those alone come to the driver.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000  # of the sketch: a rank is off by at most 1 in so many rows
INSIDE = 20_000  # rows of a bracket that are fetched, at most, unless they are equal


def quantiles(df: DataFrame, columns: dict[str, Column], shares: Sequence[float]) -> dict[str, list[float | None]]:
    """The interpolated quantiles of each column at each share; None where a column has no value.

    A round is two aggregates over df and leaves about 4 / ACCURACY of a bracket's rows.
    """
    slim = df.select(*[c.cast("double").alias(f"v{i}") for i, c in enumerate(columns.values())])
    v = lambda k: F.col(f"v{k[0]}")
    around = lambda lo, hi: [max(0.0, lo - 2 / ACCURACY), min(1.0, hi + 2 / ACCURACY)]
    spans = [x for s in shares for x in around(s, s)]
    first = slim.agg(*[x for i in range(len(columns)) for x in (F.count(f"v{i}"), F.percentile_approx(f"v{i}", spans, ACCURACY))]).first()
    counts = first[::2]
    ends = {(i, j): (math.floor(s * (counts[i] - 1)), math.ceil(s * (counts[i] - 1))) for i in range(len(columns)) if counts[i] for j, s in enumerate(shares)}
    guess = {(i, j): tuple(first[2 * i + 1][2 * j : 2 * j + 2]) for i, j in ends}
    bracket = {k: (-math.inf, math.inf, 0, counts[k[0]]) for k in ends}  # low, high, rows below, rows inside
    known: dict[tuple[int, int], tuple[float, float]] = {}
    while guess:
        seen = slim.agg(*[x for k, g in guess.items() for x in (F.count_if(v(k) < g[0]), F.count_if(v(k).between(*g)))]).first()
        large = []
        for n, (k, (low, high)) in enumerate(guess.items()):
            below, within = seen[2 * n], seen[2 * n + 1]
            if below <= ends[k][0] and ends[k][1] < below + within:  # else the sketch missed: all values of the bracket are fetched
                smaller = within < bracket[k][3]
                bracket[k] = (low, high, below, within)
                if low == high:
                    known[k] = (low, high)
                elif within > INSIDE and smaller:
                    large.append(k)
        cuts = [F.percentile_approx(F.when(v(k).between(*bracket[k][:2]), v(k)), around(*((e - bracket[k][2]) / max(1, bracket[k][3] - 1) for e in ends[k])), ACCURACY) for k in large]
        guess = {k: tuple(x) for k, x in zip(large, slim.agg(*cuts).first())} if large else {}
    rest = [k for k in ends if k not in known]
    if rest:
        each = F.array(*[F.when(v(k).between(*bracket[k][:2]), F.struct(F.lit(n).alias("n"), v(k).alias("v"))) for n, k in enumerate(rest)])
        found: dict[int, list] = {}
        for row in slim.select(F.explode(F.array_compact(each)).alias("p")).groupBy("p.n", "p.v").agg(F.count("*").alias("c")).collect():
            found.setdefault(row.n, []).append((row.v, row.c))
        for n, k in enumerate(rest):
            inside = sorted(found[n])
            values, upto = [x for x, _ in inside], list(accumulate(c for _, c in inside))
            known[k] = tuple(values[bisect_right(upto, e - bracket[k][2])] for e in ends[k])
    mixed = lambda k, at: known[k][0] + (at - math.floor(at)) * (known[k][1] - known[k][0])
    return {name: [mixed((i, j), s * (counts[i] - 1)) if counts[i] else None for j, s in enumerate(shares)] for i, name in enumerate(columns)}
