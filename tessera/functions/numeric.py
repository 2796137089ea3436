"""Numeric column expressions: binning, rescaling, membership shapes, corrected moments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Double, or null where the text is no number; NaN becomes null (never an error)."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v), v)


def finite(c: Column) -> Column:
    """Null for infinities and NaN."""
    return F.when(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), c)


def bin_key(c: Column, tolerance: float) -> Column:
    """Half-even multiple of the tolerance, as long; the key of a spatial bin."""
    return F.bround(to_number(c) / F.lit(float(tolerance)), 0).cast("long")


def cut_right(c: Column, edges: Sequence[float]) -> Column:
    """Index of the right-closed interval (edges[i], edges[i + 1]]; null outside, lowest edge excluded."""
    out = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        out = F.when((c > lo) & (c <= hi), F.lit(i)).otherwise(out)
    return out


def cut_left(c: Column, edges: Sequence[float]) -> Column:
    """Index of the half-open interval [edges[i], edges[i + 1]); null outside."""
    out = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:])):
        out = F.when((c >= lo) & (c < hi), F.lit(i)).otherwise(out)
    return out


def cut_equal(c: Column, low: Column, high: Column, bins: int) -> Column:
    """Right-closed equal-width bin; the lowest edge is put 0.1 % of the range lower so the minimum falls in bin 0."""
    width = (high - low) / bins
    at = F.ceil((c - low) / F.when(width != 0, width)) - 1
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.coalesce(at, F.lit(bins // 2))))).cast("int")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return a / F.when(b != 0, b)


def log1p0(c: Column) -> Column:
    return F.log1p(F.greatest(c, F.lit(0.0)))


def sqrt0(c: Column) -> Column:
    return F.sqrt(F.greatest(c, F.lit(0.0)))


def clip(c: Column, lo: float, hi: float) -> Column:
    return F.when(c.isNotNull(), F.least(F.lit(float(hi)), F.greatest(F.lit(float(lo)), c)))


def row_mean(*cs: Column) -> Column:
    """Mean of the values that are there; null if none is."""
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs), F.lit(0.0))
    n = sum((c.isNotNull().cast("int") for c in cs), F.lit(0))
    return total / F.when(n > 0, n)


# membership shapes; the ramps carry an epsilon against zero width
EPSILON = 1e-10


def triangle(x: Column, a: float, b: float, c: float) -> Column:
    return F.greatest(F.lit(0.0), F.least((x - a) / (b - a + EPSILON), (c - x) / (c - b + EPSILON)))


def trapezoid(x: Column, a: float, b: float, c: float, d: float) -> Column:
    return F.greatest(F.lit(0.0), F.least((x - a) / (b - a + EPSILON), F.lit(1.0), (d - x) / (d - c + EPSILON)))


def gaussian(x: Column, mean: float, sigma: float) -> Column:
    return F.exp(-0.5 * ((x - mean) / sigma) * ((x - mean) / sigma))


def shoulder_high(x: Column, a: float, b: float) -> Column:
    return F.when(x <= a, 0.0).when(x >= b, 1.0).otherwise((x - a) / (b - a + EPSILON))


def shoulder_low(x: Column, a: float, b: float) -> Column:
    return 1 - shoulder_high(x, a, b)


def skewness_g1(c: Column) -> Column:
    """Bias-corrected skewness aggregate; 0 for up to two values."""
    n = F.count(c)
    return F.when(n > 2, F.skewness(c) * F.sqrt(n * (n - 1.0)) / (n - 2.0)).otherwise(0.0)


def kurtosis_g2(c: Column) -> Column:
    """Bias-corrected excess kurtosis aggregate; 0 for up to three values."""
    n = F.count(c)
    return F.when(n > 3, (n - 1.0) / ((n - 2.0) * (n - 3.0)) * ((n + 1.0) * F.kurtosis(c) + 6.0)).otherwise(0.0)


def pearson(x: Column, y: Column) -> Column:
    """Correlation over pairs where both are there; null, not an error, for a constant column."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.covar_pop(a, b) / F.when(spread != 0, spread)
