"""Feature expressions over named columns; all of a table's features come from one ``select``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.operators.graph import numbered


def thermal(tmax: Column, tmin: Column, base: float = 10.0) -> dict[str, Column]:
    mean = (tmax + tmin) / 2
    out = {"gdd": F.greatest(mean - base, F.lit(0.0)), "heat_units": F.greatest(tmax - base, F.lit(0.0)), "temp_range": tmax - tmin, "temp_squared": mean * mean, "temp_cv": N.ratio(tmax - tmin, mean)}
    return out | {f"above_{t}": F.greatest(tmax - t, F.lit(0.0)) for t in (10, 15, 20, 25, 30, 35)}


def transforms(columns: Sequence[str]) -> dict[str, Column]:
    """log1p and square root of values clipped at 0, and squares that are not clipped."""
    out = {}
    for c in columns:
        v = F.col(c).cast("double")
        out |= {f"log_{c}": N.log1p0(v), f"sqrt_{c}": N.sqrt0(v), f"sq_{c}": v * v}
    return out


def ratios(pairs: Sequence[tuple[str, str]]) -> dict[str, Column]:
    return {f"{a}_per_{b}": N.ratio(F.col(a).cast("double"), F.col(b).cast("double")) for a, b in pairs}


def products(groups: Sequence[Sequence[str]]) -> dict[str, Column]:
    out = {}
    for g in groups:
        v = F.col(g[0]).cast("double")
        for c in g[1:]:
            v = v * F.col(c)
        out["_x_".join(g)] = v
    return out


def bell(x: Column, best: float, width: float) -> Column:
    """Gaussian suitability around an optimum."""
    return N.gaussian(x, best, width)


def balance(n: Column, p: Column, k: Column, ideal: Sequence[float] = (1.0, 0.5, 1.0)) -> Column:
    """1 - half the L1 distance of the shares to the ideal shares; null if all are 0."""
    total, s = n + p + k, sum(ideal)
    share = lambda v, i: F.abs(N.ratio(v, total) - ideal[i] / s)
    return 1 - (share(n, 0) + share(p, 1) + share(k, 2)) / 2


def status(x: Column, low: float, high: float) -> Column:
    return F.when(x.isNull(), "unknown").when(x < low, "low").when(x <= high, "medium").otherwise("high")


def flag(condition: Column) -> Column:
    """1 or 0; a null condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def encode_sorted(df: DataFrame, column: str, name: str) -> DataFrame:
    """Codes of the sorted distinct values, from 0; the table of values is joined to the data."""
    codes = df.select(column).filter(F.col(column).isNotNull()).distinct()
    return df.join(numbered(codes, [F.col(column)], name, 0), column, "left")


def encode_first_seen(df: DataFrame, column: str, order: Sequence[str], name: str) -> DataFrame:
    """Codes by first appearance in a given order."""
    seen = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.min(F.struct(*order)).alias("_o"))
    return df.join(numbered(seen, [F.col("_o"), F.col(column)], name, 0).select(column, name), column, "left")


def derive(df: DataFrame, rules: Sequence[tuple]) -> DataFrame:
    """Fill targets that are missing or null throughout from the first rule whose sources are there.

    rules: (target, sources, expression), applied where all sources have a value, or with "any"
    as a fourth entry where one has.  One aggregate tells which existing targets are empty.
    """
    present = [r[0] for r in rules if r[0] in df.columns]
    empty = set()
    if present:
        row = df.agg(*[F.count(t).alias(t) for t in dict.fromkeys(present)]).first()
        empty = {t for t in present if row[t] == 0}
    done, out = set(), {}
    for target, sources, expr, *how in rules:
        if target in done or (target in df.columns and target not in empty) or not all(s in df.columns for s in sources):
            continue
        there = [F.col(s).isNotNull() for s in sources]
        ready = reduce(lambda a, b: a | b if how == ["any"] else a & b, there)
        out[target] = F.when(ready, expr)
        done.add(target)
    return df.withColumns(out)


def convert_by_maximum(df: DataFrame, rules: Sequence[tuple[str, str, float, Column]]) -> DataFrame:
    """Apply a conversion to a column where its maximum is above or below a bound: (column, '>' or '<', bound, expression).

    One broadcast row of maxima keeps the plan lazy.
    """
    row = F.broadcast(df.agg(*[F.max(c).alias(f"_max_{c}") for c, _, _, _ in rules]))
    out = {}
    for c, sign, bound, expr in rules:
        m = F.col(f"_max_{c}")
        out[c] = F.when((m > bound) if sign == ">" else (m < bound), expr).otherwise(F.col(c))
    return df.crossJoin(row).withColumns(out).drop(*[f"_max_{c}" for c, _, _, _ in rules])


def quality_score(groups: dict[str, Sequence[str]]) -> Column:
    """Mean over groups of the share of a row's non-null columns."""
    shares = [sum((F.col(c).isNotNull().cast("int") for c in cs), F.lit(0)) / float(len(cs)) for cs in groups.values()]
    return sum(shares, F.lit(0.0)) / float(len(shares))


def missing_fields(columns: Sequence[str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
