"""Profiles and data quality: missing values, moments, quantiles, outliers, correlations, checks.

Each profile is one aggregate over the table, unpivoted afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.operators.quantiles import quantiles


def _long(row: DataFrame, columns: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One row per column from a single row with fields named column__field."""
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in columns])
    return row.select(F.explode(parts).alias("p")).select("p.*")


def missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, missing, available, missing_pct."""
    aggs = []
    for c in columns:
        n = F.count_if(F.col(c).isNull())
        aggs += [n.alias(f"{c}__missing"), F.count(c).alias(f"{c}__available"), F.round(100.0 * n / F.nullif(F.count("*"), F.lit(0)), 4).alias(f"{c}__missing_pct")]
    return _long(df.agg(*aggs), columns, ["missing", "available", "missing_pct"])


def columns_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column_name, available, distinct, constant: exact distinct counts."""
    aggs = []
    for c in columns:
        d = F.count_distinct(c)
        aggs += [F.count(c).alias(f"{c}__available"), d.alias(f"{c}__n_distinct"), (d <= 1).alias(f"{c}__constant")]
    return _long(df.agg(*aggs), columns, ["available", "n_distinct", "constant"])


def statistics(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    """n, mean, median, variance, deviation, extremes, corrected skewness and kurtosis, quartiles; exact.

    Quartiles come from narrowed brackets, so no task gathers a column's values.
    """
    cut = quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    at = lambda c, i: F.round(F.max(F.lit(cut[c][i]).cast("double")), digits)
    fields = {
        "n": lambda c: F.count(c), "mean": lambda c: F.round(F.avg(c), digits), "median": lambda c: at(c, 1),
        "variance": lambda c: F.round(F.var_samp(c), digits), "deviation": lambda c: F.round(F.stddev_samp(c), digits), "least": lambda c: F.min(c), "most": lambda c: F.max(c),
        "skew": lambda c: F.round(N.skewness_g1(F.col(c)), digits), "kurt": lambda c: F.round(N.kurtosis_g2(F.col(c)), digits), "q1": lambda c: at(c, 0), "q3": lambda c: at(c, 2),
    }
    return _long(df.agg(*[f(c).alias(f"{c}__{k}") for c in columns for k, f in fields.items()]), columns, list(fields))


def outliers(df: DataFrame, columns: Sequence[str], factor: float = 1.5, z: float = 3.0, mad: float = 3.5) -> DataFrame:
    """column_name and the number of outliers by quartile range, deviation and median deviation.

    Quantiles come from narrowed brackets, the median deviation likewise, then one pass counts.
    The rules need over 3 values and a positive range, a positive deviation, and 5 values.
    """
    cut = quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.5, 0.75])
    off = quantiles(df, {c: F.abs(F.col(c) - F.lit(cut[c][1]).cast("double")) for c in columns}, [0.5])
    first = F.broadcast(df.agg(*[x for c in columns for x in (F.avg(c).alias(f"{c}__mu"), F.stddev_samp(c).alias(f"{c}__sd"), F.count(c).alias(f"{c}__n"))]))
    aggs = []
    for c in columns:
        v, of = F.col(c), lambda k, c=c: F.col(f"{c}__{k}")
        q1, med, q3, middle = (F.lit(x).cast("double") for x in (*cut[c], *off[c]))
        aggs += [
            F.count_if((of("n") > 3) & (q3 > q1) & ((v < q1 - factor * (q3 - q1)) | (v > q3 + factor * (q3 - q1)))).alias(f"{c}__iqr"),
            F.count_if((of("sd") > 0) & (F.abs(v - of("mu")) > z * of("sd"))).alias(f"{c}__zscore"),
            F.count_if((of("n") >= 5) & (middle > 0) & (0.6745 * F.abs(v - med) > mad * middle)).alias(f"{c}__mad_count"),
        ]
    return _long(df.select(*columns).crossJoin(first).agg(*aggs), columns, ["iqr", "zscore", "mad_count"])


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, r) with a before b, pairwise complete; one aggregate over the table."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(*[N.pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"r{k}") for k, (a, b) in enumerate(pairs)])
    return row.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"r{k}").alias("r")) for k, (a, b) in enumerate(pairs)])).alias("p")).select("p.*")


def high_pairs(corr: DataFrame, threshold: float = 0.8) -> DataFrame:
    return corr.filter(F.abs("r") >= threshold).orderBy(F.abs("r").desc(), "a", "b")


def inflation(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Variance inflation of each column: the diagonal of the inverse correlation matrix of complete rows.

    The driver inverts a columns x columns matrix of one aggregate; under ten rows it is infinite.
    """
    import numpy as np

    full = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = full.agg(F.count("*").alias("n"), *[N.pearson(F.col(a), F.col(b)).alias(f"r{k}") for k, (a, b) in enumerate(pairs)]).first()
    m = np.eye(len(columns))
    for k, (a, b) in enumerate(pairs):
        i, j = columns.index(a), columns.index(b)
        m[i, j] = m[j, i] = row[f"r{k}"] if row[f"r{k}"] is not None else 0.0
    vif = np.full(len(columns), np.inf) if row["n"] < 10 or np.linalg.matrix_rank(m) < len(columns) else np.diag(np.linalg.inv(m))
    return df.sparkSession.createDataFrame([(c, float(v)) for c, v in zip(columns, vif)], "column_name string, vif double")


def range_checks(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """column_name, low, high, checked, violations of each bound whose column is there; one pass."""
    have = [c for c in bounds if c in df.columns]
    aggs = [x for c in have for x in (F.count(c).alias(f"{c}__checked"), F.count_if((F.col(c) < bounds[c][0]) | (F.col(c) > bounds[c][1])).alias(f"{c}__violations"), F.lit(float(bounds[c][0])).alias(f"{c}__low"), F.lit(float(bounds[c][1])).alias(f"{c}__high"))]
    return _long(df.agg(*aggs), have, ["low", "high", "checked", "violations"])


def rule_violations(df: DataFrame, key: Sequence[str], rules: Sequence[tuple[str, Column, Column, str]]) -> DataFrame:
    """Long table (key..., rule, severity) of rules (name, applies, holds, severity) that apply and fail."""
    broken = F.array_compact(F.array(*[F.when(applies & ~holds, F.struct(F.lit(n).alias("rule"), F.lit(s).alias("severity"))) for n, applies, holds, s in rules]))
    return df.select(*key, F.explode(broken).alias("v")).select(*key, "v.*")


def contract(df: DataFrame, required: dict[str, str], not_null: Sequence[str] = ()) -> DataFrame:
    """(check, column_name, detail) of a schema contract: missing, unexpected, type, null values."""
    have = dict(df.dtypes)
    rows = [("missing", c, t) for c, t in required.items() if c not in have]
    rows += [("unexpected", c, t) for c, t in have.items() if c not in required]
    rows += [("type", c, f"{have[c]} for {t}") for c, t in required.items() if c in have and have[c] != t]
    static = df.sparkSession.createDataFrame(rows, "check string, column_name string, detail string")
    checked = [c for c in not_null if c in have]
    if not checked:
        return static
    nulls = _long(df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__detail") for c in checked]), checked, ["detail"]).filter("detail > 0")
    return static.unionByName(nulls.select(F.lit("null").alias("check"), "column_name", F.col("detail").cast("string").alias("detail")))


def regression_metrics(df: DataFrame, actual: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """n, r2, rmse, mae, mape in one pass from moment sums; r2 is null for a constant target."""
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    both = y.isNotNull() & F.col(predicted).isNotNull()
    y, e = F.when(both, y), F.when(both, e)
    total = F.var_pop(y) * F.count(y)
    aggs = [
        F.count(y).alias("n"), (1 - F.sum(e * e) / F.when(total != 0, total)).alias("r2"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(F.abs(e)).alias("mae"),
        (100 * F.avg(F.abs(e) / F.when(y != 0, F.abs(y)))).alias("mape"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def histogram(df: DataFrame, c: str, edges: Sequence[float]) -> DataFrame:
    """(bin, n) of half-open bins; empty bins are there with 0."""
    bins = df.sparkSession.range(len(edges) - 1).select(F.col("id").cast("int").alias("bin"))
    n = df.select(N.cut_left(F.col(c), edges).alias("bin")).groupBy("bin").agg(F.count("*").alias("n"))
    return bins.join(F.broadcast(n), "bin", "left").select("bin", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
