"""Ordered operators.  Each takes an explicit order; give ``by`` keys so that windows are dealt out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.quantiles import quantiles


def moving_average(df: DataFrame, value: str, by: Sequence[str], order: Sequence[str], rows: int = 7, name: str = "moving_avg") -> DataFrame:
    """Mean of up to ``rows`` values ending at the row."""
    return df.withColumn(name, F.avg(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(1 - rows, 0)))


def running_excess(df: DataFrame, value: str, limit: float, by: Sequence[str], order: Sequence[str], name: str = "running_excess") -> DataFrame:
    """Running sum of what exceeds a limit."""
    over = F.greatest(F.col(value) - limit, F.lit(0.0))
    return df.withColumn(name, F.sum(over).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)))


def average_rank(df: DataFrame, value: str, by: Sequence[str] = (), name: str = "avg_rank") -> DataFrame:
    """Descending rank in which ties share the mean of their places."""
    w = Window.partitionBy(*by)
    ties = F.count("*").over(Window.partitionBy(*by, value))
    return df.withColumn(name, F.rank().over(w.orderBy(F.col(value).desc())) + (ties - 1) / 2.0)


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark limits groups before the shuffle."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def zscores(df: DataFrame, value: str, by: Sequence[str], name: str = "zscore") -> DataFrame:
    """|x - mean| / deviation inside a group; null where the deviation is 0.  Joins a small aggregate, no window."""
    g = df.groupBy(*by).agg(F.avg(value).alias("_mu"), F.stddev_samp(value).alias("_sd"))
    joined = df.join(g, list(by)) if by else df.crossJoin(F.broadcast(g))
    return joined.withColumn(name, F.abs(F.col(value) - F.col("_mu")) / F.when(F.col("_sd") != 0, F.col("_sd"))).drop("_mu", "_sd")


def anomaly(df: DataFrame, value: str, name: str = "anomaly") -> DataFrame:
    """x minus the mean of the column; the mean is one broadcast row."""
    return df.crossJoin(F.broadcast(df.agg(F.avg(value).alias("_mu")))).withColumn(name, F.col(value) - F.col("_mu")).drop("_mu")


def share_of_max(df: DataFrame, value: str, low: float = 0.33, high: float = 0.90) -> DataFrame:
    """share (x / max), and whether x is below and above two exact quantiles."""
    lo, hi = quantiles(df, {value: F.col(value)}, [low, high])[value]
    row = F.broadcast(df.agg(F.max(value).alias("_max"), F.max(F.lit(lo).cast("double")).alias("_lo"), F.max(F.lit(hi).cast("double")).alias("_hi")))
    out = df.crossJoin(row).withColumns({"share": F.col(value) / F.when(F.col("_max") != 0, F.col("_max")), "is_low": F.col(value) < F.col("_lo"), "is_high": F.col(value) > F.col("_hi")})
    return out.drop("_max", "_lo", "_hi")


def latest(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row of each key, as an aggregate."""
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r")).select("r.*")


def versions(df: DataFrame, by: Sequence[str], order: Sequence[str], checksum: str) -> DataFrame:
    """Version number, superseding order value, status and whether the checksum changed, per key."""
    w = Window.partitionBy(*by).orderBy(*order)
    after, before = F.lead(order[-1]).over(w), F.lag(checksum).over(w)
    return df.withColumns({"version": F.row_number().over(w), "superseded_by": after, "status": F.when(after.isNull(), "active").otherwise("superseded"), "changed": before.isNull() | (before != F.col(checksum))})


def time_folds(df: DataFrame, order: Sequence[str], by: Sequence[str], n: int) -> DataFrame:
    """Expanding-window folds: block 0..n by time; fold k trains on blocks before k and tests block k."""
    return df.withColumn("block", F.ntile(n + 1).over(Window.partitionBy(*by).orderBy(*order)) - 1)


def islands(df: DataFrame, by: Sequence[str], start: str, end: str) -> DataFrame:
    """Overlapping intervals of a key merged: start, end, members."""
    w = Window.partitionBy(*by).orderBy(start, end)
    ahead = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    n = df.withColumn("_new", (ahead.isNull() | (F.col(start) > ahead)).cast("int"))
    n = n.withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return n.groupBy(*by, "_g").agg(F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("members")).drop("_g")
