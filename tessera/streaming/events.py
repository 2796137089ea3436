"""Structured Streaming over event tables: windows, sessions, de-duplication, drift, upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 1) -> DataFrame:
    """A file stream with a budget of files per trigger; timestamps without zone become UTC instants."""
    df = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    return instants(df)


def instants(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def windowed(df: DataFrame, ts: str, by: Sequence[str], value: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Count, sum and mean per tumbling or sliding window; works on batch and stream alike."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    g = df.withWatermark(ts, late).groupBy(w.alias("w"), *by).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n", "total", "mean")


def sessions(df: DataFrame, ts: str, by: Sequence[str], gap: str, late: str = "10 minutes") -> DataFrame:
    g = df.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return g.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *by, "n")


def once(df: DataFrame, keys: Sequence[str], ts: str, late: str = "10 minutes") -> DataFrame:
    """Rows whose key was not seen within the watermark."""
    return df.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def drift(df: DataFrame, by: Sequence[str], value: str, degree: Column, limit: float = 0.8, least: int = 10) -> DataFrame:
    """Share of rows whose degree exceeds the limit, and the median, per group of at least ``least`` values."""
    g = df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.avg((degree > limit).cast("double")).alias("share"), F.median(value).alias("median"))
    return g.filter(F.col("n") >= least)


def drain(df: DataFrame, name: str, mode: str = "append", checkpoint: str | None = None) -> DataFrame:
    """Run a stream over what is there into a memory table and return it (tests and small results)."""
    w = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True)
    (w.option("checkpointLocation", checkpoint) if checkpoint else w).start().awaitTermination()
    return df.sparkSession.table(name)


def upsert_into(df: DataFrame, path: str, keys: Sequence[str], checkpoint: str):
    """Keep a keyed table at ``path`` up to date; each batch writes a new version beside the last and switches to it."""
    from tessera.operators.incremental import upsert

    spark = df.sparkSession

    def merge(batch: DataFrame, batch_id: int) -> None:
        old = f"{path}/v{batch_id - 1}"
        row = F.struct(*batch.columns)  # of a key's rows in one batch the largest wins, on every run
        new = batch.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max(row).alias("r")).select("r.*")
        (upsert(spark.read.parquet(old), new, keys) if batch_id else new).write.mode("overwrite").parquet(f"{path}/v{batch_id}")

    return df.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
