"""Tables of a data folder and the stand-ins of domain columns on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"})


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as observations with nulls: paper (order), treatment (line), measures, crop (flag)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("paper"), F.col("l_linenumber").alias("treatment"), F.col("l_partkey").alias("part"), F.col("l_suppkey").alias("supp"),
        F.nullif(F.col("l_quantity"), F.lit(7.0)).alias("nitrogen"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_extendedprice")).alias("yield_ha"),
        (F.col("l_discount") * 100).alias("moisture"), F.col("l_tax").alias("carbon"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_returnflag")).alias("crop"),
        F.col("l_linestatus").alias("soil"), F.col("l_shipdate").alias("day"),
    )


OBSERVATIONS = """obs AS (SELECT l_orderkey AS paper, l_linenumber AS treatment, l_partkey AS part, l_suppkey AS supp,
    nullif(l_quantity, 7.0) AS nitrogen, CASE WHEN l_partkey % 5 <> 0 THEN l_extendedprice END AS yield_ha, l_discount * 100 AS moisture, l_tax AS carbon,
    CASE WHEN l_suppkey % 3 <> 0 THEN l_returnflag END AS crop, l_linestatus AS soil, l_shipdate AS day FROM lineitem)"""
