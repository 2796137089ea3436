"""Places of regular expression matches as native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def matches(text: Column, pattern: str) -> Column:
    """array<struct<start, m>> of the leftmost non-overlapping matches; start in code points.

    What lies between matches (split) and the matches themselves alternate, so running
    lengths give the places.  Patterns must not match the empty text.
    """
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,m:string>>").alias("out"))

    def step(acc, x):
        at = acc["at"] + F.length(x["gap"])
        found = F.array(F.struct(at.cast("bigint").alias("start"), x["m"].alias("m")))
        return F.struct((at + F.coalesce(F.length(x["m"]), F.lit(0))).cast("bigint").alias("at"), F.when(x["m"].isNull(), acc["out"]).otherwise(F.concat(acc["out"], found)).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def none() -> Column:
    return F.array().cast("array<struct<start:bigint,m:string>>")


def listed(spans: Column) -> Column:
    """kind:start:end of spans in their order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
