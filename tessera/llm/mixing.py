"""Mixing sources to target weights.

Each row gets a random key, the hash of its id.  Within a source rows are ordered by key:
they are dealt into ranges of the key, summed inside a range, and the sums of the ranges
before are added, so no task holds a source and no source is sorted in one place.  A source
whose target is T and whose size is S is taken T // S times whole, and the rest is cut at
the exact word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import stored, unused

WEIGHTS = (5, 2, 1)  # of the sources in order of code points, null last, repeating
MOST = 3  # times a source's size that its target may be
ADDED = ("size", "source_size", "target", "taken")
RANGES = 4096  # ranges of the key in each source


def n_words(text: Column) -> Column:
    """Number of words between ASCII white space; null has none."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.size(F.array_remove(parts, "")).cast("bigint")


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """sizes: source, source_size -> those and ``target`` (double).

    A share of weight w is min(most * size, w * level), the level such that shares add up to
    the sum of all sizes; sources at their limit are those of least limit / weight, so the
    level follows from running sums.  Sources of size 0 get 0.  One row per source: the
    windows below hold the list of sources, not their rows.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int"))
    s = sizes.withColumn("w", weight).withColumn("limit", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("limit") / F.col("w"), F.col("source").asc_nulls_last())
    before, everything = order.rowsBetween(Window.unboundedPreceding, -1), Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_all", F.sum("source_size").over(everything).cast("double"))
    s = s.withColumn("_level", (F.col("_all") - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) / F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    # the first source, in this order, whose limit is not below its share fixes the level
    level = F.min(F.when(F.col("w") * F.col("_level") <= F.col("limit"), F.struct(F.col("limit") / F.col("w"), "_level"))).over(everything)["_level"]
    return s.withColumn("_l", level).select("source", "source_size", F.coalesce(F.least(F.col("limit"), F.col("w") * F.col("_l")), F.col("limit")).alias("target"))


def mix(docs: DataFrame, seed: str = "0") -> DataFrame:
    """All columns of docs and size, source_size, target, taken (words of the row in the mix).

    docs: doc_id, text, source.  Null texts have size 0; a null source is a source of its
    own; null ids are hashed as empty text.  Ties of the key go by id, then by text.
    Columns of docs that clash with the new ones are replaced.  Sums are over all rows; an
    empty table gives an empty result.  The same rows give the same mix on every run.
    """
    mine = docs.drop(*ADDED)
    key_, range_, before_, source_, at_, offset_, same_ = unused(mine, "key", "range", "before", "source", "at", "offset", "same")
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    ranged = lambda k: (F.conv(F.substring(k, 1, 4), 16, 10).cast("int") / (65536 // RANGES)).cast("int")
    size = n_words(F.col("text"))
    sizes = stored(docs.select("source", size.alias("size")).groupBy("source").agg(F.sum("size").alias("source_size")), "sizes")
    goal = targets(sizes).withColumnRenamed("source", same_)
    rows = mine.withColumn("size", size).withColumn(key_, key).withColumn(range_, ranged(key_))
    inside = Window.partitionBy("source", range_).orderBy(key_, "doc_id", F.xxhash64("text")).rowsBetween(Window.unboundedPreceding, -1)
    sums = docs.select(F.col("source").alias(source_), size.alias("n"), key.alias(key_)).withColumn(at_, ranged(key_)).groupBy(source_, at_).agg(F.sum("n").alias("n"))
    ahead = Window.partitionBy(source_).orderBy(at_).rowsBetween(Window.unboundedPreceding, -1)  # at most RANGES rows per source
    offsets = sums.select(source_, at_, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(offset_))
    offsets = offsets.join(goal, F.col(source_).eqNullSafe(F.col(same_))).drop(same_)
    placed = rows.withColumn(before_, F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = placed.join(offsets, F.col("source").eqNullSafe(F.col(source_)) & (F.col(range_) == F.col(at_)))
    goal_n, whole = F.round("target").cast("bigint"), F.greatest("source_size", F.lit(1))
    epochs = F.floor(goal_n / whole).cast("bigint")
    rest = goal_n - epochs * whole
    cut = F.least(F.col("size"), F.greatest(F.lit(0), rest - F.col(offset_) - F.col(before_)))
    return placed.withColumn("taken", (epochs * F.col("size") + cut).cast("bigint")).select(*_quoted(mine), *ADDED)


def _quoted(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def mixed(docs: DataFrame, seed: str = "0") -> DataFrame:
    """The mix itself with the columns of docs, whatever their names: a row per epoch, the last one cut at the exact word.

    Where docs has ``n_chars`` it counts the characters of the cut text.
    """
    aside = dict(zip(ADDED, unused(docs, *ADDED)))
    aside = {c: aside[c.lower()] for c in docs.columns if c.lower() in aside}
    m = mix(docs.withColumnsRenamed(aside), seed)
    n_, whole_, part_ = unused(m, "n", "whole", "part")
    m = m.withColumn(whole_, F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int"))
    m = m.withColumn(part_, (F.col("taken") - F.col(whole_) * F.col("size")).cast("int"))
    copies = F.concat(F.array_repeat(F.lit(-1), F.col(whole_)), F.when(F.col(part_) > 0, F.array(F.col(part_))).otherwise(F.array().cast("array<int>")))
    m = m.withColumn(n_, F.explode(copies))
    head = F.array_join(F.slice(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""), 1, F.greatest(F.col(n_), F.lit(1))), " ")
    m = m.withColumn("text", F.when(F.col(n_) < 0, F.col("text")).otherwise(head))
    if "n_chars" in docs.columns:
        m = m.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return m.select(*[F.col(f"`{aside.get(c, c)}`").alias(c) for c in docs.columns])
