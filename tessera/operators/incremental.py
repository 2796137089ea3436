"""Incremental operators: upserts, registries, change detection, triggers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both by key; a non-null new value wins over the old one.  Keys are unique on each side."""
    o, n = old.alias("o"), new.alias("n")
    on = None
    for k in keys:
        c = F.col(f"o.{k}") == F.col(f"n.{k}")
        on = c if on is None else on & c
    return o.join(n, on, "full").select(*[F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}")).alias(c) for c in old.columns])


def unseen(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of new whose key is not in seen."""
    return new.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def changes(old: DataFrame, new: DataFrame, key: str, checksum: Sequence[str]) -> DataFrame:
    """(key, change): added, removed, changed, unchanged, by a hash of the given columns."""
    mark = F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in checksum]), 256)
    o, n = old.select(F.col(key).alias("key"), mark.alias("was")), new.select(F.col(key).alias("key"), mark.alias("now"))
    kind = F.when(F.col("was").isNull(), "added").when(F.col("now").isNull(), "removed").when(F.col("was") != F.col("now"), "changed").otherwise("unchanged")
    return o.join(n, "key", "full").select(F.col("key").alias(key), kind.alias("change"))


def affected(graph: dict[str, list[str]], changed: set[str]) -> list[str]:
    """Stages downstream of changed ones, in topological order; graph maps a stage to what it needs."""
    order, done = [], set()

    def visit(s):
        if s not in done:
            done.add(s)
            for d in graph.get(s, []):
                visit(d)
            order.append(s)

    for s in graph:
        visit(s)
    hit = set(changed)
    for s in order:
        if set(graph.get(s, [])) & hit:
            hit.add(s)
    return [s for s in order if s in hit]


def retrain_due(n: Column, previous: Column, least: int = 20, growth: float = 0.15) -> Column:
    """Enough rows, and either no history or growth beyond the share."""
    return (n >= least) & (previous.isNull() | ((n - previous) > growth * previous))


def schedule_due(last: Column, now: Column, seconds: Column) -> Column:
    return last.isNull() | (F.unix_timestamp(now) - F.unix_timestamp(last) >= seconds)


def priority(df: DataFrame, by: Sequence[str], kind: str, ranks: Sequence[str]) -> DataFrame:
    """The row of the best format per key: the earliest in ``ranks``, unknown ones last, then by name."""
    place = F.array_position(F.array(*[F.lit(r) for r in ranks]), F.col(kind))
    rank = F.struct(F.when(place == 0, len(ranks) + 1).otherwise(place).alias("p"), F.col(kind).alias("k"))
    return df.groupBy(*[F.col(k).alias(f"_{k}") for k in by]).agg(F.min_by(F.struct(*df.columns), rank).alias("r")).select("r.*")


def cached(puts: DataFrame, keys: Sequence[str], body: str, order: Sequence[str]) -> DataFrame:
    """State of a raw cache from its log of puts: the last body by the order given and the number of puts per key.

    Combined before the shuffle, so a key that is put without end sends one row per task.  A null order comes first.
    """
    return puts.groupBy(*keys).agg(F.max_by(F.struct(F.col(body)), F.struct(*order)).alias("_b"), F.count(F.lit(1)).alias("puts")).select(*keys, F.col(f"_b.{body}").alias("body"), "puts")
