"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stored


def star_forest(frames: Iterator) -> Iterator:
    """Arrow batches of edges (a, b) of a partition as the star forest of their components (fewer, same reach)."""
    import pyarrow as pa

    parent: dict[int, int] = {}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def out():
        pairs = [(x, r) for x in parent if (r := root(x)) != x]
        return pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.int64()) for i in range(2)], names=["a", "b"])

    for part in frames:
        for a, b in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            x, y = root(parent.setdefault(a, a)), root(parent.setdefault(b, b))
            if x != y:
                parent[max(x, y)] = min(x, y)
        if len(parent) > 1_000_000:
            yield out()
            parent = {}
    yield out()


def components(edges: DataFrame, most: int = 60, stars: bool = False) -> DataFrame:
    """(node, label): the smallest node that each end of an edge (a, b) reaches.

    a, b: long, no nulls; loops and repeated edges are allowed.  A node without edges has no
    row.  Every round is written to the shared folder, so a lost executor costs one round.
    ``stars``: the partitions of edges are star forests already.  Edges that come from Python should
    be, for a second Python operator in one stage gives each task a second worker.
    """
    if not stars:
        edges = edges.filter("a <> b").select("a", "b").mapInArrow(star_forest, "a bigint, b bigint")
    now = stored(edges.filter("a <> b").distinct(), "edges")
    for _ in range(most):
        # large star: neighbours above a node go to its smallest neighbour
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # small star: a node and its lower neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").union(low.select("a", F.col("m").alias("b"))).distinct()
        after = stored(small, "edges")
        mark = lambda e: tuple(e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        same = mark(after) == mark(now)
        now = after
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {most} rounds")
    labels = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())
