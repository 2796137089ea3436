"""Graph operators over node and edge tables; iterations stop early and cut their lineage in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the folder of ``spark.checkpoint.dir`` (a temporary one in local runs without it)."""
    spark: SparkSession = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tessera-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"  # a bare path is one of the cluster's default file system
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: Sequence, name: str, start: int = 1) -> DataFrame:
    """df with each row's place (int) in a total order under ``name``; ranges of the order are numbered apart and added up."""
    from pyspark.sql import Window

    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = written(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "numbered")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    ahead = dealt.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_ahead") + (start - 1)
    return dealt.join(F.broadcast(ahead), "_part").withColumn(name, place.cast("int")).drop("_part", "_ahead")


def property_graph(df: DataFrame, nodes: Sequence[tuple[str, str]], edges: Sequence[tuple[str, str, str]]) -> tuple[DataFrame, DataFrame]:
    """Nodes (id, type, name) and edges (src, dst, type) of a wide table; nulls make neither."""
    ident = lambda t, c: F.concat(F.lit(f"{t}:"), F.col(c).cast("string"))
    n = None
    for t, c in nodes:
        part = df.select(ident(t, c).alias("id"), F.lit(t).alias("type"), F.col(c).cast("string").alias("name")).filter(F.col("name").isNotNull()).distinct()
        n = part if n is None else n.union(part)
    e, kind = None, {c: t for t, c in nodes}
    for a, b, t in edges:
        part = df.select(ident(kind[a], a).alias("src"), ident(kind[b], b).alias("dst"), F.lit(t).alias("type")).filter("src is not null and dst is not null").distinct()
        e = part if e is None else e.union(part)
    return n, e


def invalid_edges(nodes: DataFrame, edges: DataFrame, allowed: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Edges whose ends are missing or whose (source type, edge type, target type) is not allowed."""
    ok = edges.sparkSession.createDataFrame(list(allowed), "src_type string, type string, dst_type string")
    a = nodes.select(F.col("id").alias("src"), F.col("type").alias("src_type"))
    b = nodes.select(F.col("id").alias("dst"), F.col("type").alias("dst_type"))
    typed = edges.join(a, "src", "left").join(b, "dst", "left")
    return typed.join(F.broadcast(ok), ["src_type", "type", "dst_type"], "left_anti").select("src", "dst", "type")


def neighbours(edges: DataFrame, node, direction: str = "both") -> DataFrame:
    out, into = edges.filter(F.col("src") == node).select(F.col("dst").alias("id")), edges.filter(F.col("dst") == node).select(F.col("src").alias("id"))
    return (out if direction == "out" else into if direction == "in" else out.union(into)).distinct()


def degrees(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """id, in_degree, out_degree, degree and centralities (degree / (n - 1)); isolated nodes have 0."""
    long = edges.select(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")).union(edges.select("dst", F.lit(0), F.lit(1)))
    d = long.groupBy("id").agg(F.sum("i").alias("in_degree"), F.sum("o").alias("out_degree"))
    n = F.broadcast(nodes.agg(F.count("*").alias("_n")))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    out = nodes.select("id").join(d, "id", "left").crossJoin(n).withColumns({"in_degree": zero(F.col("in_degree")), "out_degree": zero(F.col("out_degree"))})
    out = out.withColumn("degree", F.col("in_degree") + F.col("out_degree"))
    return out.withColumn("centrality", F.col("degree") / F.nullif(F.col("_n") - 1, F.lit(0))).drop("_n")


def components(nodes: DataFrame, edges: DataFrame, most: int = 50) -> DataFrame:
    """(id, component): the least id that a node reaches, ignoring direction; hash-to-min with early stop."""
    both = edges.select(F.col("src").alias("a"), F.col("dst").alias("b")).union(edges.select("dst", "src")).filter("a <> b").distinct()
    both = written(both, "neighbours")
    now = written(nodes.select("id", F.col("id").alias("component")), "labels")
    for _ in range(most):
        heard = both.join(now, both.b == now.id).groupBy("a").agg(F.min("component").alias("m"))
        after = now.join(heard, now.id == heard.a, "left").select("id", F.least("component", F.coalesce("m", "component")).alias("component"))
        # the label's own label: paths shrink by half each round
        jump = after.select(F.col("id").alias("component"), F.col("component").alias("next"))
        after = written(after.join(jump, "component", "left").select("id", F.least("component", "next").alias("component")), "labels")
        changed = after.join(now.withColumnRenamed("component", "old"), "id").filter("component <> old").limit(1).count()
        now = after
        if not changed:
            return now
    raise RuntimeError(f"components did not settle in {most} rounds")


def summary(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes, edges, isolates, weak components, density e / (n (n - 1)), one row."""
    d = degrees(nodes, edges)
    c = components(nodes, edges).agg(F.count_distinct("component").alias("components"))
    base = d.agg(F.count("*").alias("n_nodes"), F.count_if(F.col("degree") == 0).alias("isolates"))
    e = edges.agg(F.count("*").alias("n_edges"))
    return base.crossJoin(e).crossJoin(c).withColumn("density", F.col("n_edges") / F.nullif(F.col("n_nodes") * (F.col("n_nodes") - 1), F.lit(0)))


def distances(edges: DataFrame, start, most: int | None = None, reverse: bool = False, bound: int = 1000) -> DataFrame:
    """(id, hops): directed breadth-first distances from a node; with reverse, of everything upstream of it.

    Goes on until no new node is met, or as far as ``most`` hops where that is what is asked for.
    """
    src, dst = ("dst", "src") if reverse else ("src", "dst")
    spark = edges.sparkSession
    seen = spark.createDataFrame([(start, 0)], f"id {dict(edges.dtypes)['src']}, hops int")
    front, k = seen, 0
    while most is None or k < most:
        k += 1
        step = edges.join(front, edges[src] == front.id).select(F.col(dst).alias("id")).distinct()
        front = written(step.join(seen, "id", "left_anti").withColumn("hops", F.lit(k)), "front")
        if front.limit(1).count() == 0:
            break
        if k > bound:
            raise RuntimeError(f"nodes more than {bound} hops away")
        seen = written(seen.union(front), "seen")
    return seen


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, rounds: int = 20) -> DataFrame:
    """(id, rank); the rank of nodes without out-edges is spread over all."""
    n = nodes.count()
    out = edges.groupBy("src").agg(F.count("*").alias("out"))
    links = written(edges.join(out, "src").select("src", "dst", "out"), "links")
    sinks = written(nodes.select("id").join(out, nodes.id == out.src, "left_anti"), "sinks")
    rank = nodes.select("id", F.lit(1.0 / max(n, 1)).alias("rank"))
    for k in range(rounds):
        given = links.join(rank, links.src == rank.id).groupBy("dst").agg(F.sum(F.col("rank") / F.col("out")).alias("g"))
        lost = F.broadcast(sinks.join(rank, "id").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost")))
        rank = nodes.select("id").join(given, nodes.id == given.dst, "left").crossJoin(lost).select("id", ((1 - damping) / n + damping * (F.coalesce("g", F.lit(0.0)) + F.col("lost") / n)).alias("rank"))
        if k % 5 == 4 or k == rounds - 1:
            rank = written(rank, "rank")
    return rank


def transition_errors(log: DataFrame, entity: str, order: str, stage: str, sequence: Sequence[str]) -> DataFrame:
    """Events whose stage is not the next one after the entity's previous stage."""
    from pyspark.sql import Window

    at = F.array_position(F.array(*[F.lit(s) for s in sequence]), F.col(stage))
    before = F.lag(at).over(Window.partitionBy(entity).orderBy(order))
    return log.withColumns({"stage_no": at, "previous_no": before}).filter((F.col("stage_no") == 0) | (F.col("stage_no") != F.coalesce("previous_no", F.lit(0)) + 1))


def to_json(rows: DataFrame) -> DataFrame:
    """Nodes or edges as one JSON document each (column json); nulls are kept as null."""
    return rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}).alias("json"))


def from_json(documents: DataFrame, schema: str) -> DataFrame:
    """Rows of ``to_json`` read back."""
    return documents.select(F.from_json("json", schema).alias("r")).select("r.*")
