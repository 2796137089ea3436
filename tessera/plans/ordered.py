"""Queries: windows, top-k, graphs, lineage, incremental operators, reshapes, streams, models."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph, incremental, ml, windows
from tessera.plans.registry import query
from tessera.plans.tables import table
from tessera.sources import files
from tessera.streaming import events as streams


@query("SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS moving_avg, round(sum(greatest(value - 35, 0)) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 4) AS running_excess FROM events")
def moving_and_running(spark, d):
    e = windows.moving_average(table(spark, d, "events"), "value", ["user_id"], ["ts", "event_id"])
    e = windows.running_excess(e, "value", 35.0, ["user_id"], ["ts", "event_id"])
    return e.select("event_id", F.round("moving_avg", 6).alias("moving_avg"), F.round("running_excess", 4).alias("running_excess"))


@query("SELECT p_partkey, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) + (count(*) OVER (PARTITION BY p_brand, p_size) - 1) / 2.0 AS avg_rank FROM part")
def average_ranks(spark, d):
    return windows.average_rank(table(spark, d, "part"), "p_size", ["p_brand"]).select("p_partkey", "avg_rank")


@query("SELECT o_custkey, o_orderkey, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders) WHERE rank <= 3")
def top_per_group(spark, d):
    return windows.top_per_group(table(spark, d, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 3).select("o_custkey", "o_orderkey", "rank")


@query("SELECT event_id, round(abs(value - avg(value) OVER w) / nullif(stddev_samp(value) OVER w, 0), 6) AS zscore, round(value - avg(value) OVER (), 6) AS anomaly FROM events WINDOW w AS (PARTITION BY event_type)")
def zscore_anomalies(spark, d):
    e = windows.anomaly(windows.zscores(table(spark, d, "events"), "value", ["event_type"]), "value")
    return e.select("event_id", F.round("zscore", 6).alias("zscore"), F.round("anomaly", 6).alias("anomaly"))


@query("WITH q AS (SELECT max(value) AS m, quantile_cont(value, 0.33) AS lo, quantile_cont(value, 0.9) AS hi FROM events) SELECT event_id, round(value / m, 8) AS share, value < lo AS is_low, value > hi AS is_high FROM events, q")
def share_of_max(spark, d):
    return windows.share_of_max(table(spark, d, "events"), "value").select("event_id", F.round("share", 8).alias("share"), "is_low", "is_high")


@query("SELECT o_custkey, o_orderkey, (row_number() OVER w)::INT AS version, lead(o_orderkey) OVER w AS superseded_by, CASE WHEN lead(o_orderkey) OVER w IS NULL THEN 'active' ELSE 'superseded' END AS status, coalesce(lag(o_orderstatus) OVER w <> o_orderstatus, true) AS changed FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def version_registry(spark, d):
    return windows.versions(table(spark, d, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderstatus").select("o_custkey", "o_orderkey", "version", "superseded_by", "status", "changed")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1")
def latest_version(spark, d):
    return windows.latest(table(spark, d, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "value")


@query("SELECT event_id, (ntile(6) OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1)::INT AS block FROM events")
def time_folds(spark, d):
    return windows.time_folds(table(spark, d, "events"), ["ts", "event_id"], ["event_type"], 5).select("event_id", "block")


@query(
    """WITH e AS (SELECT user_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + 3600 AS b FROM events), f AS (SELECT *, max(b) OVER (PARTITION BY user_id ORDER BY a, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM e),
    g AS (SELECT *, sum((m IS NULL OR a > m)::INT) OVER (PARTITION BY user_id ORDER BY a, b ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT user_id, min(a) AS a, max(b) AS b, count(*) AS members FROM g GROUP BY user_id, k"""
)
def merged_intervals(spark, d):
    e = table(spark, d, "events").select("user_id", F.unix_seconds("ts").alias("a"))
    return windows.islands(e.withColumn("b", F.col("a") + 3600), ["user_id"], "a", "b")


# --- reshapes and sources -----------------------------------------------------------------
@query("SELECT l_orderkey, l_linenumber, l_partkey, unnest(['l_quantity', 'l_tax']) AS variable, unnest([l_quantity, l_tax]) AS value FROM lineitem")
def wide_to_long(spark, d):
    return files.melt(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], ["l_quantity", "l_tax"])


@query("SELECT s_suppkey AS key, s_name AS name, NULL::DOUBLE AS price, NULL::INT AS size, s_acctbal FROM supplier UNION ALL SELECT p_partkey, p_name, p_retailprice, p_size, NULL FROM part")
def union_by_name(spark, d):
    a = files.rename(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_acctbal"), {"s_suppkey": "key", "s_name": "name"})
    b = files.rename(table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice", "p_size"), {"p_partkey": "key", "p_name": "name", "p_retailprice": "price", "p_size": "size"})
    return files.complete_schema(a.unionByName(b, allowMissingColumns=True), {"key": "bigint", "name": "string", "price": "double", "size": "int", "s_acctbal": "double"})


@query("SELECT user_id, arg_min(event_type, CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 9 END || event_type) AS best FROM events GROUP BY 1")
def format_priority(spark, d):
    return incremental.priority(table(spark, d, "events").select("user_id", F.col("event_type").alias("best")), ["user_id"], "best", ["purchase", "click", "view"])


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_rows(spark, d):
    return table(spark, d, "lineitem").select("l_partkey", "l_suppkey").distinct()


# --- incremental --------------------------------------------------------------------------
_OLD = "o AS (SELECT o_orderkey AS k, o_orderstatus AS s, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS p FROM orders WHERE o_orderkey % 5 <> 0)"
_NEW = "n AS (SELECT o_orderkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'X' END AS s, o_totalprice AS p FROM orders WHERE o_orderkey % 4 <> 1)"


def _sides(spark, d):
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    old = o.filter(k % 5 != 0).select(k.alias("k"), F.col("o_orderstatus").alias("s"), F.when(k % 3 == 0, F.col("o_totalprice")).alias("p"))
    return old, o.filter(k % 4 != 1).select(k.alias("k"), F.when(k % 2 == 0, "X").alias("s"), F.col("o_totalprice").alias("p"))


@query(f"WITH {_OLD}, {_NEW} SELECT coalesce(n.k, o.k) AS k, coalesce(n.s, o.s) AS s, coalesce(n.p, o.p) AS p FROM o FULL JOIN n ON o.k = n.k")
def upsert(spark, d):
    return incremental.upsert(*_sides(spark, d), ["k"])


@query(f"WITH {_OLD}, {_NEW} SELECT coalesce(n.k, o.k) AS k, CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN coalesce(o.s, '') <> coalesce(n.s, '') THEN 'changed' ELSE 'unchanged' END AS change FROM o FULL JOIN n ON o.k = n.k")
def change_detection(spark, d):
    return incremental.changes(*_sides(spark, d), "k", ["s"])


@query(f"WITH {_OLD}, {_NEW} SELECT n.k AS k, n.s AS s, n.p AS p FROM n WHERE n.k NOT IN (SELECT k FROM o)")
def unseen_rows(spark, d):
    old, new = _sides(spark, d)
    return incremental.unseen(new, old, ["k"])


@query("SELECT event_type, n, n >= 20 AND (previous IS NULL OR n - previous > 0.15 * previous) AS due FROM (SELECT event_type, count(*) AS n, nullif(count(*) FILTER (WHERE event_id % 10 < 8), 0) AS previous FROM events GROUP BY 1)")
def retrain_trigger(spark, d):
    g = table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("event_id") % 10 < 8).alias("p"))
    return g.select("event_type", "n", incremental.retrain_due(F.col("n"), F.nullif("p", F.lit(0))).alias("due"))


# --- events -------------------------------------------------------------------------------
@query("SELECT event_type, time_bucket(INTERVAL 6 HOURS, ts)::TIMESTAMP AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def tumbling_windows(spark, d):
    w = streams.windowed(table(spark, d, "events"), "ts", ["event_type"], "value", "6 hours")
    return w.select("event_type", F.col("start").cast("timestamp_ntz").alias("start"), "n", F.round("total", 4).alias("total"))


@query("WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 2 HOURS THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k")
def session_windows(spark, d):
    return streams.sessions(table(spark, d, "events"), "ts", ["user_id"], "2 hours").select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT event_type, count(*) AS n, round(avg((least(1, greatest(0, value / 100)) > 0.8)::INT), 6) AS share, round(quantile_cont(value, 0.5), 4) AS median FROM events GROUP BY 1 HAVING count(*) >= 10")
def drift_detection(spark, d):
    from tessera.functions.numeric import clip

    return streams.drift(table(spark, d, "events"), ["event_type"], "value", clip(F.col("value") / 100, 0, 1)).select("event_type", "n", F.round("share", 6).alias("share"), F.round("median", 4).alias("median"))


# --- graphs -------------------------------------------------------------------------------
def _graph(spark, d):
    c = table(spark, d, "customer").join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return graph.property_graph(c, [("customer", "c_custkey"), ("nation", "n_name"), ("region", "r_name")], [("c_custkey", "n_name", "lives_in"), ("n_name", "r_name", "part_of")])


_G = "w AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), e AS (SELECT DISTINCT 'customer:' || c_custkey AS src, 'nation:' || n_name AS dst, 'lives_in' AS type FROM w UNION ALL SELECT DISTINCT 'nation:' || n_name, 'region:' || r_name, 'part_of' FROM w), v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)"


@query(f"WITH {_G} SELECT src, dst, type FROM e")
def property_graph_edges(spark, d):
    return _graph(spark, d)[1]


@query(f"WITH {_G} SELECT src, dst, type FROM e WHERE type = 'part_of'")
def edge_validation(spark, d):
    n, e = _graph(spark, d)
    return graph.invalid_edges(n, e, [("customer", "lives_in", "nation")])


@query(f"WITH {_G}, i AS (SELECT dst AS id, count(*) AS n FROM e GROUP BY 1), o AS (SELECT src AS id, count(*) AS n FROM e GROUP BY 1) SELECT v.id AS id, coalesce(i.n, 0) AS in_degree, coalesce(o.n, 0) AS out_degree, round((coalesce(i.n, 0) + coalesce(o.n, 0)) / ((SELECT count(*) FROM v) - 1.0), 8) AS centrality FROM v LEFT JOIN i USING (id) LEFT JOIN o USING (id)")
def degree_centrality(spark, d):
    return graph.degrees(*_graph(spark, d)).select("id", "in_degree", "out_degree", F.round("centrality", 8).alias("centrality"))


@query("WITH w AS (SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey), m AS (SELECT 'customer:' || c_custkey AS id, r_name FROM w UNION SELECT 'nation:' || n_name, r_name FROM w UNION SELECT 'region:' || r_name, r_name FROM w) SELECT id, min(id) OVER (PARTITION BY r_name) AS component FROM m")
def weak_components(spark, d):
    n, e = _graph(spark, d)
    return graph.components(n, e)


_CHAIN = "e AS (SELECT DISTINCT o_custkey AS src, (o_orderkey * 7 + o_custkey) % 200 AS dst FROM orders)"


def _chain(spark, d):
    return table(spark, d, "orders").select(F.col("o_custkey").alias("src"), ((F.col("o_orderkey") * 7 + F.col("o_custkey")) % 200).alias("dst")).distinct()


@query(f"WITH RECURSIVE {_CHAIN}, r AS (SELECT 0::BIGINT AS id, 0 AS hops UNION SELECT e.dst, hops + 1 FROM r JOIN e ON r.id = e.src WHERE hops < 4) SELECT id, min(hops)::INT AS hops FROM r GROUP BY 1")
def shortest_paths(spark, d):
    return graph.distances(_chain(spark, d), 0, most=4)


@query(f"WITH RECURSIVE {_CHAIN}, r AS (SELECT 5::BIGINT AS id, 0 AS hops UNION SELECT e.src, hops + 1 FROM r JOIN e ON r.id = e.dst WHERE hops < 2) SELECT id, min(hops)::INT AS hops FROM r GROUP BY 1")
def upstream_lineage(spark, d):
    return graph.distances(_chain(spark, d), 5, most=2, reverse=True)


@query()
def shortest_paths_whole(spark, d):
    """shortest_paths without the bound that its SQL sets."""
    return graph.distances(_chain(spark, d), 0)


@query()
def upstream_lineage_whole(spark, d):
    """upstream_lineage without the bound that its SQL sets."""
    return graph.distances(_chain(spark, d), 5, reverse=True)


@query()
def page_rank(spark, d):
    n, e = _graph(spark, d)
    return graph.pagerank(n, e, rounds=10).withColumn("rank", F.round("rank", 8))


@query(f"WITH {_G}, k AS (SELECT (SELECT count(*) FROM v) AS n, (SELECT count(*) FROM e) AS m, (SELECT count(DISTINCT dst) FROM e WHERE type = 'part_of') AS c) SELECT n AS n_nodes, 0 AS isolates, m AS n_edges, c AS components, m / (n * (n - 1)) AS density FROM k")
def graph_summary(spark, d):
    return graph.summary(*_graph(spark, d))


@query("WITH s AS (SELECT event_id, user_id, ts, list_position(['signup', 'view', 'click', 'purchase'], event_type) AS no FROM events), l AS (SELECT *, lag(coalesce(no, 0)) OVER (PARTITION BY user_id ORDER BY ts) AS prev FROM s) SELECT event_id FROM l WHERE coalesce(no, 0) = 0 OR coalesce(no, 0) <> coalesce(prev, 0) + 1")
def transition_guard(spark, d):
    return graph.transition_errors(table(spark, d, "events"), "user_id", "ts", "event_type", ["signup", "view", "click", "purchase"]).select("event_id")


@query("SELECT l.l_orderkey AS paper, count(*) AS refs, count(p.p_partkey) AS resolved FROM lineitem l LEFT JOIN (SELECT p_partkey FROM part WHERE p_partkey % 3 <> 0) p ON l.l_partkey = p.p_partkey GROUP BY 1")
def citation_resolution(spark, d):
    refs = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper"), F.col("l_partkey").alias("ref"))
    known = table(spark, d, "part").filter("p_partkey % 3 <> 0").select(F.col("p_partkey").alias("ref"), F.lit(1).alias("hit"))
    return refs.join(known, "ref", "left").groupBy("paper").agg(F.count("*").alias("refs"), F.count("hit").alias("resolved"))


# --- models -------------------------------------------------------------------------------
@query("SELECT l_orderkey, (('0x' || left(md5(l_orderkey::VARCHAR), 8))::BIGINT % 5)::INT AS fold, count(*) AS n FROM lineitem GROUP BY 1, 2")
def group_folds(spark, d):
    return table(spark, d, "lineitem").groupBy("l_orderkey", ml.fold(F.col("l_orderkey")).alias("fold")).agg(F.count("*").alias("n"))


@query()
def cross_validated_metrics(spark, d):
    """Out-of-fold metrics of a ridge model of price on quantity, discount and tax, folds by order."""
    from tessera.operators.profile import regression_metrics

    out = ml.cross_validated(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", F.col("l_orderkey"), "ridge", 3)
    return regression_metrics(out, "label", "prediction", ["_fold"]).select("_fold", "n", F.round("r2", 3).alias("r2"))


@query("SELECT o_orderkey, year(o_orderdate) AS y FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 25")
def recent_papers(spark, d):
    """A report of the 25 latest records, as the feature itself is a limit."""
    return table(spark, d, "orders").orderBy(F.col("o_orderdate").desc(), "o_orderkey").limit(25).select("o_orderkey", F.year("o_orderdate").alias("y"))
