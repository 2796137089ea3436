"""Queries: fusion, de-duplication, hierarchy, joins and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.numeric import bin_key
from tessera.operators import fusion, joins
from tessera.plans.registry import query
from tessera.plans.tables import OBSERVATIONS, observations, table


@query(
    f"""WITH {OBSERVATIONS} SELECT paper, treatment, round(avg(nitrogen), 4) AS nitrogen, round(avg(yield_ha), 4) AS yield_ha, arg_min(crop, (day, part, supp)) FILTER (WHERE crop IS NOT NULL) AS crop, count(*) AS replicates,
    round(avg(nitrogen), 4) IS NULL AS no_nitrogen, coalesce(avg(yield_ha) > 60000, false) AS high_yield FROM obs GROUP BY 1, 2"""
)
def fusion_with_quality_flags(spark, d):
    f = fusion.fuse_treatments(observations(spark, d), ["paper", "treatment"], ["nitrogen", "yield_ha"], ["crop"], ["day", "part", "supp"])
    return f.select("paper", "treatment", F.round("nitrogen", 4).alias("nitrogen"), F.round("yield_ha", 4).alias("yield_ha"), "crop", "replicates", F.col("nitrogen").isNull().alias("no_nitrogen"), F.coalesce(F.col("yield_ha") > 60000, F.lit(False)).alias("high_yield"))


WEIGHTS = {"click": 0.9, "view": 0.8, "purchase": 0.95}


@query(
    """WITH e AS (SELECT user_id, event_id, event_type, value, round(0.6 * coalesce(CASE event_type WHEN 'click' THEN 0.9 WHEN 'view' THEN 0.8 WHEN 'purchase' THEN 0.95 END, 0.5) + 0.4 * ((event_id % 10) / 10.0), 4)::DOUBLE AS conf FROM events WHERE event_id % 7 <> 0)
    SELECT user_id, arg_min(value, (-conf, event_id)) AS fused, arg_min(event_type, (-conf, event_id)) AS fused_by, count(*) AS candidates, count(DISTINCT value) > 1 AS conflict, round(avg(value), 6) AS mean_value,
    string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS readers, round(avg(conf), 4) AS mean_confidence FROM e GROUP BY 1"""
)
def evidence_fusion(spark, d):
    e = table(spark, d, "events").withColumn("value", F.when(F.col("event_id") % 7 != 0, F.col("value")))
    e = e.withColumn("conf", fusion.reader_confidence(joins.lookup(F.col("event_type"), WEIGHTS), (F.col("event_id") % 10) / 10.0))
    return fusion.fuse_evidence(e, ["user_id"], "value", "conf", "event_type", "event_id").withColumn("mean_value", F.round("mean_value", 6))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, nitrogen, yield_ha, crop FROM (SELECT *, row_number() OVER (PARTITION BY paper, treatment ORDER BY (nitrogen IS NOT NULL)::INT + (yield_ha IS NOT NULL)::INT + (crop IS NOT NULL)::INT DESC, day, part, supp, moisture) AS r FROM obs) WHERE r = 1")
def best_rows(spark, d):
    return fusion.best_rows(observations(spark, d), ["paper", "treatment"], ["day", "part", "supp", "moisture"], ["nitrogen", "yield_ha", "crop"]).select("paper", "treatment", "part", "supp", "nitrogen", "yield_ha", "crop")


@query(f"WITH {OBSERVATIONS}, v AS (SELECT paper, crop, count(*) AS n FROM obs WHERE crop IS NOT NULL GROUP BY 1, 2), m AS (SELECT paper, arg_min(crop, (-n, crop)) AS majority FROM v GROUP BY 1) SELECT obs.paper AS paper, treatment, part, crop, majority, crop <> majority AS rewritten FROM obs LEFT JOIN m USING (paper)")
def majority_crop(spark, d):
    return fusion.rewrite_minority(observations(spark, d), "paper", "crop").select("paper", "treatment", "part", "crop", "majority", "rewritten")


@query("WITH k AS (SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, CASE WHEN p_partkey % 4 = 0 THEN 'doi:' || p_size ELSE 'title:' || p_name END AS dedup_key, (p_size > 20)::INT * 2 + (p_retailprice > 1000)::INT AS c FROM part) SELECT dedup_key, arg_min(p_partkey, (-c, p_partkey)) AS p_partkey, count(*) AS members, list_sort(list_distinct(list(p_brand))) AS brands, max(p_retailprice) AS p_retailprice, arg_min(p_type, (-c, p_partkey)) FILTER (WHERE p_type IS NOT NULL) AS p_type FROM k GROUP BY 1")
def record_deduplication(spark, d):
    p = table(spark, d, "part").withColumn("brands", F.array("p_brand"))
    key = F.when(F.col("p_partkey") % 4 == 0, F.concat(F.lit("doi:"), F.col("p_size"))).otherwise(F.concat(F.lit("title:"), F.col("p_name")))
    complete = (F.col("p_size") > 20).cast("int") * 2 + (F.col("p_retailprice") > 1000).cast("int")
    return fusion.deduplicate_records(p, key, complete, "p_partkey", ["brands"], ["p_retailprice"], ["p_type"])


@query()
def near_titles(spark, d):
    """All pairs of titles alike at 0.95 or more."""
    docs = table(spark, d, "documents").withColumn("title", F.substring("text", 1, 80)).groupBy("title").agg(F.min("doc_id").alias("doc_id"))
    return fusion.all_similar_titles(docs, "doc_id", "title")


@query("SELECT o_custkey, o_orderkey, o_custkey || '_E' || dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS experiment_id FROM orders")
def experiment_ids(spark, d):
    return fusion.hierarchy_ids(table(spark, d, "orders"), "o_custkey", "o_orderdate").select("o_custkey", "o_orderkey", "experiment_id")


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS o_totalprice FROM orders GROUP BY 1")
def keep_last_by_key(spark, d):
    o = table(spark, d, "orders")
    last = fusion.keep_last(o, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_totalprice")
    return last.join(o.groupBy("o_custkey").agg(F.max("o_orderkey").alias("o_orderkey")), "o_custkey").select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    """WITH e AS (SELECT round_even(s_acctbal / 1000.0, 0)::BIGINT AS y, (s_nationkey)::BIGINT AS x, avg(s_acctbal) AS bal FROM supplier GROUP BY 1, 2)
    SELECT c_custkey, round(CASE WHEN c_custkey % 3 = 0 THEN c_acctbal ELSE bal END, 4) AS bal FROM customer LEFT JOIN e ON round_even(c_acctbal / 1000.0, 0)::BIGINT = y AND c_nationkey = x"""
)
def spatial_bin_join(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal", F.col("c_nationkey").alias("lon"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("bal"))
    s = table(spark, d, "supplier").select((F.col("s_acctbal") / 1000.0).alias("lat"), F.col("s_nationkey").alias("elon"), F.col("s_acctbal").alias("bal"))
    out = joins.spatial_bins(c.withColumn("lat", F.col("c_acctbal") / 1000.0), s, "lat", "lon", "lat", "elon", ["bal"])
    return out.select("c_custkey", F.round("bal", 4).alias("bal"))


@query("SELECT c_custkey, coalesce(n_name, 'unknown') AS country, coalesce(r_name, 'unknown') AS zone FROM customer LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 <> 0) ON c_nationkey = n_nationkey")
def dimension_defaults(spark, d):
    n, r = table(spark, d, "nation").filter("n_nationkey % 4 <> 0"), table(spark, d, "region")
    dim = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("country"), F.col("r_name").alias("zone"))
    return joins.dimension(table(spark, d, "customer"), dim, F.col("c_nationkey") == F.col("n_nationkey"), {"country": "unknown", "zone": "unknown"}).select("c_custkey", "country", "zone")


@query("SELECT p_partkey, CASE WHEN contains(lower(p_name), 'small') THEN 1 WHEN contains(lower(p_name), 'red') THEN 2 WHEN contains(lower(p_name), 'ring') THEN 3 ELSE 9 END AS texture, coalesce(CASE p_type WHEN 'ECONOMY' THEN 5.5 WHEN 'STANDARD' THEN 6.5 END, 7.0)::DOUBLE AS ph FROM part")
def first_substring_lookup(spark, d):
    return table(spark, d, "part").select("p_partkey", joins.first_substring(F.col("p_name"), [("small", 1), ("red", 2), ("ring", 3)], 9).alias("texture"), joins.lookup(F.col("p_type"), {"ECONOMY": 5.5, "STANDARD": 6.5}, 7.0).alias("ph"))


@query("WITH g AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) SELECT a.l_suppkey AS a, b.l_suppkey AS b, count(*) AS n FROM g a JOIN g b ON a.l_orderkey = b.l_orderkey AND a.l_suppkey < b.l_suppkey GROUP BY 1, 2")
def co_authors(spark, d):
    return joins.co_occurrence(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


@query(
    """WITH t AS (SELECT o_custkey AS k, 'p' AS f, 0.4 AS w, o_orderpriority || strftime(o_orderdate, '%Y%m%d') AS tok FROM orders UNION SELECT o_custkey, 's', 0.3, o_orderstatus || strftime(o_orderdate, '%Y%m%d') FROM orders)
    SELECT a.k AS a, b.k AS b, round(sum(a.w), 4)::DOUBLE AS score FROM t a JOIN t b ON a.f = b.f AND a.tok = b.tok AND a.k < b.k GROUP BY 1, 2"""
)
def experiment_similarity(spark, d):
    o, day = table(spark, d, "orders"), F.date_format("o_orderdate", "yyyyMMdd")
    g = o.groupBy("o_custkey").agg(F.collect_set(F.concat("o_orderpriority", day)).alias("p"), F.collect_set(F.concat("o_orderstatus", day)).alias("s"))
    return joins.weighted_pairs(g, "o_custkey", {"p": 0.4, "s": 0.3}).withColumn("score", F.rint(F.col("score") * 10_000) / 10_000)


@query(
    """WITH o AS (SELECT s_suppkey, s_acctbal, name, cost FROM supplier, (VALUES ('A', 0.5), ('B', 1.0), ('C', 1.5)) v(name, cost)),
    s AS (SELECT *, s_acctbal * cost - cost * cost * 4000 AS score FROM o) SELECT s_suppkey, name, round(score, 4)::DOUBLE AS score, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY s_suppkey ORDER BY score DESC, name, cost) AS rank FROM s) WHERE rank <= 2"""
)
def option_simulation(spark, d):
    choices = spark.createDataFrame([("A", 0.5), ("B", 1.0), ("C", 1.5)], "name string, cost double")
    score = F.col("s_acctbal") * F.col("cost") - F.col("cost") * F.col("cost") * 4000
    return joins.options(table(spark, d, "supplier"), choices, score, ["s_suppkey"], top=2).select("s_suppkey", "name", F.round("score", 4).alias("score"), "rank")


@query("SELECT b.item_id AS item_id, count(d.doc_id) AS mentions FROM benchmark b LEFT JOIN documents d ON contains(d.text, left(b.text, 60)) AND length(b.text) >= 60 GROUP BY 1")
def evidence_mentions(spark, d):
    b = table(spark, d, "benchmark").select("item_id", F.when(F.length("text") >= 60, F.substring("text", 1, 60)).alias("needle"))
    docs = table(spark, d, "documents").select("doc_id", "text")
    if b.limit(100_001).count() <= 100_000:  # a stated, bounded list of captions against all texts
        b = F.broadcast(b)
    hits = docs.join(b, docs.text.contains(b.needle)).groupBy("item_id").agg(F.count("*").alias("m"))
    return b.select("item_id").join(hits, "item_id", "left").select("item_id", F.coalesce("m", F.lit(0)).cast("bigint").alias("mentions"))


@query("SELECT url_host AS host, count(*) AS n, count(DISTINCT page_id) AS papers FROM (SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS url_host FROM pages) GROUP BY 1 HAVING count(DISTINCT page_id) > 1")
def duplicate_urls(spark, d):
    p = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))
    return p.groupBy("host").agg(F.count("*").alias("n"), F.count_distinct("page_id").alias("papers")).filter("papers > 1")


@query("SELECT count(*) AS n FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 2 = 0 INTERSECT SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_orderkey % 2 = 1)")
def train_test_overlap(spark, d):
    li = table(spark, d, "lineitem")
    even, odd = (li.filter(F.col("l_orderkey") % 2 == k).select("l_partkey", "l_suppkey") for k in (0, 1))
    return even.intersect(odd).agg(F.count("*").alias("n"))


@query("SELECT bin, count(*) AS n FROM (SELECT round_even(l_quantity / 5.0, 0)::BIGINT AS bin FROM lineitem) GROUP BY 1")
def half_even_bins(spark, d):
    return table(spark, d, "lineitem").groupBy(bin_key(F.col("l_quantity"), 5.0).alias("bin")).agg(F.count("*").alias("n"))
