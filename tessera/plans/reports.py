"""Queries: gates, provenance, evidence, roll-ups, scores, ladders, registries and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import text as X
from tessera.operators import features, graph, project
from tessera.plans.registry import query
from tessera.plans.tables import OBSERVATIONS, observations, table


def _round(df, digits, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE CASE o_orderstatus WHEN 'F' THEN 'ACCEPTED' WHEN 'O' THEN 'REJECTED' END = 'ACCEPTED'")
def validation_gate(spark, d):
    o = table(spark, d, "orders").withColumn("_validation_status", F.when(F.col("o_orderstatus") == "F", "ACCEPTED").when(F.col("o_orderstatus") == "O", "REJECTED"))
    return project.gate(o).select("o_orderkey", "o_totalprice")


@query("SELECT doc_id, TRY_CAST(regexp_extract(text, '[0-9]+', 0) AS DOUBLE) AS number FROM documents")
def numeric_coercion(spark, d):
    return table(spark, d, "documents").select("doc_id", N.to_number(F.regexp_extract("text", "[0-9]+", 0)).alias("number"))


@query("SELECT event_id, CASE WHEN value BETWEEN 5 AND 100 THEN value END AS value FROM events")
def blanked_predictions(spark, d):
    return table(spark, d, "events").select("event_id", project.blank_outside(F.col("value"), 5, 100).alias("value"))


@query("SELECT doc_id, quality, toxic FROM labels WHERE quality = 1 AND coalesce(nullif(toxic, 0), 0) >= 0.5")
def verified_records(spark, d):
    df = table(spark, d, "labels").withColumns({"_o": F.col("quality") == 1, "_q": F.nullif(F.col("toxic"), F.lit(0)).cast("double")})
    return project.verified(df, "_o", "_q", 0.5).select("doc_id", "quality", "toxic")


@query("SELECT event_id, 'events' AS source, 'unknown' AS license, CASE event_type WHEN 'click' THEN 0.9 WHEN 'view' THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence FROM events")
def provenance_tags(spark, d):
    e = table(spark, d, "events").select("event_id", F.col("event_type").alias("method"), F.lit("events").alias("source"))
    return project.tag(e, {"source": "x", "license": "unknown"}, {"click": 0.9, "view": 0.7}).select("event_id", "source", "license", "confidence")


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 <> 0 THEN CASE WHEN p_size % 3 > 1 OR (p_size % 3 > 0 AND length(p_name) > 20) THEN 'high' WHEN p_size % 3 > 0 OR length(p_name) > 10 THEN 'medium' ELSE 'low' END END AS confidence FROM part")
def evidence_confidence(spark, d):
    v = F.when(F.col("p_partkey") % 6 != 0, F.col("p_name")).otherwise(" ")
    return table(spark, d, "part").select("p_partkey", project.evidence_confidence(v, F.col("p_name"), F.col("p_size") % 3).alias("confidence"))


@query("SELECT p_partkey, p_size::DOUBLE AS number, CASE WHEN p_size < 5 OR p_size > 40 THEN 'low' ELSE 'high' END AS confidence, CASE WHEN p_size < 5 OR p_size > 40 THEN 'out of range' END AS note FROM part")
def extraction_range(spark, d):
    v = F.concat(F.lit("about "), F.col("p_size"), F.lit(" cm (n=3)"))
    return table(spark, d, "part").select("p_partkey", project.extraction_range(v, F.lit(5.0), F.lit(40.0)).alias("x")).select("p_partkey", "x.*")


@query("SELECT p_partkey, p_partkey % 5 = 4 AS treatment FROM part")
def treatment_labels(spark, d):
    cells = F.array(F.lit("Mean"), F.lit("2019-20"), F.lit("12.5"), F.lit("LSD (0.05)"), F.concat(F.lit("T"), F.col("p_size"), F.lit(" urea")))
    return table(spark, d, "part").select("p_partkey", project.is_treatment_label(F.element_at(cells, (F.col("p_partkey") % 5 + 1).cast("int"))).alias("treatment"))


@query("SELECT p_partkey, unnest([0, 0, 0, 0, 1, 1, 1, 1]) AS table_no, unnest([0, 0, 1, 1, 0, 0, 1, 1]) AS row_no, unnest([0, 1, 0, 1, 0, 1, 0, 1]) AS col_no, unnest(['a', 'b', '1', p_size::VARCHAR, 'x', 'y', 'p q', '3']) AS cell FROM part")
def text_tables(spark, d):
    t = F.concat(F.lit("Title of it\na\tb\n1  "), F.col("p_size"), F.lit("\n\nx | y\np q|3\nend"))
    return project.lines_to_cells(table(spark, d, "part").withColumn("t", t), "p_partkey", "t")


@query(f"WITH {OBSERVATIONS} SELECT soil, round(avg(nitrogen), 4) AS nitrogen, round(avg(moisture), 4) AS moisture, count(DISTINCT treatment) AS treatments FROM obs GROUP BY 1")
def source_means(spark, d):
    g = observations(spark, d).groupBy("soil").agg(F.avg("nitrogen").alias("nitrogen"), F.avg("moisture").alias("moisture"), F.count_distinct("treatment").alias("treatments"))
    return _round(g, 4, "nitrogen", "moisture")


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS papers FROM orders GROUP BY 1")
def papers_per_year(spark, d):
    return table(spark, d, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("papers"))


@query("SELECT p_brand, count(*) AS n, rank() OVER (ORDER BY count(*) DESC) AS place FROM part GROUP BY 1")
def value_counts(spark, d):
    g = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return g.withColumn("place", F.rank().over(Window.orderBy(F.col("n").desc())))  # one row per distinct value


@query("SELECT p_brand, arg_min(p_partkey, p_partkey) AS p_partkey, arg_min(p_name, p_partkey) AS p_name FROM part GROUP BY 1")
def first_row_per_group(spark, d):
    return table(spark, d, "part").groupBy("p_brand").agg(F.min("p_partkey").alias("p_partkey"), F.min_by("p_name", "p_partkey").alias("p_name"))


@query("WITH s AS (SELECT event_type AS feature, user_id % 4 AS model, avg(value) AS imp FROM events GROUP BY 1, 2), g AS (SELECT feature, avg(imp) AS mean, stddev_samp(imp) AS sd, max(imp) AS most, count(*) AS models FROM s GROUP BY 1) SELECT feature, round(mean, 4) AS mean, round(sd, 4) AS sd, round(most, 4) AS most, models, row_number() OVER (ORDER BY mean DESC, feature) AS place, CASE WHEN mean >= 52 THEN 'high' WHEN mean >= 49 THEN 'medium' ELSE 'low' END AS tier FROM g")
def importance_rollup(spark, d):
    s = table(spark, d, "events").groupBy(F.col("event_type").alias("feature"), (F.col("user_id") % 4).alias("model")).agg(F.avg("value").alias("imp"))
    g = s.groupBy("feature").agg(F.avg("imp").alias("mean"), F.stddev_samp("imp").alias("sd"), F.max("imp").alias("most"), F.count("*").alias("models"))
    g = g.withColumns({"place": F.row_number().over(Window.orderBy(F.col("mean").desc(), "feature")), "tier": F.when(F.col("mean") >= 52, "high").when(F.col("mean") >= 49, "medium").otherwise("low")})
    return _round(g, 4, "mean", "sd", "most")


@query(f"WITH {OBSERVATIONS}, g AS (SELECT avg((nitrogen IS NOT NULL)::INT) AS a, avg((yield_ha IS NOT NULL)::INT) AS b, avg((crop IS NOT NULL)::INT) AS c, (count(*) - count(DISTINCT (paper, treatment, part, supp, nitrogen, moisture))) / count(*) AS dup FROM obs) SELECT round(20 * (a + b + c) / 3, 4) AS schema_score, round(15 * (1 - greatest(1 - a, 1 - b, 1 - c)), 4) AS missing_score, round(10 * (1 - dup), 4) AS duplicate_score, round(20 * (a + b + c) / 3 + 15 * (1 - greatest(1 - a, 1 - b, 1 - c)) + 10 * (1 - dup), 4) AS total FROM g")
def dataset_quality(spark, d):
    there = lambda c: F.avg(F.col(c).isNotNull().cast("int"))
    o = observations(spark, d)
    keys = ["paper", "treatment", "part", "supp", "nitrogen", "moisture"]
    row = o.groupBy(*keys, "yield_ha", "crop").agg(F.count("*").alias("n"))
    part = o.agg(there("nitrogen").alias("a"), there("yield_ha").alias("b"), there("crop").alias("c"), F.count("*").alias("n"))
    kinds = F.broadcast(row.select(*keys).distinct().agg(F.count("*").alias("k")))
    g = part.crossJoin(kinds)
    a, b, c, dup = F.col("a"), F.col("b"), F.col("c"), (F.col("n") - F.col("k")) / F.col("n")
    s, m, u = 20 * (a + b + c) / 3, 15 * (1 - F.greatest(1 - a, 1 - b, 1 - c)), 10 * (1 - dup)
    return g.select(F.round(s, 4).alias("schema_score"), F.round(m, 4).alias("missing_score"), F.round(u, 4).alias("duplicate_score"), F.round(s + m + u, 4).alias("total"))


@query("SELECT l_returnflag, round(avg(l_discount), 6) AS mean_confidence, count(*) FILTER (WHERE l_discount >= 0.05) AS covered, round(avg((l_quantity > 25)::INT) FILTER (WHERE l_discount >= 0.07), 6) AS agreement FROM lineitem GROUP BY 1")
def recommendation_kpis(spark, d):
    g = table(spark, d, "lineitem").groupBy("l_returnflag").agg(F.avg("l_discount").alias("mean_confidence"), F.count_if(F.col("l_discount") >= 0.05).alias("covered"), F.avg(F.when(F.col("l_discount") >= 0.07, (F.col("l_quantity") > 25).cast("int"))).alias("agreement"))
    return _round(g, 6, "mean_confidence", "agreement")


@query(f"WITH {OBSERVATIONS}, r AS (SELECT ((nitrogen IS NOT NULL)::INT + (yield_ha IS NOT NULL)::INT + (crop IS NOT NULL)::INT) / 3 AS filled FROM obs) SELECT round(avg(filled), 6) AS population, round(avg((filled >= 0.8)::INT), 6) AS usable, round(0.8 * avg(filled) + 0.2 * avg((filled >= 0.8)::INT), 6) AS score FROM r")
def reckoner_population(spark, d):
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("nitrogen", "yield_ha", "crop")), F.lit(0)) / 3
    r = observations(spark, d).select(filled.alias("f"), (filled >= 0.8).cast("int").alias("u")).agg(F.avg("f").alias("population"), F.avg("u").alias("usable"))
    return _round(r.withColumn("score", 0.8 * F.col("population") + 0.2 * F.col("usable")), 6, "population", "usable", "score")


@query("SELECT user_id, max(value) AS best, arg_max(event_id, (value, -event_id)) AS best_run, round(max(value) - arg_min(value, (ts, event_id)), 6) AS improvement, round(avg(value), 6) AS mean_health FROM events GROUP BY 1")
def best_runs(spark, d):
    g = table(spark, d, "events").groupBy("user_id").agg(F.max("value").alias("best"), F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("best_run"), (F.max("value") - F.min_by("value", F.struct("ts", "event_id"))).alias("improvement"), F.avg("value").alias("mean_health"))
    return _round(g, 6, "improvement", "mean_health")


@query("SELECT event_type AS agent, count(*) AS runs, round(sum(value), 4) AS total, round(avg(value), 4) AS mean, max(value) AS slowest, round(sum(value) / (SELECT sum(value) FROM events), 6) AS share FROM events GROUP BY 1")
def timing_rollup(spark, d):
    e = table(spark, d, "events")
    g = e.groupBy(F.col("event_type").alias("agent")).agg(F.count("*").alias("runs"), F.sum("value").alias("total"), F.avg("value").alias("mean"), F.max("value").alias("slowest"))
    g = g.crossJoin(F.broadcast(e.agg(F.sum("value").alias("all")))).withColumn("share", F.col("total") / F.col("all")).drop("all")
    return _round(_round(g, 4, "total", "mean"), 6, "share")


@query("SELECT o_orderpriority AS connector, count(*) AS runs, count(*) FILTER (WHERE o_orderstatus = 'F') AS succeeded, round(sum(o_totalprice), 2) AS volume FROM orders GROUP BY 1")
def connector_summary(spark, d):
    return table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("connector")).agg(F.count("*").alias("runs"), F.count_if(F.col("o_orderstatus") == "F").alias("succeeded"), F.round(F.sum("o_totalprice"), 2).alias("volume"))




@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, CASE WHEN nitrogen < 10 THEN 'Urea' WHEN moisture < 2 THEN 'DAP' WHEN carbon < 0.02 THEN 'MOP' WHEN nitrogen > 45 THEN 'reduce N' ELSE 'balanced' END AS advice, CASE WHEN yield_ha > 60000 THEN 7 WHEN yield_ha > 30000 THEN 10 ELSE 14 END AS days FROM obs")
def legacy_ladder(spark, d):
    n, y = F.col("nitrogen"), F.col("yield_ha")
    advice = F.when(n < 10, "Urea").when(F.col("moisture") < 2, "DAP").when(F.col("carbon") < 0.02, "MOP").when(n > 45, "reduce N").otherwise("balanced")
    return observations(spark, d).select("paper", "treatment", "part", "supp", advice.alias("advice"), F.when(y > 60000, 7).when(y > 30000, 10).otherwise(14).alias("days"))


@query("SELECT p_partkey, ((p_partkey % 2 = 0)::INT * 2 + (length(p_name) > 9)::INT * 2 + (p_size > 10)::INT + (p_retailprice > 1000)::INT * 2)::INT AS completeness, round(least(1, (p_partkey % 2 = 0)::INT * 0.15 + (length(p_name) > 9)::INT * 0.15 + (p_size > 10)::INT * 0.10 + (p_retailprice > 1000)::INT * 0.15), 4)::DOUBLE AS quality FROM part")
def literature_scores(spark, d):
    tests = [(F.col("p_partkey") % 2 == 0, 2, 0.15), (F.length("p_name") > 9, 2, 0.15), (F.col("p_size") > 10, 1, 0.10), (F.col("p_retailprice") > 1000, 2, 0.15)]
    points = sum((t.cast("int") * n for t, n, _ in tests), F.lit(0))
    score = sum((t.cast("int") * w for t, _, w in tests), F.lit(0.0))
    return table(spark, d, "part").select("p_partkey", points.alias("completeness"), F.round(F.least(F.lit(1.0), score), 4).alias("quality"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, greatest(l_quantity - 10, 0) * 30 AS gdd10, greatest(l_quantity - 5, 0) * 30 AS gdd5, round(exp(-0.5 * ((l_quantity - 25) / 6) ** 2), 6) AS suitability, round(greatest(0, 500 - l_extendedprice / 100) / 500, 6) AS deficit FROM lineitem")
def climate_indices(spark, d):
    q, rain = F.col("l_quantity"), F.col("l_extendedprice") / 100
    gdd = lambda base: F.greatest(q - base, F.lit(0.0)) * 30
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", gdd(10).alias("gdd10"), gdd(5).alias("gdd5"), F.round(features.bell(q, 25, 6), 6).alias("suitability"), F.round(F.greatest(F.lit(0.0), 500 - rain) / 500, 6).alias("deficit"))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, round(coalesce(nitrogen, 0) * 0.6 + moisture * 0.3 + carbon * 0.1, 6) AS staged, yield_ha / nullif(nitrogen, 0) AS efficiency, round((coalesce(CASE WHEN nitrogen IS NOT NULL THEN least(1, nitrogen / 50) END, 0) + least(1, moisture / 10) + least(1, carbon / 0.08)) / ((nitrogen IS NOT NULL)::INT + 2), 6) AS fertility FROM obs")
def crop_environment(spark, d):
    n, m, c = F.col("nitrogen"), F.col("moisture"), F.col("carbon")
    fert = N.row_mean(N.clip(n / 50, -1e9, 1), N.clip(m / 10, -1e9, 1), N.clip(c / 0.08, -1e9, 1))
    return observations(spark, d).select("paper", "treatment", "part", "supp", F.round(F.coalesce(n, F.lit(0.0)) * 0.6 + m * 0.3 + c * 0.1, 6).alias("staged"), N.ratio(F.col("yield_ha"), n).alias("efficiency"), F.round(fert, 6).alias("fertility"))


@query(f"WITH {OBSERVATIONS} SELECT count(*) FILTER (WHERE moisture < carbon * 100) AS inverted, count(*) FILTER (WHERE abs(nitrogen - (moisture + carbon * 100) / 2) > 5) AS off_centre, count(*) FILTER (WHERE abs(yield_ha / nitrogen - 1500) > 150) AS ratio_off FROM obs")
def consistency_counts(spark, d):
    n, m, c = F.col("nitrogen"), F.col("moisture"), F.col("carbon") * 100
    return observations(spark, d).agg(F.count_if(m < c).alias("inverted"), F.count_if(F.abs(n - (m + c) / 2) > 5).alias("off_centre"), F.count_if(F.abs(N.ratio(F.col("yield_ha"), n) - 1500) > 150).alias("ratio_off"))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, CASE WHEN yield_ha > 50000 THEN yield_ha / 1000 WHEN yield_ha < 1000 THEN yield_ha * 1000 ELSE yield_ha END AS yield_ha FROM obs")
def plausibility_rescale(spark, d):
    y = F.col("yield_ha")
    return observations(spark, d).select("paper", "treatment", "part", "supp", F.when(y > 50000, y / 1000).when(y < 1000, y * 1000).otherwise(y).alias("yield_ha"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round(1 - (l_discount + l_tax) / 2, 6) AS uncertainty, list_filter([CASE WHEN l_discount = 0 THEN 'discount' END, CASE WHEN l_tax = 0 THEN 'tax' END], lambda x: x IS NOT NULL) AS lacking FROM lineitem")
def explanations(spark, d):
    lack = F.array_compact(F.array(F.when(F.col("l_discount") == 0, "discount"), F.when(F.col("l_tax") == 0, "tax")))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.round(1 - (F.col("l_discount") + F.col("l_tax")) / 2, 6).alias("uncertainty"), lack.alias("lacking"))


@query("SELECT p_brand, count(*) AS terms FROM (SELECT p_brand, lower(p_name) AS term FROM part GROUP BY 1, 2 HAVING count(*) > 1) GROUP BY 1")
def term_collisions(spark, d):
    t = table(spark, d, "part").groupBy("p_brand", F.lower("p_name").alias("term")).agg(F.count("*").alias("n")).filter("n > 1")
    return t.groupBy("p_brand").agg(F.count("*").alias("terms"))


@query("WITH t AS (SELECT p_partkey, trim(regexp_replace(lower(p_name), '[^a-z0-9]+', ' ', 'g')) AS t, CASE WHEN p_partkey % 3 = 0 THEN p_size END AS doi FROM part), a AS (SELECT t, min(p_partkey) AS first FROM t GROUP BY 1), b AS (SELECT doi, min(p_partkey) AS first FROM t WHERE doi IS NOT NULL GROUP BY 1) SELECT p_partkey, least(a.first, b.first) AS duplicate_of FROM t JOIN a USING (t) LEFT JOIN b ON t.doi = b.doi WHERE least(a.first, b.first) < p_partkey")
def ingestion_duplicates(spark, d):
    t = table(spark, d, "part").select("p_partkey", X.normalize_title(F.col("p_name")).alias("t"), F.when(F.col("p_partkey") % 3 == 0, F.col("p_size")).alias("doi"))
    a = t.groupBy("t").agg(F.min("p_partkey").alias("first_title"))
    b = t.filter("doi is not null").groupBy("doi").agg(F.min("p_partkey").alias("first_doi"))
    j = t.join(a, "t").join(b, "doi", "left").withColumn("duplicate_of", F.least("first_title", "first_doi"))
    return j.filter("duplicate_of < p_partkey").select("p_partkey", "duplicate_of")


@query("SELECT s_suppkey, s_acctbal AS score, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END AS honest, (row_number() OVER (ORDER BY (s_suppkey % 3 <> 0)::INT DESC, CASE WHEN s_suppkey % 3 <> 0 THEN s_acctbal END DESC NULLS LAST, s_acctbal DESC, s_suppkey))::INT AS place FROM supplier")
def leaderboard(spark, d):
    honest = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal"))
    s = table(spark, d, "supplier").select("s_suppkey", F.col("s_acctbal").alias("score"), honest.alias("honest"))
    return graph.numbered(s, [F.col("honest").isNotNull().desc(), F.col("honest").desc_nulls_last(), F.col("score").desc(), F.col("s_suppkey")], "place")


@query(f"WITH {OBSERVATIONS}, v AS (SELECT paper, treatment, part, supp, nitrogen FROM obs WHERE nitrogen > 48), r AS (SELECT *, row_number() OVER (ORDER BY nitrogen DESC, paper, treatment, part, supp) AS k, count(*) OVER () AS total FROM v) SELECT paper, treatment, part, supp, nitrogen, total FROM r WHERE k <= 10")
def first_violations(spark, d):
    """The ten largest violations and the full count: the limit is the report."""
    v = observations(spark, d).filter("nitrogen > 48").select("paper", "treatment", "part", "supp", "nitrogen")
    top = v.orderBy(F.col("nitrogen").desc(), "paper", "treatment", "part", "supp").limit(10)
    return top.crossJoin(F.broadcast(v.agg(F.count("*").alias("total"))))


@query("WITH e AS (SELECT user_id, event_type, value, event_id, ['D', 'C', 'B', 'A'][(event_id % 4 + 1)::INT] AS grade FROM events) SELECT user_id, event_type, event_id, arg_min(event_id, (grade, -value, event_id)) OVER (PARTITION BY user_id, event_type) AS duplicate_of FROM e")
def canonical_evidence(spark, d):
    grade = F.element_at(F.array(*[F.lit(g) for g in "DCBA"]), (F.col("event_id") % 4 + 1).cast("int"))
    e = table(spark, d, "events").withColumn("grade", grade)
    best = e.groupBy("user_id", "event_type").agg(F.min_by("event_id", F.struct("grade", (-F.col("value")).alias("v"), "event_id")).alias("duplicate_of"))
    return e.join(best, ["user_id", "event_type"]).select("user_id", "event_type", "event_id", "duplicate_of")


@query("SELECT event_type, event_id, round(value - 1.96 * (2 + user_id % 3), 4) AS low, round(value + 1.96 * (2 + user_id % 3), 4) AS high, value - 1.96 * (2 + user_id % 3) > 0 AS significant FROM events")
def interval_sanity(spark, d):
    se = 2 + F.col("user_id") % 3
    low, high = F.col("value") - 1.96 * se, F.col("value") + 1.96 * se
    return table(spark, d, "events").select("event_type", "event_id", F.round(low, 4).alias("low"), F.round(high, 4).alias("high"), (low > 0).alias("significant"))


@query("SELECT user_id, round(0.30 * avg(value) / 500 + 0.25 * count(DISTINCT event_type) / 5 + 0.45 * avg(coalesce(try_cast(json_extract_string(props, '$.k') AS DOUBLE), 0)) / 100, 6) AS verified_confidence FROM events GROUP BY 1")
def verified_confidence(spark, d):
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("double"), F.lit(0.0))
    g = table(spark, d, "events").groupBy("user_id").agg((0.30 * F.avg("value") / 500 + 0.25 * F.count_distinct("event_type") / 5 + 0.45 * F.avg(k) / 100).alias("verified_confidence"))
    return _round(g, 6, "verified_confidence")


@query("WITH p AS (SELECT o_custkey, o_orderkey, o_totalprice, o_orderstatus FROM orders), a AS (SELECT o_custkey, list_sort(list_distinct(list(lower(o_orderstatus)))) AS statuses, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ';') AS joined, count(*) AS n FROM p GROUP BY 1) SELECT * FROM a")
def merged_lists(spark, d):
    s = F.collect_list("o_orderstatus")
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.array_distinct(F.transform(s, F.lower))).alias("statuses"), F.array_join(F.array_sort(F.array_distinct(s)), ";").alias("joined"), F.count("*").alias("n"))


@query("SELECT s_suppkey, '{\"name\":\"' || s_name || '\",\"nation\":' || s_nationkey || '}' AS json FROM supplier")
def json_records(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", F.to_json(F.struct(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation"))).alias("json"))


@query()
def ols_summary(spark, d):
    """Coefficients, errors and t values of price on standardised quantity, discount and tax, from one pass of moments."""
    import numpy as np

    xs, y = ["l_quantity", "l_discount", "l_tax"], "l_extendedprice"
    li = table(spark, d, "lineitem")
    aggs = [F.count("*").alias("n"), F.avg(y).alias("my"), F.var_samp(y).alias("vy")]
    for i, a in enumerate(xs):
        aggs += [F.stddev_samp(a).alias(f"s{i}"), F.covar_samp(a, y).alias(f"c{i}")] + [F.covar_samp(a, b).alias(f"m{i}{j}") for j, b in enumerate(xs)]
    r = li.agg(*aggs).first()
    s = np.array([r[f"s{i}"] for i in range(3)])
    m = np.array([[r[f"m{i}{j}"] for j in range(3)] for i in range(3)]) / np.outer(s, s)
    c = np.array([r[f"c{i}"] for i in range(3)]) / s
    beta = np.linalg.solve(m, c)
    sse = (r["vy"] - beta @ c) * (r["n"] - 1)
    se = np.sqrt(sse / (r["n"] - 4) * np.diag(np.linalg.inv(m)) / (r["n"] - 1))
    rows = [(x, round(float(b), 3), round(float(e), 3), round(float(b / e), 3)) for x, b, e in zip(xs, beta, se)]
    return spark.createDataFrame(rows, "feature string, coefficient double, error double, t double")


@query("SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(value) AS n, avg((least(greatest(value / 100, 0), 1) > 0.8::DOUBLE)::INT) AS share, median(value) AS median FROM events WHERE value IS NOT NULL GROUP BY 1, 2 HAVING count(value) >= 10")
def treatment_regimes(spark, d):
    """Drift per tumbling day and type: share of values beyond the shoulder, groups of at least ten."""
    from tessera.streaming.events import drift

    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return drift(e, ["day", "event_type"], "value", N.clip(F.col("value") / 100, 0, 1)).withColumn("day", F.col("day").cast("string"))


_KINDS = ["journal-article", "Review", "research", "letter"]
_TITLES = ["Field trial of zinc", "Erratum: plot", "Yield of wheat", "A factorial study"]
_ABSTRACTS = ["In silico work", "This review covers", "rcbd with four plots", "Prices"]


def _pick(values, column):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (column % len(values) + 1).cast("int"))


@query(
    f"""WITH r AS (SELECT p_partkey, {_KINDS}[p_partkey % 4 + 1] AS k, {_TITLES}[p_size % 4 + 1] AS t, {_ABSTRACTS}[(p_partkey // 4) % 4 + 1] AS a FROM part)
    SELECT p_partkey, k NOT IN ('Review', 'letter') AND t <> 'Erratum: plot' AND a <> 'This review covers' AND NOT (a = 'In silico work' AND t = 'Yield of wheat') AND (t IN ('Field trial of zinc', 'A factorial study') OR a = 'rcbd with four plots') AS original FROM r"""
)
def original_studies(spark, d):
    from tessera.functions.literature import is_original

    k = F.col("p_partkey")
    return table(spark, d, "part").select("p_partkey", is_original(_pick(_KINDS, k), _pick(_TITLES, F.col("p_size")), _pick(_ABSTRACTS, F.floor(k / 4))).alias("original"))


@query("SELECT s.s_suppkey AS source_id, min(p.id) AS paper_id FROM supplier s JOIN (SELECT p_partkey * 3 AS id, p_size AS z FROM part) p ON p.id = s.s_suppkey OR (p.z = s.s_nationkey AND s.s_suppkey % 2 = 0) GROUP BY 1")
def source_papers(spark, d):
    from tessera.functions.literature import belongs_to

    s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("10.1234/n"), F.col("s_nationkey"))).alias("doi"), F.lit(None).cast("string").alias("title"))
    p = table(spark, d, "part").select((F.col("p_partkey") * 3).alias("id"), F.concat(F.lit("https://doi.org/10.1234/N"), F.col("p_size")).alias("doi"), "p_name").withColumnRenamed("p_name", "title")
    return belongs_to(s, p)
