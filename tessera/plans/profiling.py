"""Queries: missing values, statistics, outliers, correlations, checks, contracts, metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.operators import fusion, profile
from tessera.plans.registry import query
from tessera.plans.tables import OBSERVATIONS, observations, table

MEASURES = ["nitrogen", "yield_ha", "moisture", "carbon"]


def _each(select: str, columns=MEASURES) -> str:
    return f"WITH {OBSERVATIONS} " + " UNION ALL ".join("SELECT '{c}' AS column_name, ".replace("{c}", c) + select.replace("$c", c) + " FROM obs" for c in columns)


@query(_each("count(*) - count($c) AS missing, count($c) AS available, round(100.0 * (count(*) - count($c)) / nullif(count(*), 0), 4) AS missing_pct", [*MEASURES, "crop"]))
def missing_profile(spark, d):
    return profile.missing(observations(spark, d), [*MEASURES, "crop"])


@query(_each("count($c) AS available, count(DISTINCT $c) AS n_distinct, count(DISTINCT $c) <= 1 AS constant", [*MEASURES, "crop", "soil"]))
def column_profile(spark, d):
    return profile.columns_profile(observations(spark, d), [*MEASURES, "crop", "soil"])


@query(_each("count($c) AS n, round(avg($c), 4) AS mean, round(quantile_cont($c, 0.5), 4) AS median, round(var_samp($c), 4) AS variance, round(stddev_samp($c), 4) AS deviation, min($c) AS least, max($c) AS most, round(skewness($c), 4) AS skew, round(kurtosis($c), 4) AS kurt, round(quantile_cont($c, 0.25), 4) AS q1, round(quantile_cont($c, 0.75), 4) AS q3", ["nitrogen", "moisture", "carbon"]))
def statistical_profile(spark, d):
    return profile.statistics(observations(spark, d), ["nitrogen", "moisture", "carbon"])


_Q = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE n > 3 AND q3 > q1 AND ({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))) AS iqr,
    count(*) FILTER (WHERE sd > 0 AND abs({c} - mu) > 3 * sd) AS zscore, count(*) FILTER (WHERE n >= 5 AND mad > 0 AND 0.6745 * abs({c} - med) > 3.5 * mad) AS mad_count
    FROM v, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.5) AS med, avg({c}) AS mu, stddev_samp({c}) AS sd, count({c}) AS n FROM v) a,
    (SELECT quantile_cont(abs({c} - m), 0.5) AS mad FROM v, (SELECT quantile_cont({c}, 0.5) AS m FROM v)) b"""
    for c in ("value", "logv")
)


@query(f"WITH v AS (SELECT value, value * value AS logv FROM events) {_Q}")
def outlier_counts(spark, d):
    v = table(spark, d, "events").select("value", (F.col("value") * F.col("value")).alias("logv"))
    return profile.outliers(v, ["value", "logv"])


_PAIRS = [(a, b) for i, a in enumerate(MEASURES) for b in MEASURES[i + 1 :]]


@query(f"WITH {OBSERVATIONS} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM obs" for a, b in _PAIRS))
def correlation_matrix(spark, d):
    return profile.correlations(observations(spark, d), MEASURES).withColumn("r", F.round("r", 6))


_LI = ["price", "revenue", "charge", "quantity"]
_LIP = [(a, b) for i, a in enumerate(_LI) for b in _LI[i + 1 :]]
_REVENUE = "v AS (SELECT l_extendedprice AS price, l_extendedprice * (1 - l_discount) AS revenue, l_extendedprice * (1 - l_discount) * (1 + l_tax) AS charge, l_quantity AS quantity FROM lineitem)"


@query(f"WITH {_REVENUE}, c AS (" + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM v" for a, b in _LIP) + ") SELECT * FROM c WHERE abs(r) >= 0.8")
def high_correlations(spark, d):
    li, net = table(spark, d, "lineitem"), F.col("l_extendedprice") * (1 - F.col("l_discount"))
    v = li.select(F.col("l_extendedprice").alias("price"), net.alias("revenue"), (net * (1 + F.col("l_tax"))).alias("charge"), F.col("l_quantity").alias("quantity"))
    return profile.high_pairs(profile.correlations(v, _LI).withColumn("r", F.round("r", 6)), 0.8)


@query(
    "WITH p AS (SELECT corr(l_quantity, l_extendedprice) AS ab, corr(l_quantity, l_discount) AS ac, corr(l_extendedprice, l_discount) AS bc FROM lineitem), "
    "q AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM p) "
    "SELECT 'l_quantity' AS column_name, round((1 - bc * bc) / det, 6) AS vif FROM q UNION ALL SELECT 'l_extendedprice', round((1 - ac * ac) / det, 6) FROM q UNION ALL SELECT 'l_discount', round((1 - ab * ab) / det, 6) FROM q"
)
def variance_inflation(spark, d):
    return profile.inflation(table(spark, d, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]).withColumn("vif", F.round("vif", 6))


BOUNDS = {"nitrogen": (5, 45), "yield_ha": (1000, 90000), "moisture": (0, 9), "carbon": (0.01, 0.07)}


@query(f"WITH {OBSERVATIONS} " + " UNION ALL ".join(f"SELECT '{c}' AS column_name, {lo}::DOUBLE AS low, {hi}::DOUBLE AS high, count({c}) AS checked, count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS violations FROM obs" for c, (lo, hi) in BOUNDS.items()))
def range_violations(spark, d):
    return profile.range_checks(observations(spark, d), BOUNDS)


@query(
    f"""WITH {OBSERVATIONS}, r AS (SELECT paper, treatment, part, supp, unnest([
      CASE WHEN yield_ha IS NOT NULL AND nitrogen > 0 AND NOT (yield_ha / nitrogen BETWEEN 1000 AND 1900) THEN {{'rule': 'yield_ratio', 'severity': 'warning'}} END,
      CASE WHEN nitrogen IS NOT NULL AND NOT nitrogen <= 45 THEN {{'rule': 'rate_sanity', 'severity': 'warning'}} END,
      CASE WHEN NOT moisture >= carbon * 100 THEN {{'rule': 'consistency', 'severity': 'error'}} END]) AS v FROM obs)
    SELECT paper, treatment, part, supp, v.rule AS rule, v.severity AS severity FROM r WHERE v IS NOT NULL"""
)
def rule_violations(spark, d):
    c = F.col
    rules = [
        ("yield_ratio", c("yield_ha").isNotNull() & (c("nitrogen") > 0), F.coalesce((c("yield_ha") / F.when(c("nitrogen") > 0, c("nitrogen"))).between(1000, 1900), F.lit(True)), "warning"),
        ("rate_sanity", c("nitrogen").isNotNull(), c("nitrogen") <= 45, "warning"),
        ("consistency", F.lit(True), c("moisture") >= c("carbon") * 100, "error"),
    ]
    return profile.rule_violations(observations(spark, d), ["paper", "treatment", "part", "supp"], rules)


@query("SELECT 'type' AS check, 'l_quantity' AS column_name, 'double for int' AS detail UNION ALL SELECT 'missing', 'l_weight', 'double' UNION ALL SELECT 'unexpected', c, 'x' FROM (SELECT unnest(['l_tax']) AS c) WHERE false")
def schema_contract(spark, d):
    required = {"l_orderkey": "bigint", "l_quantity": "int", "l_weight": "double"}
    return profile.contract(table(spark, d, "lineitem").select("l_orderkey", "l_quantity"), required, ["l_orderkey"])


@query(f"WITH {OBSERVATIONS}, g AS (SELECT count(*) AS n FROM obs GROUP BY paper, crop) SELECT sum(n - 1)::BIGINT AS beyond_first, sum(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS members, count(*) FILTER (WHERE n > 1)::BIGINT AS repeated_keys FROM g")
def duplicate_row_counts(spark, d):
    return fusion.duplicate_rows(observations(spark, d), ["paper", "crop"])


@query("SELECT l_returnflag, count(*) AS n, round(1 - sum((l_extendedprice - 1500 * l_quantity) ** 2) / (var_pop(l_extendedprice) * count(*)), 4) AS r2, round(sqrt(avg((l_extendedprice - 1500 * l_quantity) ** 2)), 2) AS rmse, round(avg(abs(l_extendedprice - 1500 * l_quantity)), 2) AS mae, round(100 * avg(abs(l_extendedprice - 1500 * l_quantity) / nullif(l_extendedprice, 0)), 4) AS mape FROM lineitem GROUP BY 1")
def regression_metrics(spark, d):
    li = table(spark, d, "lineitem").withColumn("p", 1500 * F.col("l_quantity"))
    m = profile.regression_metrics(li, "l_extendedprice", "p", ["l_returnflag"])
    return m.select("l_returnflag", "n", F.round("r2", 4).alias("r2"), F.round("rmse", 2).alias("rmse"), F.round("mae", 2).alias("mae"), F.round("mape", 4).alias("mape"))


@query("WITH b AS (SELECT unnest([0, 1, 2, 3, 4]) AS bin), e AS (SELECT CASE WHEN value >= 0 AND value < 10 THEN 0 WHEN value >= 10 AND value < 50 THEN 1 WHEN value >= 50 AND value < 100 THEN 2 WHEN value >= 100 AND value < 500 THEN 3 WHEN value >= 500 AND value < 10000 THEN 4 END AS bin FROM events) SELECT b.bin AS bin, count(e.bin) AS n FROM b LEFT JOIN e USING (bin) GROUP BY 1")
def score_histogram(spark, d):
    return profile.histogram(table(spark, d, "events"), "value", [0, 10, 50, 100, 500, 10000])


@query("SELECT event_type, count(*) AS n, round(avg(value), 3) AS mean, round(quantile_cont(value, 0.5), 3) AS median, min(value) AS least, max(value) AS most, round(stddev_samp(value), 3) AS deviation, count(*) FILTER (WHERE value <= 30) AS low, count(*) FILTER (WHERE value > 30 AND value <= 60) AS medium, count(*) FILTER (WHERE value > 60) AS high FROM events GROUP BY 1")
def score_summary(spark, d):
    v = F.col("value")
    return table(spark, d, "events").groupBy("event_type").agg(
        F.count("*").alias("n"), F.round(F.avg(v), 3).alias("mean"), F.round(F.median(v), 3).alias("median"), F.min(v).alias("least"), F.max(v).alias("most"), F.round(F.stddev_samp(v), 3).alias("deviation"),
        F.count_if(v <= 30).alias("low"), F.count_if((v > 30) & (v <= 60)).alias("medium"), F.count_if(v > 60).alias("high"),
    )


@query("WITH t AS (SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS tp, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS fp, count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS fn FROM labels) SELECT tp, fp, fn, round(tp / nullif(tp + fp, 0), 6) AS precision_, round(tp / nullif(tp + fn, 0), 6) AS recall, round(2 * tp / nullif(2 * tp + fp + fn, 0), 6) AS f1 FROM t")
def extraction_scores(spark, d):
    q, x = F.col("quality") == 1, F.col("toxic") == 0
    t = table(spark, d, "labels").agg(F.count_if(q & x).alias("tp"), F.count_if(~q & x).alias("fp"), F.count_if(q & ~x).alias("fn"))
    div = lambda a, b: F.round(a / F.nullif(b, F.lit(0)), 6)
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return t.select("tp", "fp", "fn", div(tp, tp + fp).alias("precision_"), div(tp, tp + fn).alias("recall"), div(2 * tp, 2 * tp + fp + fn).alias("f1"))


@query(f"WITH {OBSERVATIONS}, m AS (SELECT avg((nitrogen IS NULL)::INT) AS a, avg((yield_ha IS NULL)::INT) AS b, avg((crop IS NULL)::INT) AS c, count(DISTINCT crop) AS k FROM obs) SELECT round(100 * (a + b + c) / 3, 4) AS missing_pct, ((a > 0.1)::INT + (b > 0.1)::INT + (c > 0.1)::INT) AS columns_over, k AS classes, (a + b + c) / 3 < 0.2 AS ready FROM m")
def training_readiness(spark, d):
    share = lambda c: F.avg(F.col(c).isNull().cast("int"))
    m = observations(spark, d).agg(share("nitrogen").alias("a"), share("yield_ha").alias("b"), share("crop").alias("c"), F.count_distinct("crop").alias("k"))
    a, b, c = F.col("a"), F.col("b"), F.col("c")
    over = sum(((x > 0.1).cast("int") for x in (a, b, c)), F.lit(0))
    return m.select(F.round(100 * (a + b + c) / 3, 4).alias("missing_pct"), over.alias("columns_over"), F.col("k").alias("classes"), ((a + b + c) / 3 < 0.2).alias("ready"))


TARGETS = {"coverage": (">=", 0.75), "missing": ("<=", 0.1), "mean_tax": ("<=", 0.05), "absent": (">=", 0.5)}


@query(f"WITH {OBSERVATIONS}, m AS (SELECT avg((yield_ha IS NOT NULL)::INT) AS a, avg((nitrogen IS NULL)::INT) AS b, avg(carbon) AS c FROM obs) SELECT metric, round(v, 6) AS value, target, ok FROM (SELECT 'coverage' AS metric, a AS v, 0.75::DOUBLE AS target, a >= 0.75 AS ok FROM m UNION ALL SELECT 'missing', b, 0.1::DOUBLE, b <= 0.1 FROM m UNION ALL SELECT 'mean_tax', c, 0.05::DOUBLE, c <= 0.05 FROM m UNION ALL SELECT 'absent', 0.0::DOUBLE, 0.5::DOUBLE, false)")
def performance_targets(spark, d):
    o = observations(spark, d).agg(F.avg(F.col("yield_ha").isNotNull().cast("int")).alias("coverage"), F.avg(F.col("nitrogen").isNull().cast("int")).alias("missing"), F.avg("carbon").alias("mean_tax"))
    rows = []
    for k, (sign, t) in TARGETS.items():
        v = F.col(k) if k in o.columns else F.lit(0.0)
        rows.append(F.struct(F.lit(k).alias("metric"), F.round(v, 6).alias("value"), F.lit(t).alias("target"), (v >= t if sign == ">=" else v <= t).alias("ok")))
    return o.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


@query("SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) < 12")
def class_balance(spark, d):
    return table(spark, d, "part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n")).filter("n < 12")


@query(f"WITH {OBSERVATIONS} SELECT soil, round(avg(((nitrogen IS NOT NULL)::INT + (yield_ha IS NOT NULL)::INT + (crop IS NOT NULL)::INT) / 3), 6) AS coverage, count(*) AS n FROM obs GROUP BY 1")
def provenance_coverage(spark, d):
    filled = sum((F.col(c).isNotNull().cast("int") for c in ("nitrogen", "yield_ha", "crop")), F.lit(0))
    return observations(spark, d).groupBy("soil").agg(F.round(F.avg(filled / 3), 6).alias("coverage"), F.count("*").alias("n"))


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")
def registry_summary(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("_orders")
    return spark.sql("SELECT o_orderstatus, o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM _orders GROUP BY GROUPING SETS ((o_orderstatus, o_orderpriority), (o_orderstatus), ())")


@query(f"WITH {OBSERVATIONS}, f AS (SELECT 'nitrogen' AS feature, abs(corr(nitrogen, yield_ha)) AS s FROM obs UNION ALL SELECT 'moisture', abs(corr(moisture, yield_ha)) FROM obs UNION ALL SELECT 'carbon', abs(corr(carbon, yield_ha)) FROM obs) SELECT feature, round(s, 6) AS score, rank() OVER (ORDER BY s DESC) AS place, CASE WHEN s >= 0.5 THEN 'high' WHEN s >= 0.01 THEN 'medium' ELSE 'low' END AS tier FROM f")
def target_correlation(spark, d):
    o = observations(spark, d)
    row = o.agg(*[F.abs(N.pearson(F.col(c), F.col("yield_ha"))).alias(c) for c in ("nitrogen", "moisture", "carbon")])
    long = row.unpivot([], ["nitrogen", "moisture", "carbon"], "feature", "s")
    from pyspark.sql import Window

    return long.select("feature", F.round("s", 6).alias("score"), F.rank().over(Window.orderBy(F.col("s").desc())).alias("place"), F.when(F.col("s") >= 0.5, "high").when(F.col("s") >= 0.01, "medium").otherwise("low").alias("tier"))
