"""Queries: scalar functions, features, unit and basis conversion, scores, fuzzy inference."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import text as X
from tessera.operators import features, fuzzy, recommend
from tessera.plans.registry import query
from tessera.plans.tables import OBSERVATIONS, observations, table


def _r(c, digits=6):
    return F.round(c, digits)


_MEAN = "((l_quantity + l_discount * 100) / 2)"


@query(
    f"SELECT l_orderkey, l_linenumber, l_partkey, round(greatest({_MEAN} - 10, 0), 6) AS gdd, round(greatest(l_quantity - 10, 0), 6) AS heat_units, round(l_quantity - l_discount * 100, 6) + 0.0 AS temp_range, round({_MEAN} * {_MEAN}, 6) AS temp_squared, round((l_quantity - l_discount * 100) / nullif({_MEAN}, 0), 6) + 0.0 AS temp_cv, "
    + ", ".join(f"round(greatest(l_quantity - {t}, 0), 6) AS above_{t}" for t in (10, 15, 20, 25, 30, 35)) + " FROM lineitem"
)
def thermal_features(spark, d):
    li = table(spark, d, "lineitem")
    t = features.thermal(F.col("l_quantity"), F.col("l_discount") * 100)
    return li.select("l_orderkey", "l_linenumber", "l_partkey", *[(_r(c) + 0.0).alias(k) for k, c in t.items()])  # no negative zeros


@query("SELECT event_id, round(ln(1 + greatest(value, 0)), 6) AS log_value, round(sqrt(greatest(value, 0)), 6) AS sqrt_value, round(value * value, 4) AS sq_value FROM events")
def transform_features(spark, d):
    e = table(spark, d, "events")
    t = features.transforms(["value"])
    return e.select("event_id", _r(t["log_value"]).alias("log_value"), _r(t["sqrt_value"]).alias("sqrt_value"), _r(t["sq_value"], 4).alias("sq_value"))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, nitrogen / nullif(moisture, 0) AS nitrogen_per_moisture, yield_ha / nullif(nitrogen, 0) AS yield_ha_per_nitrogen, nitrogen * moisture AS nitrogen_x_moisture, nitrogen * moisture * carbon AS nitrogen_x_moisture_x_carbon FROM obs")
def ratio_and_interaction_features(spark, d):
    o = observations(spark, d)
    f = features.ratios([("nitrogen", "moisture"), ("yield_ha", "nitrogen")]) | features.products([["nitrogen", "moisture"], ["nitrogen", "moisture", "carbon"]])
    return o.select("paper", "treatment", "part", "supp", *[c.alias(k) for k, c in f.items()])


@query("WITH m AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT event_id, (CASE WHEN value > 0 AND value <= 10 THEN 0 WHEN value > 10 AND value <= 50 THEN 1 WHEN value > 50 AND value <= 100 THEN 2 END)::INT AS rain_bin, greatest(0, least(4, ceil((value - lo) / nullif((hi - lo) / 5, 0)) - 1))::INT AS equal_bin, round_even(value / 100, 0) * 100 AS hundred FROM events, m")
def binned_features(spark, d):
    e = table(spark, d, "events")
    m = F.broadcast(e.agg(F.min("value").alias("lo"), F.max("value").alias("hi")))
    return e.crossJoin(m).select("event_id", N.cut_right(F.col("value"), [0, 10, 50, 100]).alias("rain_bin"), N.cut_equal(F.col("value"), F.col("lo"), F.col("hi"), 5).alias("equal_bin"), (F.bround(F.col("value") / 100, 0) * 100).alias("hundred"))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, round(exp(-0.5 * ((nitrogen - 25) / 8) ** 2), 6) AS suitability, round(1 - (abs(nitrogen / nullif(nitrogen + moisture + carbon, 0) - 0.4) + abs(moisture / nullif(nitrogen + moisture + carbon, 0) - 0.2) + abs(carbon / nullif(nitrogen + moisture + carbon, 0) - 0.4)) / 2, 6) AS balance, CASE WHEN nitrogen IS NULL THEN 'unknown' WHEN nitrogen < 15 THEN 'low' WHEN nitrogen <= 35 THEN 'medium' ELSE 'high' END AS status, CASE WHEN nitrogen < 10 THEN 1 ELSE 0 END AS deficient FROM obs")
def soil_indices(spark, d):
    n = F.col("nitrogen")
    return observations(spark, d).select(
        "paper", "treatment", "part", "supp", _r(features.bell(n, 25, 8)).alias("suitability"), _r(features.balance(n, F.col("moisture"), F.col("carbon"))).alias("balance"),
        features.status(n, 15, 35).alias("status"), features.flag(n < 10).alias("deficient"),
    )


@query("WITH c AS (SELECT p_type, (row_number() OVER (ORDER BY p_type) - 1)::INT AS code FROM (SELECT DISTINCT p_type FROM part)), s AS (SELECT p_brand, (row_number() OVER (ORDER BY first) - 1)::INT AS seen FROM (SELECT p_brand, min(p_partkey) AS first FROM part GROUP BY 1)) SELECT p_partkey, code, seen FROM part JOIN c USING (p_type) JOIN s USING (p_brand)")
def label_encodings(spark, d):
    p = features.encode_sorted(table(spark, d, "part"), "p_type", "code")
    return features.encode_first_seen(p, "p_brand", ["p_partkey"], "seen").select("p_partkey", "code", "seen")


@query("SELECT p_partkey, p_size * 1.724::DOUBLE AS organic_matter, round(p_retailprice * (10000 / nullif(p_size % 7, 0)), 4) AS yield_ha, p_retailprice AS kept FROM part")
def derivation_rules(spark, d):
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("oc"), F.col("p_retailprice").alias("plot"), (F.col("p_size") % 7).alias("area"), F.col("p_retailprice").alias("kept"), F.lit(None).cast("double").alias("organic_matter"))
    rules = [
        ("organic_matter", ["oc"], F.col("oc") * 1.724), ("organic_matter", ["plot"], F.lit(-1.0)), ("kept", ["oc"], F.lit(-1.0)),
        ("yield_ha", ["missing_column"], F.lit(-1.0)), ("yield_ha", ["plot", "area"], F.round(F.col("plot") * (10000 / F.nullif(F.col("area"), F.lit(0))), 4)),
    ]
    return features.derive(p, rules).select("p_partkey", "organic_matter", "yield_ha", "kept")


@query("WITH m AS (SELECT max(l_quantity) AS a, max(l_tax) AS b FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN a > 40 THEN (l_quantity - 32) * 5 / 9 ELSE l_quantity END, 6) AS temp, round(CASE WHEN b < 1 THEN l_tax * 1000 ELSE l_tax END, 6) AS rate FROM lineitem, m")
def conversion_by_maximum(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_quantity").alias("temp"), F.col("l_tax").alias("rate"))
    out = features.convert_by_maximum(li, [("temp", ">", 40, (F.col("temp") - 32) * 5 / 9), ("rate", "<", 1, F.col("rate") * 1000)])
    return out.withColumns({"temp": _r(F.col("temp")), "rate": _r(F.col("rate"))})


@query(
    """WITH u AS (SELECT p_partkey, p_size::DOUBLE AS v, ['t/ha', 'kg ha-1', 'G/KG', 'mm', 'F', 'furlong'][p_partkey % 6 + 1] AS s, ['kg/ha', '%', 'cm'][p_size % 3 + 1] AS t FROM part),
    f AS (SELECT *, CASE s WHEN 't/ha' THEN 'a' WHEN 'kg ha-1' THEN 'a' WHEN 'G/KG' THEN 'f' WHEN 'mm' THEN 'l' WHEN 'F' THEN 'h' END AS sd, CASE t WHEN 'kg/ha' THEN 'a' WHEN '%' THEN 'f' ELSE 'l' END AS td, CASE s WHEN 't/ha' THEN 1000.0 WHEN 'kg ha-1' THEN 1.0 ELSE 0.1 END::DOUBLE AS k FROM u)
    SELECT p_partkey, round(CASE WHEN sd = td THEN v * k ELSE v END, 6) AS value, sd IS NULL OR sd = td AS ok, CASE WHEN sd IS NULL THEN 'unverified' WHEN sd = td THEN 'converted' ELSE 'incompatible' END AS reason FROM f"""
)
def unit_conversion(spark, d):
    pick = lambda items, i: F.element_at(F.array(*[F.lit(x) for x in items]), (i + 1).cast("int"))
    p = table(spark, d, "part").select("p_partkey", F.col("p_size").cast("double").alias("v"), pick(["t/ha", "kg ha-1", "G/KG", "mm", "F", "furlong"], F.col("p_partkey") % 6).alias("s"), pick(["kg/ha", "%", "cm"], F.col("p_size") % 3).alias("t"))
    out = p.select("p_partkey", X.convert_unit(F.col("v"), F.col("s"), F.col("t")).alias("c"))
    return out.select("p_partkey", _r(F.col("c.value")).alias("value"), "c.ok", "c.reason")


_P, _K = X.oxide_factor("P2O5"), X.oxide_factor("K2O")


@query(f"SELECT p_partkey, (p_size * 2)::DOUBLE AS n, round(p_size * {_P}, 6) AS p, round((p_size + 5) * {_K}, 6) AS k FROM part")
def npk_ratio(spark, d):
    t = F.concat(F.lit("N"), F.col("p_size") * 2, F.lit(":"), F.col("p_size"), F.lit("-"), F.col("p_size") + 5, F.lit(" kg/ha"))
    return table(spark, d, "part").select("p_partkey", X.npk(t).alias("r")).select("p_partkey", "r.n", _r(F.col("r.p")).alias("p"), _r(F.col("r.k")).alias("k"))


@query(f"WITH {OBSERVATIONS} SELECT paper, treatment, part, supp, round(((nitrogen IS NOT NULL)::INT / 1.0 + ((yield_ha IS NOT NULL)::INT + (moisture IS NOT NULL)::INT) / 2.0 + (crop IS NOT NULL)::INT / 1.0) / 3.0, 6)::DOUBLE AS quality, list_filter([CASE WHEN nitrogen IS NULL THEN 'nitrogen' END, CASE WHEN yield_ha IS NULL THEN 'yield_ha' END, CASE WHEN crop IS NULL THEN 'crop' END], lambda x: x IS NOT NULL) AS missing FROM obs")
def row_quality(spark, d):
    q = features.quality_score({"a": ["nitrogen"], "b": ["yield_ha", "moisture"], "c": ["crop"]})
    return observations(spark, d).select("paper", "treatment", "part", "supp", _r(q).alias("quality"), features.missing_fields(["nitrogen", "yield_ha", "crop"]).alias("missing"))


_ST = lambda c, lo, hi: f"CASE WHEN {c} IS NULL THEN 'unknown' WHEN {c} < {lo} THEN 'low' WHEN {c} <= {hi} THEN 'medium' ELSE 'high' END"


@query(
    f"""WITH {OBSERVATIONS}, s AS (SELECT *, {_ST('nitrogen', 12, 35)} AS ns, {_ST('moisture', 2, 8)} AS ps, {_ST('carbon', 0.02, 0.06)} AS ks FROM obs),
    p AS (SELECT *, CASE WHEN ns = 'low' THEN 'Urea' WHEN ps = 'low' THEN 'DAP' WHEN ks = 'low' THEN 'MOP' ELSE coalesce(crop, CASE WHEN soil = 'O' THEN 'FYM' END, 'Bio NPK') END AS product,
      coalesce(nitrogen, 100.0) * (CASE ns WHEN 'low' THEN 1.25 WHEN 'high' THEN 0.75 ELSE 1.0 END) * (CASE WHEN yield_ha / 50 > 1200 THEN 0.9 WHEN yield_ha / 50 < 400 THEN 1.1 ELSE 1.0 END) AS dose0 FROM s)
    SELECT paper, treatment, part, supp, product, round(dose0, 4)::DOUBLE AS dose, CASE WHEN product IN ('Bio NPK', 'Jaivik Khad', 'Vermicompost', 'FYM') THEN 0.9 WHEN dose0 < 50 THEN 0.7 WHEN dose0 < 100 THEN 0.5 WHEN dose0 < 200 THEN 0.4 ELSE 0.3 END::DOUBLE AS env FROM p"""
)
def recommendations(spark, d):
    o = observations(spark, d)
    s = lambda c, lo, hi: features.status(F.col(c), lo, hi)
    product = recommend.fertilizer(s("nitrogen", 12, 35), s("moisture", 2, 8), s("carbon", 0.02, 0.06), F.col("crop"), F.when(F.col("soil") == "O", "FYM"))
    rain = F.col("yield_ha") / 50
    n_status = s("nitrogen", 12, 35)
    dose = F.coalesce(F.col("nitrogen"), F.lit(100.0)) * F.when(n_status == "low", 1.25).when(n_status == "high", 0.75).otherwise(1.0) * F.when(rain > 1200, 0.90).when(rain < 400, 1.10).otherwise(1.0)
    o = o.withColumns({"product": product, "_dose": dose})
    return o.select("paper", "treatment", "part", "supp", "product", F.round("_dose", 4).alias("dose"), recommend.environmental(F.col("product"), F.col("_dose")).alias("env"))


@query("SELECT c_custkey, round(greatest(0, least(1, (c_acctbal / 1000 * 25000) / (15 * 100) / 10)), 3) AS economic, round(least(1, greatest(0, round(1 - (0.5 + greatest(0, least(1, (c_acctbal / 1000 * 25000) / (15 * 100) / 10))) / 2, 3))), 3) AS risk FROM customer WHERE c_acctbal > 0")
def economic_and_risk_scores(spark, d):
    c = table(spark, d, "customer").filter("c_acctbal > 0")
    raw = N.clip(F.col("c_acctbal") / 1000 * 25000 / 1500 / 10, 0, 1)
    econ = recommend.economic(F.col("c_acctbal"), F.lit(15.0), F.lit(100.0))
    return c.select("c_custkey", econ.alias("economic"), recommend.risk(F.lit(0.5), raw).alias("risk"))


@query("WITH s AS (SELECT p_partkey, ['alpha', 'beta', 'gamma', 'delta'] AS n, [p_size % 10, p_size % 7, p_partkey % 5, 4]::DOUBLE[] AS v FROM part), u AS (SELECT p_partkey, unnest([1, 2, 3, 4]) AS i, n, v FROM s), r AS (SELECT p_partkey, n[i] AS name, v[i] AS score, row_number() OVER (PARTITION BY p_partkey ORDER BY v[i] DESC, i) AS k FROM u) SELECT p_partkey, string_agg(name, ',' ORDER BY k) AS best, max(score) AS top FROM r WHERE k <= 3 GROUP BY 1")
def top_alternatives(spark, d):
    items = [("alpha", F.col("p_size") % 10), ("beta", F.col("p_size") % 7), ("gamma", F.col("p_partkey") % 5), ("delta", F.lit(4))]
    t = table(spark, d, "part").select("p_partkey", recommend.top_choices([(n, s.cast("double")) for n, s in items], 3).alias("t"))
    return t.select("p_partkey", F.array_join(F.transform("t", lambda x: x["name"]), ",").alias("best"), F.col("t")[0]["score"].alias("top"))


@query("WITH p AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS a, 1500 * l_quantity AS b, 30000 + l_tax AS c FROM lineitem), m AS (SELECT *, (a + b + c) / 3 AS mean FROM p), s AS (SELECT *, sqrt(((a - mean) ** 2 + (b - mean) ** 2 + (c - mean) ** 2) / 2) AS sd FROM m), k AS (SELECT *, 1 / (1 + sd / abs(mean)) AS conf FROM s) SELECT l_orderkey, l_linenumber, l_partkey, round(mean, 4) AS mean, round(conf, 6) AS confidence, round(mean - 1.96 * (1 - conf) * abs(mean), 3) AS low, CASE WHEN conf >= 0.8 THEN 'low' WHEN conf >= 0.5 THEN 'medium' ELSE 'high' END AS tier FROM k")
def prediction_ensemble(spark, d):
    e = recommend.ensemble([F.col("l_extendedprice"), 1500 * F.col("l_quantity"), 30000 + F.col("l_tax")])
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", _r(e["mean"], 4).alias("mean"), _r(e["confidence"]).alias("confidence"), _r(e["low"], 3).alias("low"), e["tier"].alias("tier"))


def _sql_member(x, spec):
    kind, *p = spec
    if kind == "triangle":
        a, b, c = p
        v = f"greatest(0, least(({x} - {a}) / ({b} - {a} + 1e-10), ({c} - {x}) / ({c} - {b} + 1e-10)))"
    elif kind == "trapezoid":
        a, b, c, e = p
        v = f"greatest(0, least(({x} - {a}) / ({b} - {a} + 1e-10), 1, ({e} - {x}) / ({e} - {c} + 1e-10)))"
    else:
        a, b = p
        v = f"CASE WHEN {x} <= {a} THEN 0 WHEN {x} >= {b} THEN 1 ELSE ({x} - {a}) / ({b} - {a} + 1e-10) END"
        v = f"(1 - {v})" if kind == "low" else v
    return f"coalesce(CASE WHEN {x} IS NOT NULL THEN least(1, greatest(0, {v})) END, 0)::DOUBLE"


INPUTS = {"Nitrogen": "n", "Soil_pH": "ph", "Rainfall": "rain"}
RULES = [
    ({"Nitrogen": "low", "Rainfall": "high"}, "dose", "high"), ({"Nitrogen": "medium"}, "dose", "medium"), ({"Nitrogen": "high", "Soil_pH": "neutral"}, "dose", "low"),
    ({"Soil_pH": "acidic", "Rainfall": "low"}, "dose", "low"), ({"Soil_pH": "alkaline"}, "dose", "medium"),
]
OUT = {"low": ("low", 0.2, 0.5), "medium": ("triangle", 0.2, 0.5, 0.8), "high": ("high", 0.5, 0.8)}
_IN = "i AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(l_quantity, 7.0) * 2.5 AS n, 4 + l_discount * 45 AS ph, l_extendedprice / 60 AS rain FROM lineitem)"
_MU = ", ".join(f"{_sql_member(c, spec)} AS {c}_{label}" for v, c in INPUTS.items() for label, spec in fuzzy.SETS[v].items())


def _inputs(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (F.nullif(F.col("l_quantity"), F.lit(7.0)) * 2.5).alias("n"), (4 + F.col("l_discount") * 45).alias("ph"), (F.col("l_extendedprice") / 60).alias("rain"))


@query(f"WITH {_IN} SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"round({_sql_member(c, spec)}, 6) AS {c}_{label}" for v, c in INPUTS.items() for label, spec in fuzzy.SETS[v].items()) + " FROM i")
def fuzzify(spark, d):
    cols = [_r(fuzzy.membership(F.col(c), *spec)).alias(f"{c}_{label}") for v, c in INPUTS.items() for label, spec in fuzzy.SETS[v].items()]
    return _inputs(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *cols)


def _fired_sql():
    by = {}
    for cond, _, label in RULES:
        by.setdefault(label, []).append("least(" + ", ".join(f"{INPUTS[v]}_{s}" for v, s in cond.items()) + ")")
    return {k: "greatest(" + ", ".join(v) + ")" for k, v in by.items()}


@query(f"WITH {_IN}, m AS (SELECT l_orderkey, l_linenumber, l_partkey, {_MU} FROM i), f AS (SELECT l_orderkey, l_linenumber, l_partkey, " + ", ".join(f"{e} AS {k}" for k, e in _fired_sql().items()) + " FROM m) SELECT l_orderkey, l_linenumber, l_partkey, round(low, 6) AS low, round(medium, 6) AS medium, round(high, 6) AS high, CASE WHEN high > 0 AND high = greatest(low, medium, high) THEN 'high' WHEN medium > 0 AND medium = greatest(low, medium, high) THEN 'medium' WHEN low > 0 THEN 'low' ELSE 'none' END AS action FROM f")
def rule_firing(spark, d):
    degrees = {v: fuzzy.fuzzify(F.col(c), fuzzy.SETS[v]) for v, c in INPUTS.items()}
    fired = fuzzy.fire(degrees, RULES)
    s = {k: fired[("dose", k)] for k in ("high", "medium", "low")}
    i = _inputs(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", *[c.alias(f"_{k}") for k, c in s.items()])
    return i.select("l_orderkey", "l_linenumber", "l_partkey", *[_r(F.col(f"_{k}")).alias(k) for k in ("low", "medium", "high")], fuzzy.strongest({k: F.col(f"_{k}") for k in s}, "none").alias("action"))


@query(
    f"WITH {_IN}, m AS (SELECT l_orderkey, l_linenumber, l_partkey, {_MU} FROM i), f AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER () AS rid, " + ", ".join(f"{e} AS s_{k}" for k, e in _fired_sql().items()) + " FROM m), "
    f"g AS (SELECT x, {', '.join(f'{_sql_member(chr(120), spec)} AS o_{k}' for k, spec in OUT.items())} FROM (SELECT unnest(range(0, 50)) / 49.0::DOUBLE AS x)), "
    "h AS (SELECT l_orderkey, l_linenumber, l_partkey, rid, sum(x * greatest(least(s_low, o_low), least(s_medium, o_medium), least(s_high, o_high))) AS a, sum(greatest(least(s_low, o_low), least(s_medium, o_medium), least(s_high, o_high))) AS b FROM f, g GROUP BY ALL) "
    "SELECT l_orderkey, l_linenumber, l_partkey, round(CASE WHEN b > 0 THEN a / b ELSE 0.5 END, 6) AS dose FROM h"
)
def defuzzify(spark, d):
    degrees = {v: fuzzy.fuzzify(F.col(c), fuzzy.SETS[v]) for v, c in INPUTS.items()}
    fired = fuzzy.fire(degrees, RULES)
    s = {k: fired[("dose", k)] for k in OUT}
    return _inputs(spark, d).select("l_orderkey", "l_linenumber", "l_partkey", _r(fuzzy.centroid(s, OUT, 50)).alias("dose"))


@query("SELECT o_orderkey, CASE WHEN o_totalprice < 50000 AND o_orderstatus = 'F' THEN 'urgent' WHEN o_totalprice < 100000 THEN 'review' WHEN o_orderpriority LIKE '1%' THEN 'fast' ELSE 'normal' END AS action FROM orders")
def crisp_rules(spark, d):
    c = F.col
    return table(spark, d, "orders").select("o_orderkey", F.when((c("o_totalprice") < 50000) & (c("o_orderstatus") == "F"), "urgent").when(c("o_totalprice") < 100000, "review").when(c("o_orderpriority").like("1%"), "fast").otherwise("normal").alias("action"))
