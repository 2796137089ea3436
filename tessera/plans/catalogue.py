"""Queries of the catalogues: bounds, cross-field rules, derivations, engineered columns, names, ladders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import agronomy, features, graph, joins, leakage, profile, recommend, windows
from tessera.plans.registry import query
from tessera.plans.tables import observations, table

KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
MORE = {
    "Plant_Height_cm": (0, 60), "Harvest_Index": (0.1, 0.7), "Leaf_Number": (2, 100), "Tillers": (1, 50), "Fruit_Weight": (0.5, 2000), "Biomass_Yield": (0, 200000),
    "Leaf_Area_cm2": (0, 500), "Shoot_Biomass_g": (0, 80), "Root_Biomass_g": (0, 40), "Plot_Size": (0, 50), "Plant_Height_30_cm": (5, 60), "Plant_Height_60_cm": (10, 120),
    "Leaf_Area_30_cm2": (10, 200), "Leaf_Area_60_cm2": (20, 400), "Growth_Duration_Days": (60, 200),
}
#: Stand-ins of the schema's columns: (start, span, multiplier); a tenth of the span lies beyond each end
FIELDS = {c: (lo - 0.1 * (hi - lo), 1.2 * (hi - lo), 7 + 2 * i) for i, (c, (lo, hi)) in enumerate((agronomy.BOUNDS | MORE).items())}
FIELDS_SQL = "f AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, " + ", ".join(
    f'CASE WHEN (l_suppkey + {k}) % 11 <> 0 THEN {a!r}::DOUBLE + {b!r}::DOUBLE * (((l_partkey * {k} + l_linenumber) % 1000) / 1000.0::DOUBLE) END AS "{c}"' for c, (a, b, k) in FIELDS.items()
) + " FROM lineitem)"


def fields(spark, d, *names):
    li = table(spark, d, "lineitem")
    made = {c: F.when((F.col("l_suppkey") + k) % 11 != 0, F.lit(a) + F.lit(b) * (((F.col("l_partkey") * k + F.col("l_linenumber")) % 1000) / F.lit(1000.0))) for c, (a, b, k) in FIELDS.items() if not names or c in names}
    return li.select(*KEY, *[x.alias(c) for c, x in made.items()])


def _bounds_sql(bounds):
    one = lambda c, lo, hi: f"SELECT '{c}' AS column_name, {float(lo)!r}::DOUBLE AS low, {float(hi)!r}::DOUBLE AS high, count(\"{c}\") AS checked, count(*) FILTER (WHERE \"{c}\" < {lo} OR \"{c}\" > {hi}) AS violations FROM f"
    return f"WITH {FIELDS_SQL} " + " UNION ALL ".join(one(c, lo, hi) for c, (lo, hi) in bounds.items())


@query(_bounds_sql(agronomy.BOUNDS))
def hard_bounds(spark, d):
    """All 29 hard bounds in one pass."""
    return profile.range_checks(fields(spark, d), agronomy.BOUNDS)


@query(_bounds_sql(agronomy.BIOLOGICAL))
def biological_bounds(spark, d):
    """All 12 biological ranges in one pass."""
    return profile.range_checks(fields(spark, d), agronomy.BIOLOGICAL)


def _rule_sql(name, broken, severity="warning"):
    return f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '{name}' AS rule, '{severity}' AS severity FROM f WHERE {broken}"


@query(
    f"WITH {FIELDS_SQL} "
    + " UNION ALL ".join([
        _rule_sql("yield_biomass_ratio", '"Biomass_Yield" > 0 AND "Yield_per_Hectare" / "Biomass_Yield" NOT BETWEEN 0.1::DOUBLE AND 0.8::DOUBLE'),
        _rule_sql("temperature_consistency", '"Temperature_Max" < "Temperature_Min"', "error"),
        _rule_sql("height_leaf_area_correlation", '"Plant_Height_cm" < 5 AND "Leaf_Area_cm2" > 100'),
        _rule_sql("organic_matter_carbon_ratio", '"Organic_Carbon" > 0 AND "Organic_Matter" / "Organic_Carbon" NOT BETWEEN 1 AND 2.5::DOUBLE'),
        _rule_sql("fertilizer_rate_sanity", '"Nitrogen" > 300'),
        _rule_sql("harvest_index_plausibility", '"Harvest_Index" NOT BETWEEN 0.15::DOUBLE AND 0.65::DOUBLE'),
    ])
)
def agronomic_rules(spark, d):
    """Rows that break one of the six cross-field rules."""
    return profile.rule_violations(fields(spark, d), KEY, agronomy.cross_rules())


@query(f"""WITH {FIELDS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "Yield_per_Plot" * (10000 / nullif("Plot_Size", 0)) AS "Yield_per_Hectare",
    "Yield_per_Plot" * (4046.86::DOUBLE / nullif("Plot_Size", 0)) AS "Yield_per_Acre", "Organic_Carbon" * 1.724::DOUBLE AS "Organic_Matter", ("Plant_Height_30_cm" + "Plant_Height_60_cm") / 2 AS "Plant_Height_cm",
    "Shoot_Biomass_g" + "Root_Biomass_g" AS "Biomass_Yield", greatest("Leaf_Area_30_cm2", "Leaf_Area_60_cm2") AS "Leaf_Area_cm2",
    CASE WHEN "Average_Temperature" > 10 THEN "Average_Temperature" - 10 WHEN "Average_Temperature" <= 10 THEN 0 END * "Growth_Duration_Days" AS "Growing_Degree_Days",
    "Yield_per_Plot" * "Plot_Size" AS "Yield_per_Plant", "Average_Temperature" * "Rainfall" AS "Temp_x_Rainfall", "Nitrogen" * "Phosphorus" AS "N_x_P" FROM f""")
def derived_fields(spark, d):
    """The targets of the twelve derivations that a table of sources lacks."""
    sources = ["Yield_per_Plot", "Plot_Size", "Organic_Carbon", "Plant_Height_30_cm", "Plant_Height_60_cm", "Shoot_Biomass_g", "Root_Biomass_g", "Leaf_Area_30_cm2", "Leaf_Area_60_cm2", "Average_Temperature", "Growth_Duration_Days", "Rainfall", "Nitrogen", "Phosphorus"]
    df = fields(spark, d, *sources)
    out = features.derive(df, agronomy.derivations())
    return out.select(*KEY, *[c for c in out.columns if c not in df.columns])


def _engineered_sql():
    col = lambda p: f'"{agronomy.SHORT[p]}"'
    total = lambda t: "(" + " + ".join(col(p) for p in (list(t) if t in ("NPK", "NP", "NK", "PK") else t.split("+"))) + ")"
    out = [f'round(ln(1 + CASE WHEN {col(n)} < 0 THEN 0 ELSE {col(n)} END), 6) AS "{n}_log"' for n in agronomy.LOGS]
    out += [f'sqrt(CASE WHEN {col(n)} < 0 THEN 0 ELSE {col(n)} END) AS "{n}_sqrt"' for n in agronomy.ROOTS]
    out += [f'{col(n)} * {col(n)} AS "{n}_squared"' for n in agronomy.SQUARES]
    out += [" * ".join(total(p) for p in n.split("_x_")) + f' AS "{n}"' for n in agronomy.PRODUCTS]
    out += [f'{total(t)} AS "{n}"' for n, t in agronomy.SUMS.items()]
    out += [f'{total(a)} / nullif({total(b)}, 0) AS "{n}"' for n, (a, b) in agronomy.RATIOS.items()]
    return f"WITH {FIELDS_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(out)} FROM f"


@query(_engineered_sql())
def engineered_features(spark, d):
    """Logarithms, roots, squares, products, sums and ratios of the whole catalogue."""
    df = fields(spark, d)
    return df.select(*KEY, *[(F.round(x, 6) if c.endswith("_log") else x).alias(c) for c, x in agronomy.engineered(df).items()])


NAMES = {
    "Yield_x_N": True, "Predicted_Yield": True, "Yield_per_Hectare_1": True, "Plant_Height_30_cm": True, "Height_x_N": True, "Spacing_Plant": False, "Nitrogen": False, "Soil_pH": False,
    "Biomass_log": True, "N_Uptake_kg_ha": True, "Nitrogen_Use_Efficiency": True, "Harvest_Index": True, "HI_log": True, "FruitWeight_log": True, "Rainfall_log": False, "Crop_Code": False,
    "Zinc_Uptake": True, "Rainfall_x_pH": False,
}


@query("SELECT * FROM (VALUES " + ", ".join(f"('{n}', {str(v).lower()}, '{'NON_FEATURE' if n == 'Crop_Code' else 'POST_HARVEST_OR_DERIVED' if v else 'PRE_HARVEST_MEASUREMENT' if n == 'Soil_pH' else 'AVAILABLE_BEFORE_PREDICTION'}')" for n, v in NAMES.items()) + ") t(column_name, leaky, availability)")
def leaky_columns(spark, d):
    """Names judged for the target Plant_Height_cm."""
    return leakage.judged(spark, list(NAMES), "Plant_Height_cm", before_harvest=["Soil_pH"])


@query("WITH t AS (SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN ' Control plot' WHEN 1 THEN 'T0†' WHEN 2 THEN 'NPK 60' WHEN 3 THEN 'Check*' WHEN 4 THEN p_name END AS treatment FROM part) SELECT p_partkey, coalesce(regexp_matches(replace(replace(replace(lower(treatment), '†', ''), '‡', ''), '*', ''), 'control|ctrl|check|ck|t0|untreated|unfertilized|water_only|blank'), false) AS is_control FROM t")
def control_treatments(spark, d):
    n = F.col("p_partkey") % 6
    name = F.when(n == 0, " Control plot").when(n == 1, "T0†").when(n == 2, "NPK 60").when(n == 3, "Check*").when(n == 4, F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", agronomy.is_control(name).alias("is_control"))


@query(f"""WITH {FIELDS_SQL}, s AS (SELECT *, "Nitrogen" * 0.2::DOUBLE AS n, "Phosphorus" * 0.1::DOUBLE AS p, "Potassium" * 0.5::DOUBLE AS k, "Organic_Carbon" * 0.02::DOUBLE AS oc, "Zinc" * 0.01::DOUBLE AS zn FROM f)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN n < 50 THEN 'Urea (Nitrogen-rich)' WHEN p < 15 THEN 'DAP (Phosphorus-rich)' WHEN k < 100 THEN 'MOP (Potassium-rich)' WHEN n > 150 THEN 'SSP (Low nitrogen)'
    WHEN "Soil_pH" < 5.5 THEN 'Dolomite + Bio NPK' WHEN "Soil_pH" > 8 THEN 'Ammonium Sulphate + Gypsum' WHEN oc < 0.4::DOUBLE THEN 'Compost + Vermicompost' WHEN zn < 0.5 THEN 'Zinc Sulphate + Balanced NPK' ELSE 'Balanced NPK (15-15-15)' END AS advice,
    CASE WHEN "Rainfall" > 1000 THEN 'Split application (3-4 splits)' WHEN "Rainfall" < 500 THEN 'Every 15-20 days' ELSE 'Every 25-30 days' END AS days FROM s""")
def nutrient_advice(spark, d):
    """The nutrient ladder on concentrations scaled to its range."""
    c = F.col
    rungs = agronomy.advice(c("Nitrogen") * 0.2, c("Phosphorus") * 0.1, c("Potassium") * 0.5, c("Soil_pH"), c("Organic_Carbon") * 0.02, c("Zinc") * 0.01)
    return fields(spark, d).select(*KEY, rungs.alias("advice"), agronomy.interval(c("Rainfall")).alias("days"))


@query("""WITH o AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_quantity, 7.0) AS dose, CASE WHEN l_partkey % 3 = 0 THEN (l_suppkey % 20)::DOUBLE END AS days,
    CASE WHEN l_partkey % 4 <> 0 THEN l_discount * 10 END AS n, CASE WHEN l_suppkey % 4 <> 0 THEN l_tax * 10 END AS k FROM lineitem),
    a AS (SELECT *, coalesce(n, 0.5) AS nn, coalesce(k, 0.5) AS kk FROM o) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(dose * (0.5::DOUBLE + (nn * 0.4::DOUBLE + kk * 0.2::DOUBLE + 0.5::DOUBLE * 0.4::DOUBLE)), 6) AS dose,
    round(CASE WHEN days <> 0 THEN days * (2 - kk) ELSE 7 + (1 - kk) * 14 END, 6) AS days, CASE WHEN nn > 0.6::DOUBLE THEN 'Urea (Fuzzy)' END AS fertilizer,
    round((coalesce(n, 0) + coalesce(k, 0)) / nullif((n IS NOT NULL)::INT + (k IS NOT NULL)::INT, 0), 6) AS inferred FROM a""")
def fuzzy_adjustments(spark, d):
    """Crisp outputs applied to dose and interval, and an input inferred as the mean of those that are there."""
    n, k = F.when(F.col("l_partkey") % 4 != 0, F.col("l_discount") * 10), F.when(F.col("l_suppkey") % 4 != 0, F.col("l_tax") * 10)
    days = F.when(F.col("l_partkey") % 3 == 0, (F.col("l_suppkey") % 20).cast("double"))
    out = agronomy.adjusted(F.nullif("l_quantity", F.lit(7.0)), days, n, k, k, F.lit(0.5))
    return table(spark, d, "lineitem").select(*KEY, F.round(out["dose"], 6).alias("dose"), F.round(out["days"], 6).alias("days"), out["fertilizer"].alias("fertilizer"), F.round(agronomy.row_mean([n, k]), 6).alias("inferred"))


GROUPS = {
    "crop": ["Plant_Height_cm", "Tillers"], "location": ["Plot_Size"], "soil": ["Soil_pH", "Organic_Carbon", "Nitrogen", "Phosphorus", "Potassium"],
    "climate": ["Rainfall", "Temperature_Max", "Temperature_Min"], "management": ["Growth_Duration_Days"], "yield": ["Yield_per_Hectare"],
}
_SCORE = "(" + " + ".join("(" + " + ".join(f'("{c}" IS NOT NULL)::INT' for c in cs) + f") / {len(cs)}.0::DOUBLE" for cs in GROUPS.values()) + ") / 6.0::DOUBLE"


@query(f"WITH {FIELDS_SQL}, s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_SCORE} AS v FROM f), e AS (SELECT min(v) AS lo, max(v) AS hi FROM s) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(v, 6) AS score, CASE WHEN v >= 0.8::DOUBLE THEN 'high' WHEN v >= 0.5 THEN 'medium' ELSE 'low' END AS tier, round(0.5 + 0.5 * (v - lo) / (hi - lo + 1e-6), 6) AS weight FROM s, e")
def row_tiers(spark, d):
    """Mean of six completeness scores, its tier and the sample weight."""
    df = fields(spark, d).withColumn("v", features.quality_score(GROUPS))
    return agronomy.sample_weights(df, "v").select(*KEY, F.round("v", 6).alias("score"), agronomy.tier(F.col("v")).alias("tier"), F.round("weight", 6).alias("weight"))


_TESTS = {"doi": "p_partkey % 2 = 0", "title": "length(p_name) > 15", "year": "p_size > 10", "journal": "p_partkey % 3 = 0", "authors": "p_size % 2 = 0", "abstract": "p_retailprice > 1000", "pdf": "p_partkey % 5 = 0", "references": "p_size > 25", "design_signal": "p_partkey % 7 = 0", "verified_doi": "p_partkey % 4 = 0"}


@query("SELECT p_partkey, (" + " + ".join(f"({_TESTS[k]})::INT * {n}" for k, n in agronomy.POINTS.items()) + ")::INT AS points, round(least(" + " + ".join(f"(CASE WHEN {_TESTS[k]} THEN {w!r}::DOUBLE ELSE 0 END)" for k, w in agronomy.WEIGHTS.items()) + ", 1.0::DOUBLE), 4) AS quality FROM part")
def literature_points(spark, d):
    """All tests of a literature record: points to 13, quality to 1."""
    points, quality = agronomy.completeness({k: F.expr(x) for k, x in _TESTS.items()})
    return table(spark, d, "part").select("p_partkey", points.alias("points"), quality.alias("quality"))


@query("WITH o AS (SELECT CASE WHEN l_suppkey % 3 <> 0 THEN l_returnflag END AS crop, l_linestatus AS soil FROM lineitem) SELECT crop, soil, count(*) AS rows FROM o WHERE crop IS NOT NULL AND soil IS NOT NULL GROUP BY 1, 2")
def experiments(spark, d):
    return agronomy.experiment_groups(observations(spark, d), ["crop", "soil", "season"])


@query(f"WITH {FIELDS_SQL}, p AS (SELECT \"Yield_per_Plot\", \"SPAD\" FROM f) SELECT 'Yield_per_Plot' AS target, count(\"Yield_per_Plot\") AS n FROM p")
def training_target(spark, d):
    """The first candidate with enough values; the one asked for is not there."""
    df = fields(spark, d, "Yield_per_Plot", "SPAD")
    name = agronomy.target_column(df, "Marketable_Yield")
    return df.agg(F.lit(name).alias("target"), F.count(name).alias("n"))


@query("""WITH t AS (SELECT nullif(l_quantity, 7.0) AS q, l_extendedprice AS price, CASE WHEN l_partkey % 5 <> 0 THEN l_tax END AS tax, l_returnflag AS flag FROM lineitem)
    SELECT 'missing' AS "check", 'tax' AS column_name, round(avg((tax IS NULL)::INT), 6) AS value FROM t HAVING avg((tax IS NULL)::INT) > 0.1
    UNION ALL SELECT 'text', 'flag', 1 UNION ALL SELECT 'collinear', 'q~twice', 1 UNION ALL SELECT 'skewed_target', 'price', round(skewness(price), 6) FROM t HAVING abs(skewness(price)) > 2""")
def training_checks(spark, d):
    """What keeps a table from training: missing shares, text, collinear pairs, a skewed target."""
    t = table(spark, d, "lineitem").select(F.nullif("l_quantity", F.lit(7.0)).alias("q"), F.col("l_extendedprice").alias("price"), F.when(F.col("l_partkey") % 5 != 0, F.col("l_tax")).alias("tax"), F.col("l_returnflag").alias("flag"))
    return agronomy.readiness(t.withColumn("twice", F.col("q") * 2), "price").select("check", "column_name", F.round("value", 6).alias("value"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type = 'purchase') >= 3 AND count(*) FILTER (WHERE value > 50) >= 5 AS due FROM events GROUP BY 1")
def retrain_gate(spark, d):
    verified, new = F.count_if(F.col("event_type") == "purchase"), F.count_if(F.col("value") > 50)
    return table(spark, d, "events").groupBy("user_id").agg(agronomy.retrain_due(verified, new, 3, 5).alias("due"))


@query(f"""WITH {FIELDS_SQL}, v AS (SELECT count(*) FILTER (WHERE "Soil_pH" < 0 OR "Soil_pH" > 14) AS a, count(*) FILTER (WHERE "Nitrogen" < 0 OR "Nitrogen" > 1000) AS b, count(*) FILTER (WHERE "Rainfall" IS NULL) AS c, count(*) AS n FROM f),
    r AS (SELECT 'range' AS "check", 'soil ph' AS column_name, a AS failures FROM v UNION ALL SELECT 'range', 'N applied', b FROM v UNION ALL SELECT 'required', 'Rainfall', c FROM v UNION ALL SELECT 'required', 'DOI', n FROM v UNION ALL SELECT 'required', 'l_orderkey', 0 FROM v UNION ALL SELECT 'all', '', a + b + c + n FROM v)
    SELECT *, failures = 0 AS passed FROM r""")
def validation_bundle(spark, d):
    """Ranges of columns found by their letters or as named, required columns, and the roll-up."""
    df = fields(spark, d, "Soil_pH", "Nitrogen", "Rainfall").withColumnsRenamed({"Soil_pH": "soil ph", "Nitrogen": "N applied"})
    bounds = {k: agronomy.BOUNDS[k] for k in ("Soil_pH", "Nitrogen", "Zinc")}
    return agronomy.validation(df, bounds, ["Rainfall", "DOI", "l_orderkey"], {"Nitrogen": "N applied"})


@query("SELECT * FROM (VALUES ('plantheight30cm', 'Plant_Height_30_cm'), ('leaf_area_60_cm2', 'Leaf_Area_60_cm2'), ('yieldplot_90_g', 'Yield_per_Plot'), ('fruitweight120g', 'Fruit_Weight'), ('fruitdiameter 90 mm', 'Fruit_Diameter_mm'), ('branches30', 'Branches'), ('flowers_60', 'Flowers'), ('soilph', NULL)) t(given, name)")
def positional_names(spark, d):
    given = ["plantheight30cm", "leaf_area_60_cm2", "yieldplot_90_g", "fruitweight120g", "fruitdiameter 90 mm", "branches30", "flowers_60", "soilph"]
    return spark.createDataFrame([(g, agronomy.positional_name(g)) for g in given], "given string, name string")


@query("SELECT 0.6833::DOUBLE AS extraction, 0.7::DOUBLE AS model, 0.6::DOUBLE AS recommendation, 0.6667::DOUBLE AS agent, 0.6611::DOUBLE AS pipeline, 0.7093::DOUBLE AS overall")
def run_health(spark, d):
    """Means of means of a run: extraction .8 .65 .6, model r2 .8 rmse .4 mae .3, recommendation .5 .6 .7, agents 1 0 1, completeness .8."""
    h = agronomy.health([0.8, 0.65, 0.6], [0.8, 0.4, 0.3], [0.5, 0.6, 0.7], [1, 0, 1], 0.8)
    return spark.createDataFrame([tuple(h[k] for k in ("extraction", "model", "recommendation", "agent", "pipeline", "overall"))], "extraction double, model double, recommendation double, agent double, pipeline double, overall double")


@query("WITH s AS (SELECT user_id, lower(event_type) AS kind, min((ts, event_id)) AS first FROM events GROUP BY 1, 2) SELECT user_id, list(kind ORDER BY first) AS kinds FROM s GROUP BY 1")
def ordered_lists(spark, d):
    """Distinct kinds of a user, case folded, in the order of their first event; only first events are gathered."""
    firsts = table(spark, d, "events").groupBy("user_id", F.lower("event_type").alias("kind")).agg(F.min(F.struct("ts", "event_id")).alias("first"))
    return firsts.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "kind"))), lambda s: s["kind"]).alias("kinds"))


@query("SELECT 'customer:' || o_custkey AS src, 'order:' || o_orderkey AS dst, 'places' AS kind FROM orders")
def graph_json(spark, d):
    """Edges written as JSON documents and read back."""
    edges = table(spark, d, "orders").select(F.concat(F.lit("customer:"), "o_custkey").alias("src"), F.concat(F.lit("order:"), "o_orderkey").alias("dst"), F.lit("places").alias("kind"))
    return graph.from_json(graph.to_json(edges), "src string, dst string, kind string")


_ROWS = "OVER (PARTITION BY l_suppkey ORDER BY l_orderkey, l_linenumber, l_partkey ROWS 6 PRECEDING)"


@query(f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(avg(l_quantity) {_ROWS}, 6) AS quantity_avg, round(avg(l_extendedprice) {_ROWS}, 4) AS price_avg, round(avg(l_discount) {_ROWS}, 8) AS discount_avg, round(avg(l_tax) {_ROWS}, 8) AS tax_avg FROM lineitem")
def moving_averages(spark, d):
    """Seven-row means of four columns in the order of each supplier's rows."""
    df = table(spark, d, "lineitem")
    for c, name in (("l_quantity", "quantity_avg"), ("l_extendedprice", "price_avg"), ("l_discount", "discount_avg"), ("l_tax", "tax_avg")):
        df = windows.moving_average(df, c, ["l_suppkey"], ["l_orderkey", "l_linenumber", "l_partkey"], name=name)
    return df.select(*KEY, F.round("quantity_avg", 6).alias("quantity_avg"), F.round("price_avg", 4).alias("price_avg"), F.round("discount_avg", 8).alias("discount_avg"), F.round("tax_avg", 8).alias("tax_avg"))


CONFIDENCE = {"scientific": 0.20, "retrieval": 0.15, "extraction": 0.20, "study_quality": 0.20, "meta_weight": 0.10, "observation_completeness": 0.10, "provenance_completeness": 0.05}
_PARTS = {"scientific": "value / 500", "retrieval": "user_id % 10 / 10.0", "extraction": "event_id % 4 / 4.0", "study_quality": "user_id % 7 / 7.0", "meta_weight": "event_id % 9 / 9.0", "observation_completeness": "user_id % 3 / 3.0", "provenance_completeness": "event_id % 5 / 5.0"}


@query("SELECT event_id, round(" + " + ".join(f"{w!r}::DOUBLE * ({_PARTS[k].replace('.0', '.0::DOUBLE')})" for k, w in CONFIDENCE.items()) + ", 6) AS confidence FROM events")
def blended_confidence(spark, d):
    """The verified confidence of all seven weights."""
    e = table(spark, d, "events").select("event_id", *[F.expr(x.replace(".0", "D")).alias(k) for k, x in _PARTS.items()])
    return e.select("event_id", F.round(recommend.weighted(CONFIDENCE), 6).alias("confidence"))


@query("""WITH z AS (SELECT round(c_custkey % 40 / 2.0) AS y, round(c_custkey % 30 / 2.0) AS x, avg(c_acctbal) AS balance FROM customer GROUP BY 1, 2),
    k AS (SELECT lower(s_name) AS crop, avg(s_acctbal) AS supply FROM supplier GROUP BY 1)
    SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_retailprice ELSE z.balance END AS balance, k.supply AS supply, NULL::BIGINT AS n_regionkey FROM part
    LEFT JOIN z ON z.y = p_partkey % 20 AND z.x = p_partkey % 15 LEFT JOIN k ON k.crop = 'supplier#' || lpad((p_partkey % 10)::VARCHAR, 9, '0')""".replace("round(c_custkey % 40 / 2.0)", "round_even(c_custkey % 40 / 2.0, 0)").replace("round(c_custkey % 30 / 2.0)", "round_even(c_custkey % 30 / 2.0, 0)"))
def enriched_rows(spark, d):
    """Three packages in turn: one by place, one by crop, one without a key in common."""
    part = table(spark, d, "part").select("p_partkey", (F.col("p_partkey") % 20).cast("double").alias("latitude"), (F.col("p_partkey") % 15).cast("double").alias("longitude"), F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") % 10).cast("string"), 9, "0")).alias("crop"), F.when(F.col("p_partkey") % 4 == 0, F.col("p_retailprice")).alias("balance"))
    by_place = table(spark, d, "customer").select((F.col("c_custkey") % 40 / 2.0).alias("lat"), (F.col("c_custkey") % 30 / 2.0).alias("lon"), F.col("c_acctbal").alias("balance"))
    by_crop = table(spark, d, "supplier").select(F.col("s_name").alias("crop"), F.col("s_acctbal").alias("supply"))
    other = table(spark, d, "nation").select(F.col("n_regionkey").cast("bigint").alias("n_regionkey"))
    return joins.enrich(part, [by_place, by_crop, other]).select("p_partkey", "balance", "supply", "n_regionkey")
