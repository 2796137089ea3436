"""Queries: table and record scores, targets, reranked evidence, searches, package graphs, rule bases, table columns."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tessera.functions import literature, tables
from tessera.functions import text as X
from tessera.operators import evaluation, fuzzy, incremental, retrieval
from tessera.plans.catalogue import FIELDS, FIELDS_SQL, KEY, fields
from tessera.plans.featuring import _IN, _MU, INPUTS, _inputs
from tessera.plans.registry import query
from tessera.plans.tables import table

_KEYS = "l_orderkey, l_linenumber, l_partkey, l_suppkey"


def _null(c):
    return f'("{c}" IS NULL)::INT'


@query(f"""WITH {FIELDS_SQL}, g AS (SELECT sum({" + ".join(_null(c) for c in FIELDS)}) / (count(*) * {len(FIELDS) + 4}.0::DOUBLE) AS gap FROM f),
    p AS (SELECT round(20.0::DOUBLE * {len({"Nitrogen", "Phosphorus"})} / 3, 4) AS schema_points, 8.0::DOUBLE AS ontology_points, round(15.0::DOUBLE * {sum(c in FIELDS for c in evaluation.ENGINEERED)} / 9, 4) AS feature_points,
    round((1 - gap) * 15, 4) AS missing_points, 4.0::DOUBLE AS document_points, round((1 - ((gap > 0.1::DOUBLE)::INT + 1) / 5.0::DOUBLE) * 15, 4) AS learning_points,
    round(15.0::DOUBLE * {sum(q(c in FIELDS for c in cs) for cs, q in evaluation.REPRODUCIBLE)} / 6, 4) AS repeat_points FROM g)
    SELECT *, round(schema_points + ontology_points + feature_points + missing_points + document_points + learning_points + repeat_points, 2) AS total FROM p""")
def quality_points(spark, d):
    """All seven parts of the 100 points of a table."""
    out = evaluation.quality_points(fields(spark, d), ["Nitrogen", "Phosphorus", "Not_There"], 0.8, 0.4)
    return out.withColumn("total", F.round("total", 2))


@query(f"""WITH {FIELDS_SQL}, r AS (SELECT (count("Nitrogen") + count("Phosphorus") + count("Potassium")) / (3.0::DOUBLE * count(*)) AS rate FROM f)
    SELECT round(rate, 4) AS population_rate, round(1 - rate, 4) AS missing_values, round(rate, 4) AS completeness, round(least(1, rate * 0.8::DOUBLE + rate * 0.2::DOUBLE), 4) AS usability_score FROM r""")
def reckoner_metrics(spark, d):
    """Those of the six key columns that are there."""
    return evaluation.reckoner_metrics(fields(spark, d))


_METRICS = {"extraction_accuracy": "avg((l_tax < 0.09)::INT)", "missing_data_rate": "avg((l_suppkey % 11 = 0)::INT)", "feature_coverage": "avg((l_discount > 0)::INT)", "pipeline_success_rate": "avg((l_quantity > 0)::INT)"}


@query("WITH m AS (SELECT " + ", ".join(f"{x} AS {k}" for k, x in _METRICS.items()) + " FROM lineitem) " + " UNION ALL ".join(
    f"SELECT '{k}' AS metric, round({k if k in _METRICS else '0'}::DOUBLE, 4) AS actual, {t}::DOUBLE AS target, {k if k in _METRICS else '0'} {s} {t}::DOUBLE AS passed FROM m" for k, (s, t) in evaluation.TARGETS.items()))
def target_checks(spark, d):
    """All eight targets; the metrics that were not taken are 0."""
    share = {"extraction_accuracy": "l_tax < 0.09D", "missing_data_rate": "l_suppkey % 11 = 0", "feature_coverage": "l_discount > 0", "pipeline_success_rate": "l_quantity > 0"}
    return evaluation.meets_targets(table(spark, d, "lineitem").agg(*[F.avg(F.expr(x).cast("int")).alias(k) for k, x in share.items()]))


_IMPORTANT = [c for c in evaluation.IMPORTANT if c in FIELDS]
_REPORTED = [c for c in evaluation.REPORTED if c in FIELDS]


@query(f"""WITH {FIELDS_SQL} SELECT {_KEYS}, round(({" + ".join(f'("{c}" IS NOT NULL)::INT' for c in _IMPORTANT)}) / 7.0::DOUBLE, 4) AS data_quality,
    list_filter([{", ".join(f"CASE WHEN {chr(34)}{c}{chr(34)} IS NULL THEN {chr(39)}{c}{chr(39)} END" for c in _REPORTED)}], lambda x: x IS NOT NULL) AS lacking FROM f""")
def explained_rows(spark, d):
    """Share of the seven important fields and the names of those reported that have no value."""
    df = fields(spark, d)
    return df.select(*KEY, evaluation.filled_share(df.columns).alias("data_quality"), evaluation.lacking(df.columns).alias("lacking"))


_STAT = ["Nitrogen", "Phosphorus", "Soil_pH", "Rainfall"]


@query(f"WITH {FIELDS_SQL} " + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count(\"{c}\") AS missing, round(skewness(\"{c}\"), 3) AS skew, round(kurtosis(\"{c}\"), 3) AS kurt FROM f" for c in _STAT))
def dataset_statistics(spark, d):
    """Missing values, corrected skewness and kurtosis in one pass."""
    return evaluation.statistics(fields(spark, d, *_STAT), _STAT)[0]


_PARTS = {c: f"((event_id * {k} + user_id) % 100) / 100.0" for k, c in enumerate(evaluation.RERANK, 3)}


@query(f"""WITH s AS (SELECT event_id, event_type, {" + ".join(f"{w!r}::DOUBLE * (({x})::DOUBLE)" for (c, x), w in zip(_PARTS.items(), evaluation.RERANK.values()))} AS score FROM events),
    r AS (SELECT event_id, event_type, round(score, 6) AS rerank_score, row_number() OVER (PARTITION BY event_type ORDER BY round(score, 9) DESC, event_id) AS rank FROM s)
    SELECT event_id, event_type, rerank_score, rank::INT AS rank FROM r WHERE rank <= 10""")
def reranked_evidence(spark, d):
    """The ten best candidates of each query by all twelve weights; scores equal to nine places are ties."""
    e = table(spark, d, "events").select("event_id", "event_type", *[F.expr(x.replace("100.0", "100D")).alias(c) for c, x in _PARTS.items()])
    return evaluation.reranked(e, 10, ["event_type"], "event_id").select("event_id", "event_type", F.round("rerank_score", 6).alias("rerank_score"), "rank")


@query("""SELECT 'crop' AS service, doc_id FROM documents WHERE lower(lang) = 'en' UNION ALL SELECT 'location', doc_id FROM documents WHERE lower(source) = (SELECT lower(min(source)) FROM documents)
    UNION ALL SELECT 'evidence', doc_id FROM documents WHERE contains(lower(text), 'the')""")
def typed_search(spark, d):
    """Two services with a field of their own and one over the whole text."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", "text")
    first = docs.agg(F.min("source")).first()[0]
    at = {"crop": "lang", "location": "source"}
    found = [evaluation.search(docs, s, t, at).select(F.lit(s).alias("service"), "doc_id") for s, t in (("crop", "EN"), ("location", first or ""), ("evidence", "The"))]
    return found[0].union(found[1]).union(found[2])


@query("""WITH p AS (SELECT s_suppkey::VARCHAR AS id, CASE WHEN s_nationkey % 3 <> 0 THEN 'n' || s_nationkey END AS source, 'r' || (s_nationkey % 5) AS provider, CASE WHEN s_acctbal > 0 THEN 1 END AS rows FROM supplier)
    SELECT 'Repository:' || coalesce(source, provider) AS src, 'PROVIDES' AS relation, 'Dataset:' || id AS dst FROM p UNION SELECT 'Dataset:' || id, 'CONTAINS', 'Document:' || id || '/0' FROM p
    UNION SELECT 'Document:' || id || '/0', 'FROM_SOURCE', 'Repository:' || coalesce(source, provider) FROM p UNION SELECT 'Document:' || id || '/0', 'SUPPORTED_BY', 'Evidence:' || id || '/stats' FROM p WHERE rows IS NOT NULL""")
def package_graph(spark, d):
    """The lineage that packages add to the graph, each edge once."""
    s = table(spark, d, "supplier")
    p = s.select(F.col("s_suppkey").cast("string").alias("dataset_id"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") % 3 != 0, F.concat(F.lit("n"), "s_nationkey")).alias("source"), F.concat(F.lit("r"), F.col("s_nationkey") % 5).alias("provider"), F.when(F.col("s_acctbal") > 0, 1).alias("rows"))
    return evaluation.package_graph(p)[1]


_WORDS = ["Rice", "corn and wheat", "red gram", "tea, COFFEE", "peanut", "rice-wheat system", "price"]
_STUDY = ["nitrogen and phosphate", "soil physical", "planting date of a variety", "N P K", "rainfall, compost", "biomass yield", "tenue"]


@query("""WITH t AS (SELECT p_partkey, (['Rice', 'corn and wheat', 'red gram', 'tea, COFFEE', 'peanut', 'rice-wheat system', 'price'])[p_partkey % 7 + 1] AS c FROM part)
    SELECT p_partkey, CASE c WHEN 'Rice' THEN ['Rice'] WHEN 'corn and wheat' THEN ['Wheat', 'Maize'] WHEN 'red gram' THEN ['Chickpea', 'Pigeon Pea'] WHEN 'tea, COFFEE' THEN ['Tea', 'Coffee']
    WHEN 'peanut' THEN ['Groundnut'] WHEN 'rice-wheat system' THEN ['Rice', 'Wheat', 'Rice-Wheat System'] ELSE [] END AS crops,
    ([['Nitrogen', 'Phosphorus'], ['Soil Properties'], ['Sowing Date', 'Cultivar Evaluation'], [], ['Weather Observations', 'Fertilizer Response'], ['Yield', 'Biomass'], ['Nutrient Use Efficiency']])[p_partkey % 7 + 1] AS variables FROM t""")
def study_labels(spark, d):
    """Crops and study variables of a text, all that match."""
    i = (F.col("p_partkey") % 7 + 1).cast("int")
    t = table(spark, d, "part").select("p_partkey", F.element_at(F.array(*map(F.lit, _WORDS)), i).alias("c"), F.element_at(F.array(*map(F.lit, _STUDY)), i).alias("v"))
    return t.select("p_partkey", X.labels(F.col("c"), literature.CROPS).alias("crops"), X.labels(F.col("v"), literature.VARIABLES).alias("variables"))


@query("""SELECT p_partkey, (CASE p_partkey % 4 WHEN 2 THEN 0 ELSE 1 END)::INT AS treatment, (CASE p_partkey % 4 WHEN 0 THEN 3 WHEN 1 THEN 3 WHEN 2 THEN 2 END)::INT AS yielding,
    CASE p_partkey % 4 WHEN 0 THEN [2] ELSE [] END::INT[] AS doses, CASE p_partkey % 4 WHEN 1 THEN 'caption describes an analysis' WHEN 2 THEN 'rows cite other studies' WHEN 3 THEN 'no usable column' END AS problem FROM part""")
def table_columns(spark, d):
    """Treatment, yield and dose columns of four shapes of a table, and why three are not credible."""
    words = lambda *ws: F.array(*map(F.lit, ws))
    k = F.col("p_partkey") % 4
    header = F.when(k < 2, words("Year", "Treatment", "N rate (kg/ha)", "Grain yield (t/ha)")).when(k == 2, words("Study", "Crop", "Yield (kg/ha)")).otherwise(words("Season", "Plot", "Height (cm)"))
    size = F.concat(F.col("p_size").cast("string"), F.lit(" kg urea"))
    body = F.array(F.array(F.when(k == 2, F.lit("farm one")).otherwise(F.lit("2019")), F.when(k == 2, F.lit("7")).otherwise(size), F.lit("4")), F.array(F.lit("2020"), F.when(k == 2, F.lit("8")).otherwise(F.lit("control")), F.lit("5")))
    caption = F.when(k == 1, "Regression of yields").otherwise("Results")
    t = table(spark, d, "part").select("p_partkey", header.alias("h"), body.alias("b"), caption.alias("c"))
    t = t.withColumns({"treatment": tables.treatment_column(F.col("h"), F.col("b")), "yielding": tables.yield_column(F.col("h"), F.col("c"))})
    doses = tables.dose_columns(F.array(F.lit(2), F.lit(3)), F.col("h"), F.col("yielding"))
    doses = F.when(F.col("c") == "Results", doses).otherwise(F.array().cast("array<int>"))
    return t.select("p_partkey", "treatment", "yielding", doses.alias("doses"), tables.problem(F.col("treatment"), F.col("yielding"), F.col("h"), F.col("c")).alias("problem"))


_NUTRIENT = lambda n, a, x=0: {"type": "nutrient", "nutrient": n, "action": a, "amount": x}
_BASE = [
    ({"Nitrogen": "low", "Rainfall": "high"}, [_NUTRIENT("Nitrogen", "increase", 20), {"type": "risk", "level": "high"}]), ({"Nitrogen": "medium"}, [_NUTRIENT("Nitrogen", "maintain"), {"type": "risk", "level": "low"}]),
    ({"Nitrogen": "high", "Soil_pH": "neutral"}, [_NUTRIENT("Nitrogen", "reduce", 15), {"type": "confidence", "level": "high"}]), ({"Soil_pH": "acidic"}, [_NUTRIENT("Nitrogen", "increase", 10), {"type": "confidence", "level": "low"}]),
]
_TEXT = json.dumps({"rules": [{"antecedents": [{"var": v, "set": s} for v, s in c.items()], "consequents": out} for c, out in _BASE]})
_S = ["least(" + ", ".join(f"{INPUTS[v]}_{s}" for v, s in c.items()) + ")" for c, _ in _BASE]


def _pick_sql(options):
    """Strongest of (rule, text, group): groups by their greatest strength, then by the rule that fires first; texts by strength, then rule."""
    rows = " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, l_partkey, rid, {i} AS i, '{t}' AS t, '{g}' AS g, s{i} AS s FROM f WHERE s{i} > 0" for i, t, g in options)
    return f"(SELECT rid, arg_min(t, (-m, first, -s, i)) AS t FROM (SELECT *, max(s) OVER (PARTITION BY rid, g) AS m, min(i) OVER (PARTITION BY rid, g) AS first FROM ({rows})) GROUP BY 1)"


_OPTIONS = {
    "action": [(i, fuzzy._action(c), c["action"]) for i, (_, out) in enumerate(_BASE) for c in out if c["type"] == "nutrient"],
    "risk": [(i, c["level"], c["level"]) for i, (_, out) in enumerate(_BASE) for c in out if c["type"] == "risk"],
    "confidence": [(i, c["level"], c["level"]) for i, (_, out) in enumerate(_BASE) for c in out if c["type"] == "confidence"],
}


@query(f"""WITH {_IN}, m AS (SELECT l_orderkey, l_linenumber, l_partkey, row_number() OVER () AS rid, {_MU} FROM i), f AS (SELECT l_orderkey, l_linenumber, l_partkey, rid, {", ".join(f"{e} AS s{i}" for i, e in enumerate(_S))} FROM m),
    a AS {_pick_sql(_OPTIONS["action"])}, r AS {_pick_sql(_OPTIONS["risk"])}, c AS {_pick_sql(_OPTIONS["confidence"])}
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(a.t, 'Maintain') AS action, coalesce(r.t, 'medium') AS risk, coalesce(c.t, 'medium') AS confidence FROM f LEFT JOIN a USING (rid) LEFT JOIN r USING (rid) LEFT JOIN c USING (rid)""")
def rule_base(spark, d):
    """A rule base read from its text: the action with its amount, risk and confidence of each row."""
    out = fuzzy.infer(_inputs(spark, d), {v: F.col(c) for v, c in INPUTS.items()}, fuzzy.rules_from(_TEXT))
    return out.select("l_orderkey", "l_linenumber", "l_partkey", F.col("Nitrogen_Action").alias("action"), F.col("Risk").alias("risk"), F.col("Confidence").alias("confidence"))


@query("SELECT b.item_id AS item_id, count(d.doc_id) AS mentions FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) AND length(b.text) > 0 GROUP BY 1")
def evidence_mentions_whole(spark, d):
    """Documents that hold the whole text of an item."""
    return retrieval.mentions(table(spark, d, "documents"), table(spark, d, "benchmark"), "item_id")


@query("SELECT event_type || ':' || user_id AS key, arg_max(props, (ts, event_id)) AS body, count(*) AS puts FROM events GROUP BY 1")
def raw_cache(spark, d):
    """The last body put under each key, and how often it was put."""
    e = table(spark, d, "events").select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("key"), "props", "ts", "event_id")
    return incremental.cached(e, ["key"], "props", ["ts", "event_id"])
