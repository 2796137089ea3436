"""Scores, searches, rule bases, table columns and mentions on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import literature, tables
from tessera.functions.text import labels
from tessera.operators import evaluation, fuzzy, incremental, retrieval


@pytest.mark.parametrize("bound", [1 << 20, 0])
def test_mentions_equal_substring_search(spark, bound):
    rng = random.Random(bound)
    text = lambda n: " ".join(rng.choice(["ab", "b", "", "cab", "é", "a"]) for _ in range(n))
    docs = [text(rng.randrange(0, 60)) for _ in range(80)] + [None, ""]
    docs += docs[:5]  # repeated rows count each
    items = [None, "", "a", "zz"] + [text(rng.randrange(1, 9)) for _ in range(30)]
    for d in docs[:20]:
        at = rng.randrange(len(d) + 1)
        items.append(d[at : at + rng.randrange(1, 40)])
    d = spark.createDataFrame([(i, t, "x") for i, t in enumerate(docs)], "doc_id int, text string, _needle string").repartition(3)
    q = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    got = {r.item_id: r.mentions for r in retrieval.mentions(d, q, "item_id", bound=bound).collect()}
    assert got == {i: sum(bool(t) and t in x for x in docs if x is not None) for i, t in enumerate(items)}
    assert [r.mentions for r in retrieval.mentions(d.limit(0), q.limit(3), "item_id", bound=bound).collect()] == [0, 0, 0]


def test_rule_base_by_rows(spark):
    base = {"rules": [
        {"antecedents": [{"var": "Nitrogen", "set": "low"}], "consequents": [{"type": "adjustment", "var": "Nitrogen_Adjustment", "set": "high"}, {"type": "nutrient", "nutrient": "Nitrogen", "action": "increase", "amount": 20}, {"type": "risk", "level": "high"}]},
        {"antecedents": [{"var": "Nitrogen", "set": "high"}, {"var": "Soil_pH", "set": "neutral"}], "consequents": [{"type": "nutrient", "nutrient": "Nitrogen", "action": "reduce", "amount": 10}, {"type": "confidence", "level": "high"}]},
        {"antecedents": [{"var": "Zinc", "set": "low"}], "consequents": [{"type": "nutrient", "nutrient": "Zinc", "action": "apply_foliar_spray"}]},
        {"antecedents": [], "consequents": [{"type": "risk", "level": "low"}]},
    ]}
    df = spark.createDataFrame([(20.0, 7.0), (130.0, 7.0), (None, None)], "n double, ph double")
    rules = fuzzy.rules_from(base)
    assert len(rules) == 3 and fuzzy.rules_from("rules: []") == [] and fuzzy.rules_from('{"rules": []}') == []
    rows = fuzzy.infer(df, {"Nitrogen": F.col("n"), "Soil_pH": F.col("ph")}, rules).collect()
    assert [r.Nitrogen_Action for r in rows] == ["Increase by 20%", "Reduce by 10%", "Maintain"] and {r.Zinc_Action for r in rows} == {"Maintain"}
    assert [r.Risk for r in rows] == ["high", "medium", "medium"] and [r.Confidence for r in rows] == ["medium", "high", "medium"]
    assert rows[0].Nitrogen_Adjustment > 0.8 and rows[1].Nitrogen_Adjustment is None and rows[0].Summary.startswith("Nitrogen: increase by 20% | risk: high")
    assert fuzzy.infer(df, {"Nitrogen": F.col("n")}, []).first().Summary == "all nutrients optimal: keep the schedule | risk: medium | confidence: medium"


def test_of_equal_actions_the_first_that_fires(spark):
    n = lambda v, s, a, x: {"antecedents": [{"var": v, "set": s}], "consequents": [{"type": "nutrient", "nutrient": "Nitrogen", "action": a, "amount": x}]}
    rules = fuzzy.rules_from({"rules": [n("Phosphorus", "low", "reduce", 5), n("Potassium", "low", "increase", 7), n("Nitrogen", "low", "increase", 9), n("Nitrogen", "low", "reduce", 11)]})
    df = spark.createDataFrame([(10.0, 15.0, 500.0), (10.0, 500.0, 100.0), (10.0, 500.0, 500.0)], "n double, p double, k double")
    got = fuzzy.infer(df, {"Nitrogen": F.col("n"), "Phosphorus": F.col("p"), "Potassium": F.col("k")}, rules).collect()
    assert [r.Nitrogen_Action for r in got] == ["Reduce by 11%", "Increase by 9%", "Increase by 9%"]


def test_columns_of_a_table(spark):
    ask = lambda head, body, caption, proposed=(): spark.createDataFrame([(head, body, caption, list(proposed))], "h array<string>, b array<array<string>>, c string, p array<int>").select(
        tables.treatment_column(F.col("h"), F.col("b")).alias("t"), tables.yield_column(F.col("h"), F.col("c")).alias("y")).first()
    assert ask(["Year", "Label", "Yield"], [["2019", "T1 urea", "4"], ["2020", "control", "5"]], "") == (1, 2)
    assert ask(["Yield", "Grain yield (kg/ha)"], [], None) == (0, 1)
    assert ask([], [], None) == (0, None)
    assert ask(["a", None], [[None, "LSD"], ["N2 (300 kg/ha)"]], "Yield") == (0, None)
    why = lambda t, y, h, c, u=None: spark.range(1).select(tables.problem(F.lit(t), F.lit(y), F.array(*map(F.lit, h)).cast("array<string>"), F.lit(c), F.lit(u)).alias("x")).first().x
    assert why(0, 1, ["T", "Yield (t/ha)"], "Results") is None and why(0, 1, ["T", "Yield"], "Results") == "no area unit" and why(0, 1, ["T", "Yield"], "Results", "kg/ha") is None
    assert why(None, 1, ["T"], "") == "no usable column" and why(0, 4, ["T"], "") == "yield column outside the header" and why(0, 1, ["T", "N rate (kg/ha)"], "Yield") == "column does not name a yield"
    assert why(0, 1, ["T", "Yield (t/ha)"], "Fitted curves") == "caption describes an analysis" and why(0, 1, ["T", "Yield (t/ha)"], "Fitted yield") is None
    keep = spark.range(1).select(tables.dose_columns(F.array(*map(F.lit, [-1, 0, 1, 2, 9])), F.array(*map(F.lit, ["N applied (kg/ha)", "Cost level", "Yield level (kg/ha)"])), F.lit(None).cast("int")).alias("k")).first().k
    assert keep == [0]


def test_scores_of_empty_tables_and_missing_fields(spark):
    df = spark.createDataFrame([], "Crop string, Nitrogen double")
    assert evaluation.reckoner_metrics(df).first().population_rate == 0.0 and evaluation.reckoner_metrics(df.drop("Crop", "Nitrogen").withColumn("x", F.lit(1))).first().usability_score == 0.0
    points = evaluation.quality_points(df, ["Crop", "Nitrogen"]).first()
    assert (points.schema_points, points.missing_points, points.total) == (20.0, 0.0, 20.0 + 6.0 + 2.5)
    assert {r.metric: r.passed for r in evaluation.meets_targets(spark.range(1)).collect()} == {k: k == "missing_data_rate" for k in evaluation.TARGETS}
    row = spark.createDataFrame([(None, 1.0)], "Crop string, Nitrogen double")
    assert tuple(row.select(evaluation.filled_share(row.columns), evaluation.lacking(row.columns)).first()) == (0.1429, ["Crop"])
    assert spark.range(1).select(evaluation.lacking([]).alias("x")).first().x == []
    shapes, pairs = evaluation.statistics(spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, None)], "a double, b double"), ["a", "b"])
    assert [tuple(r) for r in shapes.collect()] == [("a", 1, None, None), ("b", 1, None, None)] and pairs.first().r == pytest.approx(1.0)


def test_search_graph_cache_and_labels(spark):
    chunks = spark.createDataFrame([(1, "Rice", "Soil of rice"), (2, None, None), (3, "wheat", "")], "chunk_id int, crop string, text string")
    assert [r.chunk_id for r in evaluation.search(chunks, "crop", "RICE", {"crop": "crop"}).collect()] == [1]
    assert [r.chunk_id for r in evaluation.search(chunks, "soil", "soil", {}).collect()] == [1]
    with pytest.raises(ValueError):
        evaluation.search(chunks, "weather", "x", {})
    best = evaluation.reranked(chunks.withColumn("study_quality", F.col("chunk_id") / 3), 2)
    assert [r.chunk_id for r in best.collect()] == [3, 2]
    p = spark.createDataFrame([("d", "n", None, "p", None), ("d", "n", None, "p", None), ("e", None, "s", None, 3)], "dataset_id string, name string, source string, provider string, rows int")
    nodes, edges = evaluation.package_graph(p)
    assert nodes.count() == 7 and edges.count() == 7 and edges.filter("relation = 'SUPPORTED_BY'").first().src == "Document:e/0"
    puts = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", None)], "k string, v string, n int")
    assert sorted(map(tuple, incremental.cached(puts, ["k"], "v", ["n"]).collect())) == [("a", None, 2), ("b", "y", 1)]
    assert spark.range(1).select(labels(F.lit("Rice-wheat and TEA"), literature.CROPS).alias("x")).first().x == ["Rice", "Wheat", "Tea", "Rice-Wheat System"]
