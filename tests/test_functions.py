"""Column functions on inline vectors, nulls and ties included."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.functions import text as X
from tessera.operators import fuzzy, recommend


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


def test_numbers(spark):
    rows = [("1.5",), ("x",), (None,), ("NaN",), ("",)]
    assert values(spark, N.to_number(F.col("s")), rows, "s string") == [1.5, None, None, None, None]
    assert values(spark, N.bin_key(F.col("x"), 1.0), [(0.5,), (1.5,), (2.5,), (-0.5,), (None,)], "x double") == [0, 2, 2, 0, None]
    assert values(spark, N.finite(F.col("x")), [(1.0,), (float("inf"),), (float("nan"),), (None,)], "x double") == [1.0, None, None, None]


def test_cuts(spark):
    rows = [(0.0,), (200.0,), (201.0,), (10001.0,), (None,)]
    assert values(spark, N.cut_right(F.col("x"), [0, 200, 500, 10000]), rows, "x double") == [None, 0, 1, None, None]
    assert values(spark, N.cut_left(F.col("x"), [0, 200, 500, 10000]), rows, "x double") == [0, 1, 1, None, None]
    five = values(spark, N.cut_equal(F.col("x"), F.lit(0.0), F.lit(10.0), 5), [(0.0,), (2.0,), (2.1,), (10.0,), (None,)], "x double")
    assert five == [0, 0, 1, 4, None]


def test_shapes_and_means(spark):
    rows = [(45.0,), (None,)]
    assert values(spark, N.shoulder_low(F.col("x"), 30, 60), rows, "x double") == [pytest.approx(0.5), None]
    assert values(spark, fuzzy.membership(F.col("x"), "low", 30, 60), rows, "x double") == [pytest.approx(0.5), 0.0]
    assert values(spark, N.triangle(F.col("x"), 30, 60, 100), rows, "x double")[0] == pytest.approx(0.5)
    assert values(spark, N.row_mean(F.col("a"), F.col("b")), [(1.0, None), (None, None), (1.0, 3.0)], "a double, b double") == [1.0, None, 2.0]
    assert values(spark, N.ratio(F.col("a"), F.col("b")), [(1.0, 0.0), (1.0, 2.0), (None, 1.0)], "a double, b double") == [None, 0.5, None]


def test_corrected_moments_and_constant_correlation(spark):
    df = spark.createDataFrame([(float(x), 1.0) for x in (1, 2, 3, 4, 10)], "x double, c double")
    r = df.agg(N.skewness_g1(F.col("x")).alias("s"), N.kurtosis_g2(F.col("x")).alias("k"), N.pearson(F.col("x"), F.col("c")).alias("r")).first()
    assert r.s == pytest.approx(1.6970562748) and r.k == pytest.approx(3.152) and r.r is None


@pytest.mark.parametrize("raw,want", [("https://doi.org/10.1234/AB", "10.1234/ab"), ("doi:10.1/x", None), ("10.12345/x y", None), (None, None), ("", None), (" 10.9999/q ", "10.9999/q")])
def test_doi(spark, raw, want):
    assert values(spark, X.normalize_doi(F.col("s")), [(raw,)], "s string") == [want]


@pytest.mark.parametrize("raw,want", [("4.2 ± 0.3", 4.2), ("1 234.5a", 1234.5), ("1,234", 1234.0), ("12*", 12.0), ("n.d.", None), ("", None), (None, None)])
def test_measurement(spark, raw, want):
    assert values(spark, X.parse_measurement(F.col("s")), [(raw,)], "s string") == [want]


@pytest.mark.parametrize("raw,want", [("kg ha-1", "kg/ha"), ("g kg-1", "g/kg"), ("T/HA", "t/ha"), ("°C", "cel"), ("kg·hm-2", "kg/ha"), ("furlong", None), (None, None), ("pH", None)])
def test_unit(spark, raw, want):
    assert values(spark, X.normalize_unit(F.col("s")), [(raw,)], "s string") == [want]


def test_conversion_refuses_across_dimensions(spark):
    rows = [(4.2, "t/ha", "kg/ha"), (13.4, "g kg-1", "kg/ha"), (50.0, "F", "C"), (1.0, "furlong", "cm"), (1.0, "cm", None), (1.0, "kg", "C")]
    got = values(spark, X.convert_unit(F.col("v"), F.col("s"), F.col("t")), rows, "v double, s string, t string")
    assert [(round(g.value, 6), g.ok) for g in got] == [(4200.0, True), (13.4, False), (10.0, True), (1.0, True), (1.0, True), (1.0, False)]


def test_oxides_and_ratio(spark):
    assert X.oxide_factor("P2O5") == pytest.approx(0.4364, abs=1e-4) and X.oxide_factor("K2O") == pytest.approx(0.8301, abs=1e-4)
    got = values(spark, X.npk(F.col("s")), [("120:60:40 kg/ha",), ("none",), (None,)], "s string")
    assert got[0].n == 120 and got[0].p == pytest.approx(26.19, abs=0.01) and got[1:] == [None, None]


def test_publication_types(spark):
    rows = [("Review Article",), ("journal-article",), ("Meeting Abstract",), ("thesis",), (None,), ("",)]
    assert values(spark, X.publication_type(F.col("s")), rows, "s string") == ["review", "journal-article", "conference-abstract", "thesis", None, None]


def test_versions_compare_by_number(spark):
    assert values(spark, X.version_key(F.col("s")) > X.version_key(F.lit("1.9")), [("1.10",), ("v1.9",), ("1.8.9",)], "s string") == [True, False, False]


def test_title_similarity(spark):
    got = values(spark, X.title_similarity(F.col("a"), F.col("b")), [("Effect of N on rice", "Effect of N on Rice!"), ("abc", None), ("", "")], "a string, b string")
    assert got == [1.0, 0.0, 0.0]


def test_centroid_rules_and_choices(spark):
    sets = {"low": ("low", 0.2, 0.5), "high": ("high", 0.5, 0.8)}
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 1.0), (1.0, 0.0), (0.5, 0.5)], "l double, h double")
    got = [r[0] for r in df.select(fuzzy.centroid({"low": F.col("l"), "high": F.col("h")}, sets, 200)).collect()]
    assert got[0] == 0.5 and got[1] > 0.7 and got[2] < 0.3 and got[3] == pytest.approx(0.5, abs=0.01)
    fired = fuzzy.fire({"a": {"x": F.col("l"), "y": F.col("h")}}, [({"a": "x"}, "o", "low"), ({"a": "y"}, "o", "low")])
    assert [r[0] for r in df.select(fired[("o", "low")]).collect()] == [0.0, 1.0, 1.0, 0.5]
    top = spark.range(1).select(recommend.top_choices([("a", F.lit(1.0)), ("b", F.lit(2.0)), ("c", F.lit(1.0))], 2).alias("t")).first().t
    assert [x.name for x in top] == ["b", "a"]


def test_recommendation_ladder(spark):
    rows = [("low", "low", "low", "x", None), ("high", "low", "low", "x", None), ("high", "medium", "unknown", None, "pref"), (None, None, None, None, None)]
    got = values(spark, recommend.fertilizer(F.col("n"), F.col("p"), F.col("k"), F.col("g"), F.col("f")), rows, "n string, p string, k string, g string, f string")
    assert got == ["Urea", "DAP", "pref", "Bio NPK"]
    dose = values(spark, recommend.dose(F.col("b"), F.col("n"), F.col("r"), F.col("ph")), [(None, "low", 300.0, 5.0), (80.0, None, None, None)], "b double, n string, r double, ph double")
    assert dose == [pytest.approx(144.4), 80.0]
    assert math.isclose(values(spark, recommend.economic(F.lit(1000.0), F.lit(20.0), F.lit(100.0)), [(1,)], "x int")[0], 1.0)
