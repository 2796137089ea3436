"""Leakage names, exact quantiles and schema catalogues on small cases."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import agronomy, features, leakage, quantiles


def test_names_that_leak():
    leaky = {
        ("Yield_x_N", "Plant_Height_cm"), ("Predicted_Yield", "Plant_Height_cm"), ("Yield_per_Hectare_1", "Plant_Height_cm"), ("Plant_Height_30_cm", "Plant_Height_cm"),
        ("Height_x_N", "Plant_Height_cm"), ("Biomass_log", "SPAD"), ("N_Uptake_kg_ha", "SPAD"), ("Nitrogen_Use_Efficiency", "SPAD"), ("Harvest_Index", "SPAD"), ("HI_log", "SPAD"), ("FruitWeight_log", "SPAD"),
    }
    sound = {("Plant_Height_30_cm", "Yield_per_Hectare"), ("Nitrogen", "Yield_per_Hectare"), ("Spacing_Plant", "Plant_Height_cm"), ("Soil_pH_squared", "Yield_per_Hectare")}
    assert all(leakage.is_leaky(*x) for x in leaky) and not any(leakage.is_leaky(*x) for x in sound)
    assert leakage.base_name("Yield_log_squared_2") == "Yield"


def test_safe_features(spark):
    df = spark.createDataFrame([(1.0, 6.5, 100, 10.0, 10.0, 9.0, 10.0, "x", 1)], "Nitrogen double, Soil_pH double, Rainfall int, Yield_per_Hectare double, Yield_x_N double, Predicted_Yield double, Yield_per_Hectare_1 double, Crop string, Crop_Code int")
    assert leakage.safe_features(df, "Yield_per_Hectare") == ["Nitrogen", "Soil_pH", "Rainfall"]


@pytest.mark.parametrize("inside", [1, 40, 20_000])
def test_quantiles_equal_sorted_values(spark, monkeypatch, inside):
    monkeypatch.setattr(quantiles, "INSIDE", inside)
    monkeypatch.setattr(quantiles, "ACCURACY", 50)
    rng = random.Random(inside)
    rows = [(rng.gauss(0, 1) if i % 7 else None, float(rng.choice([1, 1, 1, 2, 5])), None, 3.0 if i == 4 else None) for i in range(900)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double").repartition(5)
    shares = [0.0, 0.25, 0.33, 0.5, 0.9, 1.0]
    got = quantiles.quantiles(df, {c: F.col(c) for c in df.columns}, shares)
    for i, c in enumerate(df.columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        for share, x in zip(shares, got[c]):
            at = share * (len(values) - 1)
            lo, hi = int(at), min(int(at) + 1, len(values) - 1)
            assert x is None if not values else x == pytest.approx(values[lo] + (at - lo) * (values[hi] - values[lo]))
    assert quantiles.quantiles(df.limit(0), {"a": F.col("a")}, [0.5]) == {"a": [None]}


def test_derivations_and_features_skip_what_is_missing(spark):
    df = spark.createDataFrame([(10.0, 0.0, 4.0, None), (20.0, 5.0, None, 6.0), (None, 5.0, None, None)], "Yield_per_Plot double, Plot_Size double, Leaf_Area_30_cm2 double, Leaf_Area_60_cm2 double")
    got = features.derive(df, agronomy.derivations()).collect()
    assert [r.Yield_per_Hectare for r in got] == [None, 40000.0, None] and [r.Leaf_Area_cm2 for r in got] == [4.0, 6.0, None]
    assert len(agronomy.derivations()) == 12 and len(agronomy.derivations(0.99)) == 4
    small = spark.createDataFrame([(2.0, 0.0, None), (-1.0, 4.0, 1.0)], "Nitrogen double, Phosphorus double, Rainfall double")
    out = small.select(*[x.alias(c) for c, x in agronomy.engineered(small).items()]).collect()
    assert [r.N_P_ratio for r in out] == [None, -0.25] and [r.N_log for r in out][1] == 0.0 and [r.Rainfall_log for r in out][0] is None
    assert [r.N_x_P for r in out] == [0.0, -4.0] and not any("K" in c.split("_") for c in out[0].asDict())


def test_bundle_of_an_empty_table(spark):
    df = spark.createDataFrame([], "`Soil pH` double, Nitrogen double")
    rows = {(r.check, r.column_name): r.passed for r in agronomy.validation(df, agronomy.BOUNDS, ["DOI"]).collect()}
    assert rows == {("range", "Soil pH"): True, ("range", "Nitrogen"): True, ("required", "DOI"): True, ("all", ""): True}
    assert agronomy.target_column(df) is None and agronomy.target_column(df, "Nitrogen") is None
