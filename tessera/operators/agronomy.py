"""Catalogues of the field schema: bounds, cross-field rules, derivations, engineered columns, ladders.

Columns are the schema's own names; what needs a column that a table lacks is left out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce
from operator import add, mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hard bounds
BOUNDS = {
    "Soil_pH": (0, 14), "EC": (0, 100), "Humidity": (0, 100), "Temperature_Max": (-20, 60), "Temperature_Min": (-30, 50), "Average_Temperature": (-25, 55),
    "Rainfall": (0, 10000), "Protein": (0, 100), "Ash": (0, 100), "Fat": (0, 100), "Fiber": (0, 100), "Carbohydrates": (0, 100), "Moisture_Content": (0, 100),
    "Dry_Matter": (0, 100), "SPAD": (0, 100), "Yield_per_Hectare": (0, 100000), "Yield_per_Acre": (0, 50000), "Yield_per_Plot": (0, 100000),
    "100_Seed_Weight": (0, 1000), "Organic_Carbon": (0, 100), "Organic_Matter": (0, 100), "Nitrogen": (0, 1000), "Phosphorus": (0, 1000), "Potassium": (0, 1000),
    "Zinc": (0, 500), "Iron": (0, 1000), "Manganese": (0, 500), "Copper": (0, 200), "Boron": (0, 100),
}
# Biological ranges
BIOLOGICAL = {
    "Plant_Height_cm": (1, 800), "Yield_per_Hectare": (100, 20000), "Soil_pH": (3.0, 10.0), "Nitrogen": (10, 500), "Phosphorus": (5, 200), "Potassium": (10, 400),
    "Harvest_Index": (0.1, 0.7), "SPAD": (10, 80), "Leaf_Number": (2, 100), "Tillers": (1, 50), "Fruit_Weight": (0.5, 2000), "100_Seed_Weight": (1, 500),
}
# Words of a control treatment
CONTROL = ["control", "ctrl", "check", "ck", "t0", "untreated", "unfertilized", "water_only", "absolute_control", "negative_control", "blank"]
# Measured outcomes in the order in which a target is looked for
MEASURED = ["Yield_per_Hectare", "Yield_per_Plot", "Plant_Height_cm", "SPAD", "Shoot_Biomass_g"]


def cross_rules() -> list[tuple[str, Column, Column, str]]:
    """The six cross-field rules (name, applies, holds, severity) for ``profile.rule_violations``."""
    c = lambda n: F.col(f"`{n}`")
    there = lambda *names: reduce(lambda a, b: a & b, [c(n).isNotNull() for n in names])
    yield_, mass, om, oc = c("Yield_per_Hectare"), c("Biomass_Yield"), c("Organic_Matter"), c("Organic_Carbon")
    return [
        ("yield_biomass_ratio", there("Yield_per_Hectare", "Biomass_Yield") & (mass > 0), (yield_ / mass).between(0.1, 0.8), "warning"),
        ("temperature_consistency", there("Temperature_Max", "Temperature_Min"), c("Temperature_Max") >= c("Temperature_Min"), "error"),
        ("height_leaf_area_correlation", there("Plant_Height_cm", "Leaf_Area_cm2"), ~((c("Plant_Height_cm") < 5) & (c("Leaf_Area_cm2") > 100)), "warning"),
        ("organic_matter_carbon_ratio", there("Organic_Matter", "Organic_Carbon") & (oc > 0), (om / oc).between(1.0, 2.5), "warning"),
        ("fertilizer_rate_sanity", there("Nitrogen"), c("Nitrogen") <= 300, "warning"),
        ("harvest_index_plausibility", there("Harvest_Index"), c("Harvest_Index").between(0.15, 0.65), "warning"),
    ]


def derivations(least: float = 0.95) -> list[tuple]:
    """The twelve derivations (target, sources, expression[, how]) of at least that confidence for ``features.derive``."""
    c, per = F.col, lambda x, area: F.col("Yield_per_Plot") * (x / F.nullif(F.col(area), F.lit(0.0)))
    rules = [
        (0.98, "Yield_per_Hectare", ["Yield_per_Plot", "Plot_Size"], per(10000, "Plot_Size")),
        (0.99, "Yield_per_Hectare", ["Yield_per_Acre"], c("Yield_per_Acre") * 2.471),
        (0.98, "Yield_per_Acre", ["Yield_per_Plot", "Plot_Size"], per(4046.86, "Plot_Size")),
        (0.97, "Organic_Matter", ["Organic_Carbon"], c("Organic_Carbon") * 1.724),
        (0.97, "Organic_Carbon", ["Organic_Matter"], c("Organic_Matter") / 1.724),
        (0.95, "Plant_Height_cm", ["Plant_Height_30_cm", "Plant_Height_60_cm"], (c("Plant_Height_30_cm") + c("Plant_Height_60_cm")) / 2),
        (0.99, "Biomass_Yield", ["Shoot_Biomass_g", "Root_Biomass_g"], c("Shoot_Biomass_g") + c("Root_Biomass_g")),
        (0.95, "Leaf_Area_cm2", ["Leaf_Area_30_cm2", "Leaf_Area_60_cm2"], F.greatest("Leaf_Area_30_cm2", "Leaf_Area_60_cm2"), "any"),
        (0.96, "Growing_Degree_Days", ["Average_Temperature", "Growth_Duration_Days"], F.greatest(c("Average_Temperature") - 10, F.lit(0.0)) * c("Growth_Duration_Days")),
        (0.97, "Yield_per_Plant", ["Yield_per_Plot", "Plot_Size"], c("Yield_per_Plot") * c("Plot_Size")),
        (0.99, "Temp_x_Rainfall", ["Average_Temperature", "Rainfall"], c("Average_Temperature") * c("Rainfall")),
        (0.99, "N_x_P", ["Nitrogen", "Phosphorus"], c("Nitrogen") * c("Phosphorus")),
    ]
    return [r[1:] for r in rules if r[0] >= least]


# Short names of the schema's columns in engineered names
SHORT = {
    "N": "Nitrogen", "P": "Phosphorus", "K": "Potassium", "OC": "Organic_Carbon", "pH": "Soil_pH", "EC": "EC", "Rainfall": "Rainfall", "Humidity": "Humidity",
    "Temp": "Average_Temperature", "Tavg": "Average_Temperature", "Tmax": "Temperature_Max", "Tmin": "Temperature_Min", "Height": "Plant_Height_cm",
    "LeafArea": "Leaf_Area_cm2", "LA": "Leaf_Area_cm2", "ShootBiomass": "Shoot_Biomass_g", "RootBiomass": "Root_Biomass_g", "Biomass": "Biomass_Yield",
    "SPAD": "SPAD", "FruitWeight": "Fruit_Weight", "SeedWeight": "100_Seed_Weight", "HI": "Harvest_Index", "Soil_pH": "Soil_pH",
}
# Engineered names
LOGS = "Rainfall N P K OC Biomass Humidity Height SPAD EC LA ShootBiomass RootBiomass FruitWeight SeedWeight HI Tavg".split()
ROOTS = "Rainfall N Biomass Height FruitWeight".split()
SQUARES = "Temp Rainfall N P K Soil_pH OC Biomass Humidity Height SPAD EC LA FruitWeight SeedWeight HI Tavg".split()
PRODUCTS = """Temp_x_Rainfall N_x_P N_x_K P_x_K Height_x_LeafArea Height_x_ShootBiomass Temp_x_N Rainfall_x_N Rainfall_x_P Rainfall_x_K
OC_x_pH EC_x_pH Rainfall_x_pH Rainfall_x_OC N_x_pH P_x_pH K_x_pH Height_x_N Height_x_Rainfall Height_x_pH Tmax_x_N Tmax_x_Rainfall
Tmin_x_Rainfall Humidity_x_Rainfall Humidity_x_N EC_x_OC N_x_OC P_x_OC K_x_OC N_x_P_x_pH NPK_x_pH Biomass_x_N Biomass_x_pH SPAD_x_N
LA_x_N Height_x_P Height_x_K Height_x_SPAD""".split()
SUMS = {"NPK_sum": "NPK", "N_plus_P": "NP", "N_plus_K": "NK", "P_plus_K": "PK"}
RATIOS = {
    "NPK_ratio_N": ("N", "NPK"), "NPK_ratio_P": ("P", "NPK"), "NPK_ratio_K": ("K", "NPK"), "C_N_ratio": ("OC", "N"), "N_P_ratio": ("N", "P"), "P_K_ratio": ("P", "K"),
    "Shoot_Root_Ratio": ("ShootBiomass", "RootBiomass"), "Root_Shoot_Ratio": ("RootBiomass", "ShootBiomass"), "Root_pct": ("RootBiomass", "ShootBiomass+RootBiomass"),
    "N_Rainfall_ratio": ("N", "Rainfall"), "Biomass_N_ratio": ("Biomass", "N"),
}


def engineered(df: DataFrame) -> dict[str, Column]:
    """Logarithms, roots, squares, products, sums and ratios whose sources df has and whose names it lacks."""
    def parts(term: str) -> list[str]:
        return list(term) if term in ("NPK", *SUMS.values()) else term.split("+")

    def of(term: str) -> Column:
        return reduce(add, [F.col(f"`{SHORT[p]}`").cast("double") for p in parts(term)])

    made = {f"{n}_log": ([n], lambda x: F.log1p(F.greatest(x, F.lit(0.0)))) for n in LOGS}
    made |= {f"{n}_sqrt": ([n], lambda x: F.sqrt(F.greatest(x, F.lit(0.0)))) for n in ROOTS}
    made |= {f"{n}_squared": ([n], lambda x: x * x) for n in SQUARES}
    made |= {name: (name.split("_x_"), lambda *x: reduce(mul, x)) for name in PRODUCTS}
    made |= {name: ([terms], lambda x: x) for name, terms in SUMS.items()}
    made |= {name: (list(pair), lambda a, b: a / F.nullif(b, F.lit(0.0))) for name, pair in RATIOS.items()}
    there = set(df.columns)
    fits = {n: (t, f) for n, (t, f) in made.items() if n not in there and all(SHORT[p] in there for x in t for p in parts(x))}
    whole = lambda t: reduce(lambda a, b: a & b, [F.col(f"`{SHORT[p]}`").isNotNull() for x in t for p in parts(x)])
    return {n: F.when(whole(t), f(*map(of, t))) for n, (t, f) in fits.items()}


def is_control(treatment: Column) -> Column:
    """Whether a treatment's name has a word of a control; null is none."""
    name = F.regexp_replace(F.lower(F.trim(treatment)), "[†‡*]", "")
    return F.coalesce(reduce(lambda a, b: a | b, [name.contains(w) for w in CONTROL]), F.lit(False))


def advice(n: Column, p: Column, k: Column, ph: Column, oc: Column, zn: Column) -> Column:
    """The first rung of the nutrient ladder that applies; nulls skip a rung."""
    return (
        F.when(n < 50, "Urea (Nitrogen-rich)").when(p < 15, "DAP (Phosphorus-rich)").when(k < 100, "MOP (Potassium-rich)").when(n > 150, "SSP (Low nitrogen)")
        .when(ph < 5.5, "Dolomite + Bio NPK").when(ph > 8.0, "Ammonium Sulphate + Gypsum").when(oc < 0.4, "Compost + Vermicompost")
        .when(zn < 0.5, "Zinc Sulphate + Balanced NPK").otherwise("Balanced NPK (15-15-15)")
    )


def interval(rainfall: Column) -> Column:
    return F.when(rainfall > 1000, "Split application (3-4 splits)").when(rainfall < 500, "Every 15-20 days").otherwise("Every 25-30 days")


def adjusted(dose: Column, days: Column, nitrogen: Column, potash: Column, irrigation: Column, rate: Column) -> dict[str, Column]:
    """Crisp outputs of the fuzzy inference put to work; an output that did not fire (null) counts as 0.5.

    A zero dose or interval counts as none.
    """
    n, k, i, d = (F.coalesce(x, F.lit(0.5)) for x in (nitrogen, potash, irrigation, rate))
    return {
        "dose": F.when(dose != 0, dose * (0.5 + (n * 0.4 + k * 0.2 + d * 0.4))).otherwise(dose),
        "days": F.when(days != 0, days * (2.0 - i)).otherwise(7 + (1 - i) * 14),
        "fertilizer": F.when(n > 0.6, "Urea (Fuzzy)"),
        "confidence": F.round(n * 0.3 + k * 0.2 + i * 0.2 + d * 0.3, 3),
    }


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean of the non-null values of a row; null where all are."""
    n = reduce(add, [c.isNotNull().cast("int") for c in columns])
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns]) / F.nullif(n, F.lit(0))


def tier(score: Column) -> Column:
    return F.when(score >= 0.8, "high").when(score >= 0.5, "medium").otherwise("low")


def sample_weights(df: DataFrame, score: str, name: str = "weight") -> DataFrame:
    """``name``: the score from its least to its most value laid on 0.5 to 1; one row of extremes is broadcast."""
    ends = F.broadcast(df.agg(F.min(score).alias("_least"), F.max(score).alias("_most")))
    return df.crossJoin(ends).withColumn(name, 0.5 + 0.5 * (F.col(score) - F.col("_least")) / (F.col("_most") - F.col("_least") + 1e-6)).drop("_least", "_most")


def completeness(df_has: dict[str, Column]) -> tuple[Column, Column]:
    """(points, quality) of a literature record from tests named as in WEIGHTS; absent tests count as failed."""
    has = lambda k: F.coalesce(df_has.get(k, F.lit(False)), F.lit(False))
    points = reduce(add, [F.when(has(k), n).otherwise(0) for k, n in POINTS.items()])
    score = reduce(add, [F.when(has(k), w).otherwise(0.0) for k, w in WEIGHTS.items()])
    return points, F.round(F.least(score, F.lit(1.0)), 4)


# Points and weights of a literature record's fields
POINTS = {"doi": 2, "title": 2, "year": 1, "journal": 1, "authors": 2, "abstract": 2, "pdf": 2, "references": 1}
WEIGHTS = {"doi": 0.15, "title": 0.15, "year": 0.10, "journal": 0.10, "authors": 0.10, "abstract": 0.15, "pdf": 0.10, "references": 0.05, "design_signal": 0.05, "verified_doi": 0.05}


def target_column(df: DataFrame, requested: str | None = None, extra: Sequence[str] = (), least: int = 5) -> str | None:
    """The first candidate that df has with at least ``least`` values; one aggregate."""
    asked = [c for c in dict.fromkeys([*([requested] if requested else []), *extra, *MEASURED]) if c in df.columns]
    row = df.agg(*[F.count(f"`{c}`").alias(c) for c in asked]).first() if asked else {}
    return next((c for c in asked if row[c] >= least), None)


def experiment_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys that df has, rows) of each experiment; rows with a null key belong to none."""
    have = [k for k in keys if k in df.columns]
    return df.dropna(subset=have).groupBy(*have).agg(F.count("*").alias("rows"))


def readiness(df: DataFrame, target: str, missing: float = 0.1, limit: float = 0.9, skew: float = 2.0) -> DataFrame:
    """(check, column_name, value) of what keeps a table from training: missing shares, text columns, collinear pairs, a skewed target."""
    from tessera.functions import numeric as N
    from tessera.operators import profile

    numbers = [c for c, t in df.dtypes if t in ("int", "bigint", "double", "float") and c != target]
    row = df.agg(*[F.avg(F.col(c).isNull().cast("int")).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "value").filter(F.col("value") > missing)
    out = row.select(F.lit("missing").alias("check"), "column_name", "value")
    words = [(("text"), c, 1.0) for c, t in df.dtypes if t == "string"]
    out = out.unionByName(df.sparkSession.createDataFrame(words, "check string, column_name string, value double"))
    if len(numbers) > 1:
        pairs = profile.correlations(df, numbers).filter(F.abs("r") > limit)
        out = out.unionByName(pairs.select(F.lit("collinear").alias("check"), F.concat_ws("~", "a", "b").alias("column_name"), F.col("r").alias("value")))
    bent = df.agg(N.skewness_g1(F.col(target)).alias("value")).filter(F.abs("value") > skew)
    return out.unionByName(bent.select(F.lit("skewed_target").alias("check"), F.lit(target).alias("column_name"), "value"))


def health(extraction: Sequence[float], model: Sequence[float], recommendation: Sequence[float], agents: Sequence[float], completeness_: float) -> dict[str, float]:
    """Means of means over a run's metrics; model holds r2, rmse and mae."""
    mean = lambda x: math.fsum(x) / len(x) if len(x) else 0.0
    r2, rmse, mae = model
    parts = {"extraction": mean(extraction), "model": mean([r2, max(0.0, 1 - rmse), max(0.0, 1 - mae)]), "recommendation": mean(recommendation), "agent": mean(agents)}
    parts["pipeline"] = mean([parts["extraction"], parts["model"], parts["recommendation"]])
    parts["overall"] = mean([parts["pipeline"], parts["agent"], completeness_])
    return {k: round(v, 4) for k, v in parts.items()}


def retrain_due(verified: Column, new: Column, least_verified: int, least_new: int) -> Column:
    return (verified >= least_verified) & (new >= least_new)


def positional_name(name: str) -> str | None:
    """The schema's name of a column that carries a stage and a unit, as plantheight30cm; None if it is no such name."""
    import re

    kinds = [
        (r"plantheight[_\s]*(\d+)[_\s]*cm", r"Plant_Height_\1_cm"), (r"leaf[_\s]*area[_\s]*(\d+)[_\s]*cm2", r"Leaf_Area_\1_cm2"), (r"yieldplot[_\s]*\d+[_\s]*g", "Yield_per_Plot"),
        (r"fruitweight[_\s]*\d+[_\s]*g", "Fruit_Weight"), (r"fruitdiameter[_\s]*\d+[_\s]*mm", "Fruit_Diameter_mm"), (r"branches[_\s]*\d+", "Branches"), (r"flowers[_\s]*\d+", "Flowers"),
    ]
    return next((m.expand(to) for pattern, to in kinds if (m := re.match(pattern, name))), None)


def detected(df: DataFrame, bounds: dict[str, tuple[float, float]], named: dict[str, str] | None = None) -> dict[str, str]:
    """The column that each bound is for: as named, else one whose name has the same letters and digits."""
    letters = lambda s: "".join(ch for ch in s.lower() if ch.isalnum())
    own = {letters(c): c for c in reversed(df.columns)}
    found = {k: (named or {}).get(k) or own.get(letters(k)) for k in bounds}
    return {k: c for k, c in found.items() if c in df.columns}


def validation(df: DataFrame, bounds: dict[str, tuple[float, float]], required: Sequence[str] = (), named: dict[str, str] | None = None) -> DataFrame:
    """(check, column_name, failures, passed): ranges of detected columns, required columns, and ``all`` for the bundle; one pass."""
    cols = detected(df, bounds, named)
    out_of = lambda k, c: F.count_if((F.col(f"`{c}`") < bounds[k][0]) | (F.col(f"`{c}`") > bounds[k][1]))
    tests = [("range", c, out_of(k, c)) for k, c in cols.items()]
    tests += [("required", c, F.count_if(F.col(f"`{c}`").isNull()) if c in df.columns else F.count("*")) for c in required]
    row = df.agg(*[t.alias(f"t{i}") for i, (_, _, t) in enumerate(tests)])
    each = [F.struct(F.lit(kind).alias("check"), F.lit(c).alias("column_name"), F.col(f"t{i}").alias("failures")) for i, (kind, c, _) in enumerate(tests)]
    total = F.struct(F.lit("all").alias("check"), F.lit("").alias("column_name"), reduce(add, [F.col(f"t{i}") for i in range(len(tests))]).alias("failures"))
    return row.select(F.explode(F.array(*each, total)).alias("r")).select("r.*").withColumn("passed", F.col("failures") == 0)
