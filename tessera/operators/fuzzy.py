"""Fuzzy inference as column expressions: fuzzify, fire rules, aggregate, defuzzify."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric as N

SHAPES = {"triangle": N.triangle, "trapezoid": N.trapezoid, "gaussian": N.gaussian, "high": N.shoulder_high, "low": N.shoulder_low}

# Sets of each input
SETS = {
    "Nitrogen": {"low": ("low", 30, 60), "medium": ("triangle", 30, 60, 100), "high": ("high", 80, 120)},
    "Phosphorus": {"low": ("low", 10, 20), "medium": ("triangle", 10, 25, 40), "high": ("high", 30, 50)},
    "Potassium": {"low": ("low", 80, 120), "medium": ("triangle", 80, 150, 250), "high": ("high", 180, 300)},
    "Soil_pH": {"acidic": ("low", 5.5, 6.0), "neutral": ("trapezoid", 5.5, 6.5, 7.5, 8.0), "alkaline": ("high", 7.5, 8.0)},
    "Rainfall": {"low": ("low", 400, 600), "medium": ("triangle", 400, 750, 1100), "high": ("high", 900, 1200)},
    "Temperature_Max": {"cool": ("low", 20, 25), "moderate": ("trapezoid", 20, 25, 32, 35), "hot": ("high", 32, 38)},
    "Organic_Carbon": {"low": ("low", 0.4, 0.6), "medium": ("triangle", 0.4, 0.75, 1.0), "high": ("high", 0.8, 1.2)},
    "Growth_Stage": {"seedling": ("low", 15, 30), "vegetative": ("trapezoid", 20, 35, 50, 65), "flowering": ("trapezoid", 50, 60, 75, 85), "maturity": ("high", 75, 95)},
    "Zinc": {"low": ("low", 0.5, 1.0), "medium": ("triangle", 0.5, 1.5, 2.5), "high": ("high", 2.0, 3.0)},
    "Yield_Prediction": {"low": ("low", 2.0, 3.5), "medium": ("triangle", 2.5, 4.5, 6.5), "high": ("high", 5.5, 8.0)},
}


def membership(x: Column, shape: str, *params: float) -> Column:
    """Degree in [0, 1]; a null input has 0."""
    return F.coalesce(N.clip(SHAPES[shape](x, *params), 0, 1), F.lit(0.0))


def fuzzify(x: Column, sets: dict[str, tuple]) -> dict[str, Column]:
    return {label: membership(x, *spec) for label, spec in sets.items()}


def fire(degrees: dict[str, dict[str, Column]], rules: Sequence[tuple[dict[str, str], str, str]]) -> dict[tuple[str, str], Column]:
    """(output, set) -> strength: least degree of a rule's conditions, greatest over rules.  No shuffle, any number of rules."""
    by: dict[tuple[str, str], list[Column]] = {}
    for conditions, output, label in rules:
        parts = [degrees[v][s] for v, s in conditions.items()]
        by.setdefault((output, label), []).append(F.least(*parts) if len(parts) > 1 else parts[0])
    return {k: F.greatest(*v) if len(v) > 1 else v[0] for k, v in by.items()}


def _degree(x: float, shape: str, *p: float) -> float:
    """Membership of a plain number, for the constant grid of an output."""
    from math import exp

    e = N.EPSILON
    if shape == "triangle":
        v = min((x - p[0]) / (p[1] - p[0] + e), (p[2] - x) / (p[2] - p[1] + e))
    elif shape == "trapezoid":
        v = min((x - p[0]) / (p[1] - p[0] + e), 1.0, (p[3] - x) / (p[3] - p[2] + e))
    elif shape == "gaussian":
        v = exp(-0.5 * ((x - p[0]) / p[1]) ** 2)
    else:
        high = 0.0 if x <= p[0] else 1.0 if x >= p[1] else (x - p[0]) / (p[1] - p[0] + e)
        v = high if shape == "high" else 1 - high
    return min(1.0, max(0.0, v))


def centroid(strengths: dict[str, Column], sets: dict[str, tuple], samples: int = 1000) -> Column:
    """Centre of the clipped output sets over a grid of [0, 1]; 0.5 where nothing fired.

    The sets' heights over the grid are constant arrays; a row clips and combines them.
    """
    grid = [i / (samples - 1) for i in range(samples)]
    constant = lambda values: F.array(*[F.lit(float(v)) for v in values])
    order = list(strengths)

    def row(s):  # the strengths as one variable, so that they are computed once per row
        height = None
        for k, label in enumerate(order):
            clipped = _clip(constant(_degree(x, *sets[label]) for x in grid), s, k)
            height = clipped if height is None else F.zip_with(height, clipped, lambda p, q: F.greatest(p, q))
        return F.transform(F.array(height), lambda h: F.struct(_total(F.zip_with(h, constant(grid), lambda p, x: p * x)).alias("a"), _total(h).alias("m")))[0]

    total = F.transform(F.array(F.array(*[strengths[k] for k in order])), row)
    return F.transform(total, lambda t: F.when(t["m"] > 0, t["a"] / t["m"]).otherwise(0.5))[0]


def _clip(heights: Column, s: Column, k: int) -> Column:
    return F.transform(heights, lambda m: F.least(s[k], m))


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def strongest(strengths: dict[str, Column], default: str) -> Column:
    """Label of the greatest strength, the first of ties; the default where nothing fired."""
    most = F.greatest(*strengths.values()) if len(strengths) > 1 else next(iter(strengths.values()))
    out = F.lit(default)
    for label, s in reversed(strengths.items()):
        out = F.when((s == most) & (most > 0), label).otherwise(out)
    return out


# Sets of the adjustments, labels of the actions
ADJUSTMENT = {"low": ("low", 0.0, 0.35), "medium": ("triangle", 0.2, 0.5, 0.8), "high": ("high", 0.6, 1.0)}
ACTIONS = {"increase": "Increase", "reduce": "Reduce", "maintain": "Maintain", "apply_foliar_spray": "Apply foliar spray", "apply_soil": "Apply to soil", "monitor": "Monitor", "review": "Review program"}


@dataclass(frozen=True)
class Rule:
    """All conditions (input, set) hold to the least of their degrees; each consequent follows to that strength."""

    conditions: tuple[tuple[str, str], ...]
    consequents: tuple[dict, ...]


def rules_from(document: str | dict) -> list[Rule]:
    """A rule base of any size from a mapping or its JSON or YAML text; rules without a condition never fire and go.

    {rules: [{antecedents: [{var, set}], consequents: [{type: adjustment, var, set} | {type: nutrient, nutrient, action, amount}
    | {type: risk or confidence, level}]}]}
    """
    if isinstance(document, str):
        try:
            document = json.loads(document)
        except json.JSONDecodeError:
            import yaml  # only a YAML text needs it

            document = yaml.safe_load(document)
    made = (Rule(tuple((a["var"], a["set"]) for a in r.get("antecedents") or []), tuple(r.get("consequents") or [])) for r in (document or {}).get("rules") or [])
    return [r for r in made if r.conditions]


def infer(df: DataFrame, inputs: dict[str, Column], rules: Sequence[Rule], sets: dict[str, dict[str, tuple]] = SETS, samples: int = 1000) -> DataFrame:
    """df with each adjustment's centroid, an action per nutrient, risk, confidence and a summary.

    Rows are only widened: degrees and strengths are columns, no row meets a rule by a join.  An input or a set that is
    not there holds to degree 0; an adjustment that did not fire is null, a nutrient without a rule is maintained.
    """
    named = {v: f"_mu_{i}" for i, v in enumerate(inputs)}
    labels = {v: list(sets[v]) for v in inputs}
    df = df.withColumns({named[v]: F.array(*[membership(x, *sets[v][k]) for k in labels[v]]) for v, x in inputs.items()})

    def strength(r: Rule) -> Column:
        held = [F.col(named[v])[labels[v].index(k)] if v in named and k in labels[v] else F.lit(0.0) for v, k in r.conditions]
        return F.least(*held) if len(held) > 1 else held[0]

    df = df.withColumn("_fired", F.array(*[strength(r) for r in rules]) if rules else F.array().cast("array<double>"))
    fired = lambda i: F.col("_fired")[i]
    follow = [(i, c) for i, r in enumerate(rules) for c in r.consequents]
    outputs: dict[str, dict[str, list[Column]]] = {}
    for i, c in follow:
        if c.get("type") == "adjustment":
            outputs.setdefault(c["var"], {}).setdefault(c["set"], []).append(fired(i))
    made = {}
    for var, by in outputs.items():
        most = {k: F.greatest(*v) if len(v) > 1 else v[0] for k, v in by.items()}
        some = F.greatest(*most.values()) if len(most) > 1 else next(iter(most.values()))
        made[var] = F.when(some > 0, centroid(most, ADJUSTMENT, samples))
    best = {}
    for nutrient in ("Nitrogen", "Phosphorus", "Potassium", "Zinc"):
        best[nutrient] = F.coalesce(_foremost([(_action(c), c["action"], fired(i)) for i, c in follow if c.get("type") == "nutrient" and c["nutrient"] == nutrient]), F.lit("Maintain"))
    made |= {f"{n}_Action": c for n, c in best.items()}
    for kind in ("risk", "confidence"):
        made[kind.title()] = F.coalesce(_foremost([(c["level"], c["level"], fired(i)) for i, c in follow if c.get("type") == kind]), F.lit("medium"))
    out = df.withColumns(made)
    said = F.concat_ws(" | ", *[F.when(F.col(f"{n}_Action") != "Maintain", F.concat(F.lit(f"{n}: "), F.lower(f"{n}_Action"))) for n in best])
    said = F.when(said == "", "all nutrients optimal: keep the schedule").otherwise(said)
    summary = F.concat(said, F.lit(" | risk: "), F.lower("Risk"), F.lit(" | confidence: "), F.lower("Confidence"))
    return out.withColumn("Summary", summary).drop("_fired", *named.values())


def _action(c: dict) -> str:
    label, amount = ACTIONS.get(c["action"], c["action"].replace("_", " ").title()), c.get("amount") or 0
    return f"{label} by {amount:.0f}%" if amount > 0 and c["action"] in ("increase", "reduce") else label


def _foremost(options: list[tuple[str, str, Column]]) -> Column:
    """Text of the strongest of (text, group, strength); null where none fires.

    Of groups that are equally strong the one that fires first in the order given; within it its first strongest.
    """
    if not options:
        return F.lit(None).cast("string")
    rows = F.filter(F.array(*[F.struct(F.lit(t).alias("t"), F.lit(g).alias("g"), s.alias("s")) for t, g, s in options]), lambda o: o["s"] > 0)
    return F.transform(F.array(rows), _pick)[0]


def _pick(rows: Column) -> Column:
    top = F.filter(rows, lambda o: o["s"] == F.array_max(F.transform(rows, lambda p: p["s"])))
    group = F.get(F.filter(rows, lambda o: F.exists(top, lambda p: p["g"] == o["g"])), 0)["g"]
    return F.get(F.filter(top, lambda o: o["g"] == group), 0)["t"]
