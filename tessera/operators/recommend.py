"""Recommendation and score expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.numeric import clip, row_mean

# Product and grade by the first nutrient that is low
LOW_NUTRIENT = [("N", "Urea", "46-0-0"), ("P", "DAP", "18-46-0"), ("K", "MOP", "0-0-60")]
ORGANIC = ["Bio NPK", "Jaivik Khad", "Vermicompost", "FYM"]
DEFAULT = "Bio NPK"


def fertilizer(n: Column, p: Column, k: Column, given: Column, preferred: Column) -> Column:
    """Product for the first low nutrient, else the given one, else the preferred one, else the default."""
    out = F.coalesce(given, preferred, F.lit(DEFAULT))
    for status, (_, name, _) in reversed(list(zip((n, p, k), LOW_NUTRIENT))):
        out = F.when(status == "low", name).otherwise(out)
    return out


def dose(base: Column, n_status: Column, rain: Column, ph: Column) -> Column:
    """Base dose (100 if missing) adjusted for nitrogen status, rainfall and acidity, to one place."""
    d = F.coalesce(base, F.lit(100.0)) * F.when(n_status == "low", 1.25).when(n_status == "high", 0.75).otherwise(1.0)
    d = d * F.when(rain > 1200, 0.90).when(rain < 400, 1.10).otherwise(1.0)
    return F.bround(d * F.when(ph < 5.5, 1.05).when(ph > 7.5, 0.95).otherwise(1.0), 1)


def interval(base: Column, rain: Column, heat: Column) -> Column:
    d = F.coalesce(base, F.lit(10.0)) * F.when(rain > 1000, 1.5).when(rain < 500, 0.75).otherwise(1.0)
    return F.bround(d * F.when(heat > 35, 0.85).when(heat < 15, 1.15).otherwise(1.0), 1)


def increase(predicted: Column, baseline: Column) -> Column:
    return F.when(baseline > 0, F.round(predicted - baseline, 2))


def economic(gain: Column, cost_per_kg: Column, dose_: Column, per_ton: float = 25000.0, full: float = 10.0) -> Column:
    """Return on cost, 1 at ``full`` times the cost; null without an expected gain."""
    cost, revenue = cost_per_kg * dose_, gain / 1000.0 * per_ton
    return F.when(revenue > 0, F.when(cost > 0, F.round(clip(revenue / cost / full, 0, 1), 3)).otherwise(0.7))


def environmental(product: Column, dose_: Column) -> Column:
    chemical = F.when(dose_ < 50, 0.7).when(dose_ < 100, 0.5).when(dose_ < 200, 0.4).when(dose_.isNotNull(), 0.3).otherwise(0.5)
    return F.when(product.isin(*ORGANIC), 0.9).when(product.contains("Bio") | F.lower(product).contains("organic"), 0.8).otherwise(chemical)


def risk(*scores: Column) -> Column:
    return clip(F.round(1 - row_mean(*scores), 3), 0, 1)


def top_choices(choices: Sequence[tuple[str, Column]], k: int = 3) -> Column:
    """array<struct<name, score>>: the k best of a list of scored names, ties in the order given."""
    items = F.array(*[F.struct((-s).alias("neg"), F.lit(i).alias("nth"), F.lit(n).alias("name"), s.alias("score")) for i, (n, s) in enumerate(choices)])
    return F.transform(F.slice(F.array_sort(items), 1, k), lambda x: F.struct(x["name"].alias("name"), x["score"].alias("score")))


def ensemble(predictions: Sequence[Column]) -> dict[str, Column]:
    """Mean, deviation (n - 1), confidence 1 / (1 + cv) and interval of several predictions."""
    n = float(len(predictions))
    mean = sum(predictions, F.lit(0.0)) / n
    sd = F.sqrt(sum(((p - mean) * (p - mean) for p in predictions), F.lit(0.0)) / (n - 1))
    conf = 1 / (1 + sd / F.when(mean != 0, F.abs(mean)))
    half = 1.96 * (1 - conf) * F.abs(mean)
    return {"mean": mean, "sd": sd, "confidence": conf, "low": mean - half, "high": mean + half, "tier": F.when(conf >= 0.8, "low").when(conf >= 0.5, "medium").otherwise("high")}


def weighted(parts: dict[str, float]) -> Column:
    return sum((F.lit(w) * F.coalesce(F.col(c), F.lit(0.0)) for c, w in parts.items()), F.lit(0.0))
