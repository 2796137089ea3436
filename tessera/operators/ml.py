"""Model operators: leakage guards, fold assignment, selection, cross-validated pipelines, ensembles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.leakage import is_leaky, safe_features

__all__ = ["is_leaky", "safe_features"]

def scheme(n: int, groups: int | None = None) -> str:
    """Cross-validation by size: refuse, leave one out, repeated folds; the same by groups."""
    if groups is not None:
        return "refuse" if groups < 3 else "leave-one-group-out" if groups < 10 else "grouped-5-fold"
    return "refuse" if n < 8 else "leave-one-out" if n < 30 else "repeated-5x3"


def fold(group: Column, k: int = 5) -> Column:
    """Fold of a group by md5, the same on every engine and run."""
    return (F.conv(F.substring(F.md5(group.cast("string")), 1, 8), 16, 10).cast("bigint") % k).cast("int")


def overlap(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> int:
    """Distinct rows of test that train has too; nulls are equal."""
    return test.select(*columns).intersect(train.select(*columns)).count()


def select_features(profile: DataFrame, corr: DataFrame, importance: dict[str, float], missing: float = 0.5, variance: float = 1e-3, limit: float = 0.9, least: float = 0.01, most: int = 150) -> list[str]:
    """Names kept by missing share, variance, correlation (the less important of a pair goes), importance, and number.

    profile: column_name, missing_share, variance; corr: a, b, r.  Both have one row per column or pair.
    """
    kept = [r.column_name for r in profile.orderBy("column_name").collect() if r.missing_share <= missing and (r.variance or 0) > variance]
    gone: set[str] = set()
    for r in corr.filter(F.abs("r") >= limit).orderBy(F.abs("r").desc(), "a", "b").collect():
        if r.a in kept and r.b in kept and not {r.a, r.b} & gone:
            gone.add(min((r.a, r.b), key=lambda c: (importance.get(c, 0), c)))
    kept = [c for c in kept if c not in gone and importance.get(c, 0) >= least]
    return sorted(kept, key=lambda c: (-importance.get(c, 0), c))[:most]


def model(kind: str, seed: int = 42):
    from pyspark.ml import regression as R

    pool = {
        "linear": lambda: R.LinearRegression(featuresCol="features", labelCol="label", solver="normal"),
        "ridge": lambda: R.LinearRegression(featuresCol="features", labelCol="label", regParam=1.0, elasticNetParam=0.0),
        "lasso": lambda: R.LinearRegression(featuresCol="features", labelCol="label", regParam=0.1, elasticNetParam=1.0),
        "elastic": lambda: R.LinearRegression(featuresCol="features", labelCol="label", regParam=0.1, elasticNetParam=0.5),
        "forest": lambda: R.RandomForestRegressor(featuresCol="features", labelCol="label", numTrees=20, maxDepth=6, seed=seed),
        "boosted": lambda: R.GBTRegressor(featuresCol="features", labelCol="label", maxIter=10, maxDepth=4, seed=seed),
    }
    return pool[kind]()


def cross_validated(df: DataFrame, features: Sequence[str], target: str, group: Column, kind: str = "ridge", k: int = 5) -> DataFrame:
    """Rows with their out-of-fold ``prediction``; medians are imputed inside each training fold."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import Imputer, VectorAssembler

    num = df.select("*", fold(group, k).alias("_fold")).withColumns({f"_f_{c}": F.col(c).cast("double") for c in features} | {"label": F.col(target).cast("double")}).filter("label is not null")
    ins, outs = [f"_f_{c}" for c in features], [f"_i_{c}" for c in features]
    steps = Pipeline(stages=[Imputer(strategy="median", inputCols=ins, outputCols=outs, relativeError=0.0001), VectorAssembler(inputCols=outs, outputCol="features"), model(kind)])
    out = None
    for i in range(k):
        test = steps.fit(num.filter(F.col("_fold") != i)).transform(num.filter(F.col("_fold") == i)).select(*df.columns, "_fold", "label", "prediction")
        out = test if out is None else out.union(test)
    return out


def ensemble_weights(r2: dict[str, float]) -> dict[str, float]:
    """Weights max(0, r2) / sum; equal if all are 0."""
    positive = {k: max(0.0, v) for k, v in r2.items()}
    total = sum(positive.values())
    return {k: (v / total if total else 1 / len(r2)) for k, v in positive.items()}


def deploy(current: float | None, candidate: float, margin: float = 0.0) -> bool:
    return current is None or candidate > current + margin
