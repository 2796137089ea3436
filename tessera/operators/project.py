"""Projections, gates, provenance tags and evidence predicates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names that say what a column is
LATITUDE = ("lat", "latitude", "y_coord")
LONGITUDE = ("lon", "lng", "long", "longitude", "x_coord")
DATES = ("date", "day", "time", "year", "ts")
CROPS = ("crop", "crop_name", "species")


def detect(columns: Sequence[str], names: Sequence[str]) -> str | None:
    """First column whose normalised name is one of the names, else one that has a name as a whole part."""
    norm = {c: re.sub(r"[^a-z0-9]+", "_", c.lower()).strip("_") for c in columns}
    exact = [c for c in columns if norm[c] in names]
    part = [c for c in columns if set(norm[c].split("_")) & set(names)]
    return (exact or part or [None])[0]


def gate(df: DataFrame) -> DataFrame:
    """Accepted rows by ``_validation_status``, else by ``_is_valid``, else all; a null status is not accepted."""
    if "_validation_status" in df.columns:
        return df.filter(F.col("_validation_status") == "ACCEPTED")
    return df.filter(F.col("_is_valid")) if "_is_valid" in df.columns else df


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t in ("tinyint", "smallint", "int", "bigint", "float", "double") or t.startswith("decimal")]


def drop_empty(df: DataFrame) -> DataFrame:
    """Without the columns that are null throughout; one aggregate."""
    row = df.agg(*[F.count(c).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if row[c]])


def blank_outside(c: Column, low: float, high: float) -> Column:
    """Null outside the range; values are never clamped."""
    return F.when(c.between(low, high), c)


def verified(df: DataFrame, original: str, quality: str, least: float) -> DataFrame:
    return df.filter(F.col(original) & (F.coalesce(F.col(quality), F.lit(0.0)) >= least))


def tag(df: DataFrame, defaults: dict[str, object], confidence: dict[str, float], method: str = "method") -> DataFrame:
    """Provenance columns where absent, and the confidence of the row's method (0.5 if unknown)."""
    out = {c: F.lit(v) for c, v in defaults.items() if c not in df.columns}
    steps = F.create_map(*[F.lit(x) for p in confidence.items() for x in p])
    return df.withColumns(out).withColumn("confidence", F.coalesce(F.try_element_at(steps, F.col(method)), F.lit(0.5)))


def derived_columns(columns: Sequence[str], words: Sequence[str] = ("index", "ratio", "score", "_x_", "log_", "predicted")) -> list[str]:
    return [c for c in columns if any(w in c.lower() for w in words)]


def schema_diff(before: DataFrame, after: DataFrame) -> dict[str, list[str]]:
    return {"added": [c for c in after.columns if c not in before.columns], "removed": [c for c in before.columns if c not in after.columns]}


def evidence_confidence(value: Column, text: Column, mentions: Column) -> Column:
    """Null for an empty value; high for several mentions, or one beside a text over 20; medium for one, or a text over 10."""
    n = F.coalesce(F.length(text), F.lit(0))
    step = F.when((mentions > 1) | ((mentions > 0) & (n > 20)), "high").when((mentions > 0) | (n > 10), "medium").otherwise("low")
    return F.when(F.trim(F.coalesce(value, F.lit(""))) != "", step)


def extraction_range(value: Column, low: Column, high: Column) -> Column:
    """struct(number, confidence, note): the first number of a string against bounds."""
    x = F.regexp_extract(value, r"[-+]?\d+(?:\.\d+)?", 0).try_cast("double")
    bad = (x < low) | (x > high)
    return F.struct(x.alias("number"), F.when(x.isNull() | bad, "low").otherwise("high").alias("confidence"), F.when(bad, "out of range").alias("note"))


def manifest(files: DataFrame, required: Sequence[str]) -> DataFrame:
    """path, hash and the required metadata keys that a JSON sidecar column lacks."""
    have = F.coalesce(F.json_object_keys("meta"), F.array().cast("array<string>"))
    return files.select("path", F.sha2("content", 256).alias("hash"), F.array_except(F.array(*[F.lit(r) for r in required]), have).alias("missing"))


def is_treatment_label(c: Column) -> Column:
    """Whether a first cell names a treatment: no statistic, factor heading, year, bare number, product of factors or measured variable."""
    s = F.lower(F.trim(c))
    stat = s.rlike(r"^(mean|average|s\.?e\.?m?\.?|s\.?d\.?|lsd|cd|cv|c\.d\.|c\.v\.|p[- ]?value|significance|f[- ]?test|ns|total)\b")
    unit = F.regexp_extract(s, r"\((?:cm|mm|m|g|kg|t|q|%|n\.?\s*m|kg\s*hl|°c|days?|no\.?)\b[^)]*\)?", 0)
    stat = stat | s.rlike(r"^[a-z]{1,3}\s*([x×*]\s*[a-z]{1,3}\s*)+$") | s.rlike(r"^[a-z]$") | ((unit != "") & ~unit.rlike(r"\d\s*[a-z%]"))
    return s.isNotNull() & (s != "") & ~stat & ~s.rlike(r"^(19|20)\d{2}([-/]\d{2,4})?$") & ~s.rlike(r"^[-+]?\d+(\.\d+)?$") & ~s.rlike(r"^(factor|treatments?|year|season|source)s?\b")


def lines_to_cells(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, table_no, row_no, col_no, cell): lines split at tabs, bars or double spaces; blank or one-cell lines end a table."""
    lines = F.split(text, "\n")
    cells = lambda line: F.filter(F.transform(F.split(line, r"\t+|\s{2,}|\|"), lambda x: F.trim(x)), lambda x: x != "")
    start = F.struct(F.lit(0).alias("t"), F.lit(0).alias("r"), F.array().cast("array<struct<t:int,r:int,cells:array<string>>>").alias("out"))

    def step(acc, row):
        wide = F.size(row) >= 2
        keep = F.struct(acc["t"].alias("t"), acc["r"].alias("r"), row.alias("cells"))
        ended = F.struct((acc["t"] + F.when(acc["r"] > 0, 1).otherwise(0)).cast("int").alias("t"), F.lit(0).alias("r"), acc["out"].alias("out"))
        return F.when(wide, F.struct(acc["t"].alias("t"), (acc["r"] + 1).cast("int").alias("r"), F.concat(acc["out"], F.array(keep)).alias("out"))).otherwise(ended)

    rows = F.aggregate(F.transform(lines, cells), start, step, lambda a: a["out"])
    return df.select(key, F.explode_outer(rows).alias("x")).filter("x is not null").select(key, F.col("x.t").alias("table_no"), F.col("x.r").alias("row_no"), F.posexplode("x.cells").alias("col_no", "cell"))
