"""Text column expressions: identifiers, titles, measurements, units, classification ladders."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DOI = r"10\.\d{4,9}/\S+"

# Unit token -> (dimension, factor to the dimension's base unit)
UNITS = {
    "kg/ha": ("mass_per_area", 1.0), "t/ha": ("mass_per_area", 1000.0), "q/ha": ("mass_per_area", 100.0), "g/m2": ("mass_per_area", 10.0),
    "%": ("fraction", 1.0), "g/100g": ("fraction", 1.0), "g/kg": ("fraction", 0.1), "mg/g": ("fraction", 0.1), "mg/kg": ("fraction", 1e-4), "ppm": ("fraction", 1e-4),
    "cm": ("length", 1.0), "mm": ("length", 0.1), "m": ("length", 100.0),
    "g": ("mass", 1.0), "kg": ("mass", 1000.0), "mg": ("mass", 0.001),
    "ds/m": ("conductivity", 1.0), "ms/cm": ("conductivity", 1.0), "us/cm": ("conductivity", 0.001),
}
# Standard atomic weights
ATOMIC = {"O": 15.999, "Na": 22.98976928, "Mg": 24.305, "P": 30.973762, "S": 32.06, "K": 39.0983, "Ca": 40.078}
OXIDES = {"P2O5": ("P", 2, 5), "K2O": ("K", 2, 1), "CaO": ("Ca", 1, 1), "MgO": ("Mg", 1, 1), "SO3": ("S", 1, 3), "Na2O": ("Na", 2, 1)}


def oxide_factor(formula: str) -> float:
    """Mass of the element in one unit of its oxide."""
    element, n, oxygen = OXIDES[formula]
    return n * ATOMIC[element] / (n * ATOMIC[element] + oxygen * ATOMIC["O"])


def normalize_doi(c: Column) -> Column:
    """Lower-case DOI without resolver or scheme; null where the rest is no DOI."""
    bare = F.regexp_replace(F.lower(F.trim(c)), r"^(https?://doi\.org/|doi:)", "")
    return F.when(bare.rlike(rf"^\s*{DOI}$"), F.trim(bare))


def extract_dois(c: Column) -> Column:
    """All DOIs of a text, trailing punctuation cut, in order, each once."""
    raw = F.regexp_extract_all(F.lower(c), F.lit(r"(10\.\d{4,9}/[^\s\"<>]+)"), F.lit(1))
    return F.array_distinct(F.transform(raw, lambda d: F.regexp_replace(d, r"[.,);\]}]+$", "")))


def normalize_title(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(c), "[^a-z0-9]+", " "))


def normalize_name(c: Column) -> Column:
    """Column-name form: spaces and dashes become underscores, anything else but [a-z0-9_] goes."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(c)), r"[\s-]+", "_"), "[^a-z0-9_]", "")


def parse_measurement(c: Column) -> Column:
    """First number of a table cell: cut at the plus-minus sign, letters and marks and thousands separators removed."""
    head = F.split(c, "±")[0]
    bare = F.regexp_replace(F.regexp_replace(head, "[A-Za-z*†‡]", ""), r"(?<=\d)[ ,](?=\d{3}(?!\d))", "")
    return F.when(F.trim(bare).rlike(r"^[+-]?\d+(\.\d+)?$"), F.trim(bare).try_cast("double"))


def statistic(c: Column) -> Column:
    """struct(kind, value, spread, letters): mean ± sd, value (se), interval, LSD, CD, CV, letters, number, in this order."""
    num = r"([-+]?\d+(?:\.\d+)?)"
    forms = [
        ("mean_sd", rf"^\s*{num}\s*(?:±|\+/-)\s*{num}", 1, 2),
        ("mean_se", rf"^\s*{num}\s*\(\s*{num}\s*\)", 1, 2),
        ("interval", rf"^\s*{num}\s*(?:-|–|to)\s*{num}\s*$", 1, 2),
        ("lsd", rf"(?i)LSD[^0-9]*{num}", 1, 0),
        ("cd", rf"(?i)\bCD[^0-9]*{num}", 1, 0),
        ("cv", rf"(?i)\bCV[^0-9]*{num}", 1, 0),
        ("letters", rf"^\s*{num}\s*([a-e]{{1,4}})\s*$", 1, 0),
        ("number", rf"^\s*{num}\s*$", 1, 0),
    ]
    out = F.lit(None).cast("struct<kind:string,value:double,spread:double,letters:string>")
    for kind, p, v, s in reversed(forms):
        group = lambda i, p=p: F.regexp_extract(c, p, i)
        spread = group(s).try_cast("double") if s else F.lit(None).cast("double")
        letters = group(2) if kind == "letters" else F.lit(None).cast("string")
        out = F.when(c.rlike(p), F.struct(F.lit(kind).alias("kind"), group(v).try_cast("double").alias("value"), spread.alias("spread"), letters.alias("letters"))).otherwise(out)
    return out


def dose(c: Column) -> Column:
    """struct(value, unit, per) of the first dose like ``120 kg/ha`` or ``5 ml per litre``; null without one."""
    p = r"(?i)(\d+(?:\.\d+)?)\s*(kg|g|mg|t|q|ml|l)\s*(?:/|per\s+|\s)(ha|hectare|acre|plant|litre|liter|l|m2|plot)\b"
    part = lambda i: F.lower(F.regexp_extract(c, p, i))
    return F.when(c.rlike(p), F.struct(part(1).try_cast("double").alias("value"), part(2).alias("unit"), part(3).alias("per")))


def npk(c: Column) -> Column:
    """struct(n, p, k), elemental, of an N-P2O5-K2O ratio like ``120:60:40``; null without one."""
    p = r"(\d+(?:\.\d+)?)\s*[:\-]\s*(\d+(?:\.\d+)?)\s*[:\-]\s*(\d+(?:\.\d+)?)"
    part = lambda i: F.regexp_extract(c, p, i).try_cast("double")
    return F.when(c.rlike(p), F.struct(part(1).alias("n"), (part(2) * oxide_factor("P2O5")).alias("p"), (part(3) * oxide_factor("K2O")).alias("k")))


def normalize_unit(c: Column) -> Column:
    """Canonical unit token or null: case, spaces, dots, exponents and inverse marks are folded."""
    u = F.lower(F.trim(c))
    for old, new in (("−", "-"), ("·", ""), (" ", ""), ("°", ""), ("^", ""), ("hm-2", "ha"), ("hm2", "ha"), ("m-2", "m2")):
        u = F.replace(u, F.lit(old), F.lit(new))
    u = F.replace(F.regexp_replace(u, "(-1|\\b1)$", ""), F.lit("-"), F.lit("/"))
    joined = {token.replace("/", ""): token for token in UNITS if "/" in token}
    known = F.create_map(*[F.lit(x) for token in UNITS for x in (token, token)], *[F.lit(x) for pair in joined.items() for x in pair if pair[0] not in UNITS])
    heat = F.when(u.isin("c", "cel", "celsius", "degc"), "cel").when(u.isin("f", "fahrenheit", "degf"), "f").when(u.isin("k", "kelvin"), "k")
    return F.coalesce(heat, F.try_element_at(known, u))


def convert_unit(value: Column, source: Column, target: Column) -> Column:
    """struct(value, ok, reason): converted inside a dimension, refused across dimensions, else passed on unverified."""
    s, t = normalize_unit(source), normalize_unit(target)
    dim = F.create_map(*[F.lit(x) for k, (d, _) in UNITS.items() for x in (k, d)])
    factor = F.create_map(*[F.lit(x) for k, (_, f) in UNITS.items() for x in (k, f)])
    heat = ["cel", "f", "k"]
    celsius = F.when(s == "f", (value - 32.0) * 5.0 / 9.0).when(s == "k", value - 273.15).otherwise(value)
    out = lambda v, ok, why: F.struct(v.alias("value"), F.lit(ok).alias("ok"), F.lit(why).alias("reason"))
    return (
        F.when(target.isNull(), out(value, True, "no target"))
        .when(s.isNull(), out(value, True, "unverified"))
        .when(s.isin(*heat) & (t == "cel"), out(celsius, True, "temperature"))
        .when(s.isin(*heat) | F.coalesce(t == "cel", F.lit(False)), out(value, False, "incompatible"))
        .when(t.isNull() | F.try_element_at(dim, t).isNull(), out(value, True, "unverified"))
        .when(F.try_element_at(dim, s) != F.try_element_at(dim, t), out(value, False, "incompatible"))
        .otherwise(out(value * F.try_element_at(factor, s) / F.try_element_at(factor, t), True, "converted"))
    )


# Publication types by the first substring that occurs
TYPE_LADDER = [
    ("review", ["review"]), ("editorial", ["editor"]), ("letter", ["letter"]), ("conference-abstract", ["abstract", "meeting", "conference"]),
    ("patent", ["patent"]), ("erratum", ["retraction", "erratum", "corrigendum"]), ("preprint", ["preprint"]),
    ("journal-article", ["journal", "article", "research", "original"]), ("dataset", ["dataset", "data paper"]), ("book-chapter", ["book", "chapter"]),
]


def ladder(c: Column, steps: list[tuple[str, list[str]]], default: Column | None = None) -> Column:
    """Label of the first step one of whose substrings the lower-cased text has."""
    low, out = F.lower(F.trim(c)), default if default is not None else F.lit(None).cast("string")
    for label, needles in reversed(steps):
        test = F.lit(False)
        for n in needles:
            test = test | low.contains(n)
        out = F.when(test, label).otherwise(out)
    return F.when(low.isNotNull() & (low != ""), out)


def publication_type(c: Column) -> Column:
    return ladder(c, TYPE_LADDER, F.lower(F.trim(c)))


def labels(c: Column, patterns: list[tuple[str, str]]) -> Column:
    """Labels of all patterns that a lower-cased text matches, in the order of the patterns."""
    return F.array_compact(F.array(*[F.when(F.lower(c).rlike(p), F.lit(label)) for p, label in patterns]))


def best_type(c: Column, families: dict[str, list[str]], default: str) -> Column:
    """Family with the most patterns that match; the first one wins ties, none gives the default."""
    hits = {k: sum((F.coalesce(c.rlike(p), F.lit(False)).cast("int") for p in ps), F.lit(0)) for k, ps in families.items()}
    most = F.greatest(*hits.values()) if len(hits) > 1 else next(iter(hits.values()))
    out = F.lit(default)
    for k, n in reversed(hits.items()):
        out = F.when((n == most) & (most > 0), k).otherwise(out)
    return out


def grounded(value: Column, quote: Column) -> Column:
    """Whether a number stands in a quote, within the larger of 0.01 and 0.1 %."""
    numbers = F.regexp_extract_all(F.replace(quote, F.lit(","), F.lit("")), F.lit(r"[-+]?\d+(?:\.\d+)?"), F.lit(0))
    return F.exists(numbers, lambda n: F.abs(n.try_cast("double") - value) <= F.greatest(F.lit(0.01), F.abs(value) * 1e-3))


def short_hash(c: Column, size: int = 16) -> Column:
    return F.substring(F.sha2(c, 256), 1, size)


def version_key(c: Column) -> Column:
    """Array of integers of a dotted version; arrays compare in order."""
    return F.transform(F.split(c, r"\."), lambda p: F.coalesce(F.regexp_extract(p, r"(\d+)", 1).try_cast("int"), F.lit(0)))


def safe_name(c: Column) -> Column:
    return F.regexp_replace(c, "[^A-Za-z0-9_.-]+", "_")


def ratio(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two texts, 0 where one is missing or empty.  Arrow batches."""

    @F.pandas_udf("double")
    def of(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([SequenceMatcher(None, p, q).ratio() if p and q else 0.0 for p, q in zip(x, y)])

    return of(a, b)


def title_similarity(a: Column, b: Column) -> Column:
    """Ratcliff-Obershelp ratio of two normalised titles, 0 where one is missing.  Arrow batches; run it after blocking."""
    return ratio(normalize_title(a), normalize_title(b))
