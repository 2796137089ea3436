"""Which column of a published table holds treatments, yields and doses, over arrays of cells.

A header is an array of strings, a body an array of rows of strings; indexes count from 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.operators.project import is_treatment_label

# Words that name a yield, an area unit, a dose, a treatment, citations or an analysis
YIELD = r"(?i)\b(yield|gy|produc(?:tion|tivity)|output)\b"
AREA = r"(?i)\b(kg|t|q|mg|g)\s*[./·]?\s*(ha|hm\s*-?2?|m\s*[-−]?\s*2|plot|plant|pot)\b"
DOSE = r"(?i)\b(rate|applied|application|dose|dosage|level|added|amount)\b"
TREATMENT = r"(?i)\btreatments?\b|\bfertili[sz]er\b|\btreat\b"
CITATION = r"(?i)^\s*(citation|reference|references|source|study|author)s?\s*$"
ANALYSIS = (
    r"(?i)\b(correlation|regression|response surface|rmse|predicted vs|membership|entropy|weight coefficient|analysis of variance|anova|sums? of squares"
    r"|model\s+(?:evaluation|performance|parameter)|simulat|meta[-\s]?analy|systematic review|pooled|literature|previous stud|reported (?:in|by))\w*"
)
FITTED = r"(?i)\b(fitted|fitting|calibrat|sensitivity|r²)\w*"


def _first(cells: Column, test) -> Column:
    """Index of the first cell that passes; null without one."""
    place = F.array_position(F.transform(cells, lambda c: F.coalesce(test(c), F.lit(False))), True)
    return F.when(place > 0, (place - 1).cast("int"))


def _has(c: Column, pattern: str) -> Column:
    return F.coalesce(c, F.lit("")).rlike(pattern)


def treatment_column(header: Column, body: Column) -> Column:
    """The first column whose header names treatments, else the one with most treatment labels, the first of ties; 0 for an empty body."""
    widest = F.coalesce(F.array_max(F.transform(body, F.size)), F.lit(1))
    places = F.sequence(F.lit(0), F.greatest(widest, F.lit(1)) - 1)
    hits = F.transform(places, lambda i: F.size(F.filter(body, lambda row: F.coalesce(is_treatment_label(F.get(row, i)), F.lit(False)))))
    most = (F.array_position(hits, F.array_max(hits)) - 1).cast("int")
    return F.coalesce(_first(header, lambda c: c.rlike(TREATMENT)), F.when(F.size(body) > 0, most), F.lit(0))


def yield_column(header: Column, caption: Column) -> Column:
    """The first column that names a yield, one with an area unit (its own or the caption's) before one without; else null."""
    return F.coalesce(_first(header, lambda c: c.rlike(YIELD) & (c.rlike(AREA) | _has(caption, AREA))), _first(header, lambda c: c.rlike(YIELD)))


def is_analysis(caption: Column) -> Column:
    """Whether a caption is about an analysis rather than a trial's results."""
    return _has(caption, ANALYSIS) | (_has(caption, FITTED) & ~_has(caption, YIELD))


def problem(treatment: Column, yielding: Column, header: Column, caption: Column, unit: Column | None = None) -> Column:
    """Why chosen columns are not credible, checked in this order; null where they are."""
    cell = F.coalesce(F.get(header, yielding), F.lit(""))
    named = cell.rlike(YIELD) | (_has(caption, YIELD) & cell.rlike(AREA) & ~cell.rlike(DOSE))
    area = cell.rlike(AREA) | _has(caption, AREA) | (_has(unit, AREA) if unit is not None else F.lit(False))
    return (
        F.when(treatment.isNull() | yielding.isNull() | (treatment < 0) | (yielding < 0), "no usable column")
        .when(is_analysis(caption), "caption describes an analysis")
        .when(yielding >= F.size(header), "yield column outside the header")
        .when(F.exists(header, lambda c: _has(c, CITATION)), "rows cite other studies")
        .when(~named, "column does not name a yield")
        .when(~area, "no area unit")
    )


def dose_columns(proposed: Column, header: Column, yielding: Column) -> Column:
    """Those proposed columns whose header names a rate per area and no yield."""
    cell = lambda i: F.coalesce(F.get(header, i), F.lit(""))
    sound = lambda i: (i >= 0) & (i < F.size(header)) & ~i.eqNullSafe(yielding) & cell(i).rlike(DOSE) & cell(i).rlike(AREA) & ~cell(i).rlike(YIELD)
    return F.filter(F.coalesce(proposed, F.array().cast("array<int>")), sound)
