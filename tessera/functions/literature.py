"""Literature predicates, query strings, nutrient bases and dataset matching."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import OXIDES, labels, normalize_doi, normalize_title, publication_type, title_similarity

# Types, words and designs that tell original experiments from other texts
NOT_ORIGINAL = ["review", "book-review", "editorial", "letter", "editorial-letter", "conference-abstract", "proceedings-abstract", "meeting-abstract", "patent", "patent-application", "retraction", "corrigendum", "erratum", "reference-entry"]
TITLE_EXCLUDES = ["editorial", "letter to the editor", "book review", "conference abstract", "abstract only", "retraction", "corrigendum", "erratum", "patent"]
ABSTRACT_EXCLUDES = ["we review", "this review", "the review", "literature review", "systematic review", "meta-analysis", "meta analysis"]
SIMULATION = ["simulation study", "modeling study", "modelling study", "in silico", "computational model", "we simulated", "we modeled", "we modelled"]
EXPERIMENT = ["field trial", "field experiment", "field test", "rcbd", "randomized complete block", "randomized block", "split plot", "split-plot", "factorial", "strip plot", "latin square", "trial", "experiment", "treatments", "replicated", "plot"]
DESIGNS = [
    (r"rcbd|randomized\s+complete\s+block", "Randomized Complete Block Design"), (r"randomized\s+block", "Randomized Block Design"), (r"split[\s-]*plot", "Split Plot"),
    (r"split[\s-]*split[\s-]*plot", "Split-Split Plot"), (r"factorial", "Factorial"), (r"strip[\s-]*plot", "Strip Plot"), (r"latin\s+square", "Latin Square"),
    (r"crd|completely\s+randomized", "Completely Randomized Design"), (r"rcbd|augmented\s+design", "Augmented Design"),
]

CROPS = [
    (r"\brice\b", "Rice"), (r"\bwheat\b", "Wheat"), (r"\bmaize\b|\bcorn\b", "Maize"), (r"\bsorghum\b", "Sorghum"), (r"\bmillet\b|\bpearl millet\b", "Millet"), (r"\bbarley\b", "Barley"),
    (r"\bsoybean\b|\bsoya\b", "Soybean"), (r"\bgroundnut\b|\bpeanut\b", "Groundnut"), (r"\bchickpea\b|\bgram\b", "Chickpea"), (r"\bpigeon pea\b|\btoor\b|\bred gram\b", "Pigeon Pea"),
    (r"\blentil\b", "Lentil"), (r"\bsugarcane\b", "Sugarcane"), (r"\bcotton\b", "Cotton"), (r"\bpotato\b", "Potato"), (r"\btomato\b", "Tomato"), (r"\bpepper\b|\bbell pepper\b", "Pepper"),
    (r"\bonion\b", "Onion"), (r"\bcarrot\b", "Carrot"), (r"\bspinach\b", "Spinach"), (r"\bcabbage\b|\bbrassica\b", "Cabbage"), (r"\bcanola\b|\brapeseed\b", "Canola"),
    (r"\bsunflower\b", "Sunflower"), (r"\btea\b", "Tea"), (r"\bcoffee\b", "Coffee"), (r"\brubber\b", "Rubber"), (r"\bmaize-wheat\b", "Maize-Wheat System"), (r"\brice-wheat\b", "Rice-Wheat System"),
]
VARIABLES = [  # matched against lower-cased text, so that the single capitals never match
    (r"\bN\b|nitrogen", "Nitrogen"), (r"\bP\b|phosphorus|phosphate", "Phosphorus"), (r"\bK\b|potassium|potash", "Potassium"), (r"micronutrient", "Micronutrients"), (r"irrigation|water\s+use", "Irrigation"),
    (r"plant\s+density|planting\s+density|spacing", "Plant Density"), (r"sowing\s+date|planting\s+date", "Sowing Date"), (r"cultivar|variety|genotype", "Cultivar Evaluation"), (r"yield", "Yield"),
    (r"biomass", "Biomass"), (r"soil\s+properties|soil\s+physical|soil\s+chemical", "Soil Properties"), (r"weather|rainfall|temperature|climat", "Weather Observations"),
    (r"fertilizer|fertiliser|manure|compost", "Fertilizer Response"), (r"nue|nutrient\s+use\s+efficiency", "Nutrient Use Efficiency"),
]


def has_any(c: Column, words: Sequence[str]) -> Column:
    low, out = F.lower(F.coalesce(c, F.lit(""))), F.lit(False)
    for w in words:
        out = out | low.contains(w)
    return out


def is_original(kind: Column, title: Column, abstract: Column) -> Column:
    """Whether a record is likely an original experiment; without a sign of one it is not."""
    text = F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))
    excluded = F.coalesce(publication_type(kind).isin(*NOT_ORIGINAL), F.lit(False)) | has_any(title, TITLE_EXCLUDES) | has_any(abstract, ABSTRACT_EXCLUDES)
    experiment = has_any(text, EXPERIMENT)
    return ~excluded & ~(has_any(text, SIMULATION) & ~experiment) & ((F.size(labels(text, DESIGNS)) > 0) | experiment)


def _quoted(term: str) -> str:
    return f'"{term}"' if " " in term else term


def boolean_queries(studies: Sequence[str], treatments: Sequence[str]) -> list[str]:
    """One query per study term, joined with all treatment terms."""
    either = " OR ".join(map(_quoted, treatments))
    return [f"{_quoted(s)} AND ({either})" for s in studies]


def simple_queries(studies: Sequence[str], contexts: Sequence[str]) -> list[str]:
    return [f"{_quoted(s)} AND {_quoted(c)}" for s in studies for c in contexts]


# Names of elements, and words that leave the basis open
ELEMENTS = {"p": "P", "phosphorus": "P", "phosphorous": "P", "k": "K", "potassium": "K", "ca": "Ca", "calcium": "Ca", "mg": "Mg", "magnesium": "Mg", "s": "S", "sulphur": "S", "sulfur": "S", "na": "Na", "sodium": "Na"}
OPEN = {"phosphate", "phosphoric", "potash", "muriate", "superphosphate", "mop", "sop", "dap", "ssp", "tsp"}
OXIDE_WORDS = {"oxide", "pentoxide", "trioxide", "monoxide"}


def basis(label: str) -> tuple[str, str | None]:
    """(oxide, elemental, ambiguous or unknown; formula or element) of a column label; plan-time only.

    A formula wins over an element's name; a mass unit before another unit is no element.
    """
    digits = str.maketrans("₀₁₂₃₄₅₆₇₈₉", "0123456789")
    words = re.sub(r"[^a-z0-9]+", " ", (label or "").translate(digits).lower()).split()
    packed = [re.sub(r"\s+", "", " ".join(words[i:j])) for i in range(len(words)) for j in range(i + 1, min(len(words), i + 4) + 1)]
    for formula in OXIDES:
        if formula.lower() in packed:
            return "oxide", formula
    units = {"kg", "g", "l", "ha", "m2", "m3", "ml", "plant", "pot"}
    named = [ELEMENTS[w] for i, w in enumerate(words) if w in ELEMENTS and not (w in ("mg", "g", "kg") and i + 1 < len(words) and words[i + 1] in units)]
    if OXIDE_WORDS & set(words) and named:
        return "oxide", next((f for f, (e, _, _) in OXIDES.items() if e == named[0]), None)
    if OPEN & set(words):
        return "ambiguous", None
    return ("elemental", named[0]) if named else ("unknown", None)


def belongs_to(sources: DataFrame, papers: DataFrame, block: Column | None = None, least: float = 0.95) -> DataFrame:
    """(source_id, paper_id): the same id, the same DOI, or titles alike (with a block, only inside it); the smallest paper wins.

    Both sides: id, doi, title.  A union of equi-joins, never a disjunctive join.
    """
    b = F.lit(None) if block is None else block
    s = sources.select(F.col("id").alias("source_id"), normalize_doi(F.col("doi")).alias("doi"), "title", b.alias("b"))
    p = papers.select(F.col("id").alias("paper_id"), normalize_doi(F.col("doi")).alias("doi"), F.col("title").alias("paper_title"), b.alias("b"))
    same = s.join(p.select("paper_id"), s.source_id == F.col("paper_id")).select("source_id", "paper_id")
    doi = s.join(p.select("paper_id", "doi"), "doi").select("source_id", "paper_id")
    if block is None:
        from tessera.operators.fusion import title_pairs

        n, m = s.select("source_id", normalize_title(F.col("title")).alias("p")).filter("p <> ''"), p.select("paper_id", normalize_title(F.col("paper_title")).alias("q")).filter("q <> ''")
        # the smallest paper of a title stands for all
        m = m.groupBy("q").agg(F.min("paper_id").alias("paper_id"))
        pairs = title_pairs(n.select(F.col("p").alias("n")).union(m.select("q")).distinct(), least).select("p", "q")
        alike = n.join(pairs, "p").join(m, "q").select("source_id", "paper_id").union(n.join(m, F.col("p") == F.col("q")).select("source_id", "paper_id"))
    else:
        alike = s.join(p.select("paper_id", "paper_title", "b"), "b").filter(title_similarity(F.col("title"), F.col("paper_title")) >= least).select("source_id", "paper_id")
    return same.union(doi).union(alike).groupBy("source_id").agg(F.min("paper_id").alias("paper_id"))
