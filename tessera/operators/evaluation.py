"""Scores of tables, records and retrieved evidence, typed searches and package lineage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import numeric as N
from tessera.operators import profile
from tessera.operators.recommend import weighted
from tessera.operators.windows import top_per_group

# Weights of a reranked chunk, targets of a run, columns of the scores
RERANK = {
    "semantic_similarity": 0.20, "study_quality": 0.15, "extraction_confidence": 0.10, "observation_count": 0.10, "publication_year": 0.05, "meta_analysis_weight": 0.10,
    "evidence_grade": 0.15, "provenance_completeness": 0.05, "citation_frequency": 0.05, "crop_relevance": 0.05, "treatment_relevance": 0.05, "variable_importance": 0.05,
}
TARGETS = {
    "extraction_accuracy": (">=", 0.95), "schema_mapping_accuracy": (">=", 0.90), "missing_data_rate": ("<=", 0.10), "validation_pass_rate": (">=", 0.99),
    "feature_coverage": (">=", 0.95), "recommendation_confidence": (">=", 0.90), "reckoner_completeness": (">=", 0.95), "pipeline_success_rate": (">=", 0.99),
}
RECKONER = ["Crop", "Nitrogen", "Phosphorus", "Potassium", "Recommended_Fertilizer", "Recommended_Dose"]
IMPORTANT = ["Crop", "Nitrogen", "Phosphorus", "Potassium", "Soil_pH", "Yield_per_Hectare", "Rainfall"]
REPORTED = [*IMPORTANT, "Fertilizer_Name", "Dose"]
ENGINEERED = ["Growing_Degree_Days", "Heat_Units", "Harvest_Index_Calc", "Nitrogen_Use_Efficiency", "Water_Use_Efficiency", "Yield_per_Plant", "Yield_per_Hectare_Calc", "Temp_x_Rainfall", "N_x_P"]
REPRODUCIBLE = [({"Paper_ID", "DOI", "Year", "Authors"}, all), ({"Crop"}, all), ({"Location"}, all), ({"Soil_pH"}, all), ({"Temperature_Max", "Rainfall"}, any), ({"Yield_per_Plot", "Target_Yield"}, any)]
SERVICES = [
    "evidence", "crop", "variety", "variable", "soil", "climate", "nutrient", "treatment", "management", "location", "country", "year", "experiment", "paper",
    "observation", "ready_reckoner", "regression", "ml_dataset", "meta_analysis", "provenance", "knowledge_graph",
]


def missing_share(df: DataFrame) -> Column:
    """Share of null cells over all columns, as an aggregate; an empty table misses everything."""
    holes = sum((F.sum(F.col(f"`{c}`").isNull().cast("bigint")) for c in df.columns), F.lit(0))
    return F.coalesce(holes / F.nullif(F.count(F.lit(1)) * F.lit(float(len(df.columns) or 1)), F.lit(0.0)), F.lit(1.0))


def quality_points(df: DataFrame, core: Sequence[str], ontologies: float = 0.0, documents: float = 0.0) -> DataFrame:
    """One row of seven scores and their sum of at most 100.

    Columns decide five of them and are known without a scan; one aggregate counts the nulls.
    ontologies and documents are the shares of those that are there.
    """
    have = set(df.columns)
    words = any(t == "string" for _, t in df.dtypes)
    gap = df.agg(missing_share(df).alias("gap"))
    issues = (F.col("gap") > 0.1).cast("int") + F.lit(int(words) + int("Feature_Available_Before_Prediction" not in have))
    parts = {
        "schema_points": F.lit(20.0 * len(have & set(core)) / (len(set(core)) or 1)), "ontology_points": F.lit(10.0 * ontologies),
        "feature_points": F.lit(15.0 * len(have & set(ENGINEERED)) / len(ENGINEERED)), "missing_points": F.greatest(F.lit(0.0), (1 - F.col("gap")) * 15),
        "document_points": F.lit(10.0 * documents), "learning_points": F.greatest(F.lit(0.0), (1 - issues / 5) * 15),
        "repeat_points": F.lit(15.0 * sum(q(c in have for c in cs) for cs, q in REPRODUCIBLE) / len(REPRODUCIBLE)),
    }
    return gap.select(*[F.round(v, 4).alias(k) for k, v in parts.items()], F.round(F.least(F.lit(100.0), sum(parts.values(), F.lit(0.0))), 4).alias("total"))


def reckoner_metrics(df: DataFrame, keys: Sequence[str] = RECKONER) -> DataFrame:
    """Share of filled cells over those key columns that are there, what is missing and the usability; zeros without any."""
    there = [c for c in keys if c in df.columns]
    filled = sum((F.count(c) for c in there), F.lit(0)) / F.nullif(F.count(F.lit(1)) * F.lit(float(len(there) or 1)), F.lit(0.0))
    rate = F.coalesce(filled, F.lit(0.0)) if there else F.lit(0.0)
    lack = 1 - F.col("rate") if there else F.lit(0.0)
    usable = F.col("rate") * 0.8 + (1 - lack) * 0.2 if there else F.lit(0.0)
    return df.agg(F.max(F.lit(0)).alias("_none"), rate.alias("rate")).select(F.round("rate", 4).alias("population_rate"), F.round(lack, 4).alias("missing_values"), F.round("rate", 4).alias("completeness"), F.round(F.least(usable, F.lit(1.0)), 4).alias("usability_score"))


def meets_targets(metrics: DataFrame, targets: dict[str, tuple[str, float]] = TARGETS) -> DataFrame:
    """One row (metric, actual, target, passed) per target of a one-row table of metrics; an absent or null metric is 0."""
    rows = []
    for name, (sign, limit) in targets.items():
        actual = F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in metrics.columns else F.lit(0.0)
        rows.append(F.struct(F.lit(name).alias("metric"), F.round(actual, 4).alias("actual"), F.lit(limit).alias("target"), (actual >= limit if sign == ">=" else actual <= limit).alias("passed")))
    return metrics.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def filled_share(columns: Sequence[str], fields: Sequence[str] = IMPORTANT) -> Column:
    """Share of a row's important fields that hold a value; a field without a column holds none."""
    return F.round(sum((F.col(c).isNotNull().cast("int") for c in fields if c in columns), F.lit(0)) / len(fields), 4)


def lacking(columns: Sequence[str], fields: Sequence[str] = REPORTED) -> Column:
    """Names of those fields that have a column but no value in the row."""
    return F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in fields if c in columns]).cast("array<string>"))


def statistics(df: DataFrame, columns: Sequence[str], least: int = 3, limit: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(column, missing, skew, kurt), most missing first, and the pairs correlated above the limit.

    Skewness and kurtosis are corrected and null for at most `least` values.
    """
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        enough = F.count(x) > least
        aggs += [F.sum(F.col(c).isNull().cast("bigint")).alias(f"{c}__missing"), F.when(enough, F.round(N.skewness_g1(x), 3)).alias(f"{c}__skew"), F.when(enough, F.round(N.kurtosis_g2(x), 3)).alias(f"{c}__kurt")]
    rows = F.array(*[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{k}").alias(k) for k in ("missing", "skew", "kurt")]) for c in columns])
    shapes = df.agg(*aggs).select(F.explode(rows).alias("r")).select("r.*").orderBy(F.desc("missing"), "column")
    return shapes, profile.high_pairs(profile.correlations(df, columns), limit)


def reranked(df: DataFrame, k: int, by: Sequence[str] = (), key: str = "chunk_id") -> DataFrame:
    """The k best candidates per query by the twelve weights; a part that is null or not there counts 0."""
    df = df.withColumn("rerank_score", weighted({c: w for c, w in RERANK.items() if c in df.columns}))
    if not by:
        return df.orderBy(F.desc("rerank_score"), key).limit(k)
    return top_per_group(df, by, [F.desc("rerank_score"), F.asc(key)], k)


def search(chunks: DataFrame, service: str, term: str, fields: dict[str, str], text: str = "text") -> DataFrame:
    """Chunks of one typed service: those whose field of that type equals the term, whatever its case.

    A service without a field of its own searches the text; an unknown service is an error.
    """
    if service not in SERVICES:
        raise ValueError(f"no search service {service!r}")
    want = F.lower(F.lit(term))
    if service in fields:
        return chunks.filter(F.lower(F.col(fields[service]).cast("string")) == want)
    return chunks.filter(F.lower(F.col(text)).contains(want))


def package_graph(packages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of packages (dataset_id, name, source, provider, rows): repository, dataset, document and evidence.

    A node or an edge occurs once whatever number of packages name it; evidence only where statistics were taken (rows not null).
    """
    repo = F.concat(F.lit("Repository:"), F.coalesce("source", "provider"))
    at = {"Repository": repo, "Dataset": F.concat(F.lit("Dataset:"), "dataset_id"), "Document": F.concat(F.lit("Document:"), "dataset_id", F.lit("/0")),
          "Evidence": F.when(F.col("rows").isNotNull(), F.concat(F.lit("Evidence:"), "dataset_id", F.lit("/stats")))}
    named = {"Repository": F.coalesce("source", "provider"), "Dataset": F.col("name"), "Document": F.col("name"), "Evidence": F.lit(None).cast("string")}
    node = F.explode(F.array(*[F.struct(i.alias("id"), F.lit(k).alias("kind"), named[k].alias("name")) for k, i in at.items()])).alias("n")
    nodes = packages.select(node).select("n.*").filter("id is not null").groupBy("id", "kind").agg(F.min("name").alias("name"))
    links = [("Repository", "PROVIDES", "Dataset"), ("Dataset", "CONTAINS", "Document"), ("Document", "FROM_SOURCE", "Repository"), ("Document", "SUPPORTED_BY", "Evidence")]
    edge = F.explode(F.array(*[F.struct(at[a].alias("src"), F.lit(r).alias("relation"), at[b].alias("dst")) for a, r, b in links])).alias("e")
    return nodes, packages.select(edge).select("e.*").filter("src is not null and dst is not null").distinct()
