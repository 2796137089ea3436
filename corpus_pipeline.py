"""A training corpus in five stages, from raw documents to token files.

Quality classifier, SimHash near-dedup, benchmark decontamination, mixing to source
weights, token ids.  Each stage works on all rows that its predecessor kept; every result is
written as Parquet and read again, so a lost executor costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import common, dac, mixing, quality, simhash, winnow
from tessera.llm.queries import tokenizer_path


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose whole text the classifier scores 0.5 or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.train(docs, labels, "quality")
    return quality.scored(docs, model, "_quality_of_text").filter("_quality_of_text >= 0.5").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items."""
    return winnow.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each epoch of each document that the mix takes; the last one of a source is cut at the exact word."""
    return mixing.mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the corpus, read back: doc_id, start, n_tokens, ids_crc32."""
    return dac.round_trip(docs, tokenizer_path())


STAGES = [
    ("quality classifier", keep_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix_sources),
    ("token ids", write_tokens),
]

#: The classifier and the tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return docs
