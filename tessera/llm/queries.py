"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import avi, dac, hmm, mixing, pii, quality, secrets, simhash, warc, winnow


def tokenizer_path() -> str:
    """The vocabulary file; a parameter of the operators, never part of the repository."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_avi_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return avi.digests(avi.to_media(_table(spark, sf_dir, "documents"), "doc_id", "text"))


def op2_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(_table(spark, sf_dir, "documents"))


def op7_dac_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dac.round_trip(_table(spark, sf_dir, "documents"), tokenizer_path())


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(_table(spark, sf_dir, "documents"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_avi_media, op2_hmm_score, op3_simhash, op4_quality, op5_winnow, op6_pii, op7_dac_tokens, op8_secrets, op9_mixing, op10_warc]
    return {f.__name__: f for f in found}
