"""The queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (
    cover_tree,
    decontaminate,
    langid,
    minhash,
    packing,
    pii,
    quality,
    repeats,
    resample,
    toxicity,
    warc,
    whitening,
    winnow,
)
from strata.llm.common import table
from strata.llm.oracles import ORACLE_SQL

__all__ = ["ORACLE_SQL", "QUERIES"]

Query = Callable[[SparkSession, str], DataFrame]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pigeonhole_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(spark, docs, benchmark, rate=decontaminate.REWORDED)


def op2_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op5_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(spark, table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(spark, table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(spark, table(spark, sf_dir, "pages")).drop("url")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_crc_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.edited_likeness(spark, table(spark, sf_dir, "documents"))


def op13_jacobi_davidson_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark, table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_pigeonhole_decontamination": op1_pigeonhole_decontamination,
    "op2_cover_tree": op2_cover_tree,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_language_id": op4_language_id,
    "op5_suffix_array": op5_suffix_array,
    "op6_minhash": op6_minhash,
    "op7_pii": op7_pii,
    "op8_toxicity": op8_toxicity,
    "op9_warc": op9_warc,
    "op10_quality": op10_quality,
    "op11_prefix_crc_resampling": op11_prefix_crc_resampling,
    "op12_winnowing": op12_winnowing,
    "op13_jacobi_davidson_whitening": op13_jacobi_davidson_whitening,
}
