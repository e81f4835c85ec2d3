"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir) and gives the next one's documents; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, langid, minhash, packing, pii
from strata.llm.common import materialize, table
from strata.llm.queries import vocabulary
from strata.session import configure


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language of the corpus, go."""
    configure(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest id stays. Rows without an
    id stay; rows that share one are one document."""
    configure(spark)
    gone = minhash.near_duplicates(spark, docs).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark item occurs go."""
    configure(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), rate=decontaminate.REWORDED)


def pii_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    configure(spark)
    out = pii.redacted(spark, docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces: their ids, sequence and offset there, as
    ``packing.write_sequences`` takes them."""
    configure(spark)
    return packing.placed(spark, docs, vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii_redaction", pii_redaction),
    ("best_fit_packing", best_fit_packing),
]

#: Trained models and tokenizers: not SQL. tests/llm holds it against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
