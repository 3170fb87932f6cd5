"""A corpus pipeline of five stages over the table of documents.

Each stage takes (spark, docs, sf_dir) and returns the documents it keeps, with
the columns of the table; the last one returns the mix, in which a document can
stand several times.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contestry.llm import decontaminate, exact_names, mixture, near_dups, quality_lm
from contestry.session import new_folder, scope


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose perplexity lies within the thresholds of their language; the
    model and the thresholds come from the labelled ones among ``docs``."""
    return quality_lm.drop_low_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of equal texts, the one with the largest id."""
    return exact_names.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id; they
    share 80 % of their shingles of five words."""
    return near_dups.drop_near_duplicates(docs, k=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of ten words with a benchmark item."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixture.mix(docs)


STAGES = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: trained scores, near duplicates and chosen seeds have no SQL; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written and read back for the next, and what a
    stage has stored on its way is deleted then."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, name)
        with scope(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs
