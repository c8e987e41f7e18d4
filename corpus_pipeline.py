"""Documents to a training mix: quality rules, near-duplicates, benchmark passages, personal data, mixing.

Each stage takes the documents that its predecessor kept, written as Parquet in the shared folder and
read again. All stages but the last return the columns of ``documents``; the last says how often each
document is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfprice.llm import decontam, mixing, quality, simhash_dedup, surrogates
from shelfprice.plans.staging import stage

# A key for tests; whoever publishes rewritten texts sets a secret one.
KEY = b"key of the registered pipeline"


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the certified quality rules keep."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.keep_first(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    return decontam.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), by_text=True)


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the personal data in their texts."""
    return surrogates.rewrite(docs, KEY)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each remaining document is taken."""
    return mixing.mix(docs)


STAGES = [
    ("quality rules", good),
    ("SimHash near-dedup", unlike),
    ("benchmark decontamination", clean),
    ("personal data", private),
    ("mixing sources", mixed),
]

# Surrogates are keyed hashes and the mix is drawn from hashes that DuckDB does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name.split()[0].lower())
    return docs
