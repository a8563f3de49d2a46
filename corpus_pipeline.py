"""The corpus pipeline: toxicity, near-duplicates, decontamination, mixing, token files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm import decontamination, mixing, simhash, token_files, toxicity
from shelfwise.llm.common import stored, table


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the toxicity model rejects."""
    model = toxicity.trained(spark, table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.drop_toxic(docs, model)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a test item."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat and drop rows until every source meets its target."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files over what is left, one row per document."""
    return token_files.token_table(docs)


STAGES = [("toxicity", clean), ("near duplicates", dedup), ("decontamination", decontaminate), ("mixing", mix), ("token files", tokens)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
