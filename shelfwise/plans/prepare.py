"""Preparation: clean, enrich, filter, sample, weigh, split."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import schemas as S
from shelfwise.functions.text import has_series
from shelfwise.operators.aggregates import (
    enrich_with_reviews,
    filter_by_review_count,
    filter_rare_categories,
    rare_filter_counters,
)
from shelfwise.operators.cleaning import (
    catalogue_counters,
    clean_catalogue,
    clean_reviews,
    review_totals,
    step_metrics,
)
from shelfwise.operators.sampling import (
    split_summary,
    stratified_sample,
    train_test_split,
    undersample,
)
from shelfwise.operators.weights import class_weights
from shelfwise.plans.config import PrepareConfig, SplitConfig
from shelfwise.session import cut_lineage
from shelfwise.sources.sinks import write_json, write_table
from shelfwise.sources.tables import read_table


@dataclass(frozen=True)
class Prepared:
    """The stages that later jobs read."""

    enriched: DataFrame
    filtered: DataFrame
    sampled: DataFrame
    weights: DataFrame


def enrich(catalogue: DataFrame, reviews: DataFrame, config: PrepareConfig) -> DataFrame:
    """Cleaned catalogue with review features and the series flag of raw titles."""
    flagged = catalogue.withColumn("has_series", has_series(F.col("title")))
    books = clean_catalogue(flagged, config.key, config.target)
    return enrich_with_reviews(books, clean_reviews(reviews), config.key)


def prepare(catalogue: DataFrame, reviews: DataFrame, config: PrepareConfig) -> Prepared:
    """The whole chain; the enriched table is written once and reused.

    Rare categories are counted before the review filter, so a kept category
    may end below the minimum.
    """
    enriched = cut_lineage(enrich(catalogue, reviews, config), "enriched")
    frequent = filter_rare_categories(enriched, config.target, config.min_samples_per_category)
    filtered = filter_by_review_count(frequent, config.min_reviews_per_book)
    sampled = stratified_sample(
        filtered, config.target, config.sampling_fraction, [config.key], config.seed
    )
    if config.balance_strategy == "undersample":
        sampled = undersample(sampled, config.target, config.undersample_cap, [config.key], config.seed)
    weights = class_weights(sampled, config.target, config.balance_strategy)
    return Prepared(enriched, filtered, sampled, weights)


def preparation_report(catalogue: DataFrame, reviews: DataFrame, config: PrepareConfig) -> DataFrame:
    """Counters of every step as (step, metric, value) rows.

    The stored enriched table and one pass over each raw table serve all steps.
    """
    stages = prepare(catalogue, reviews, config)
    without = stages.enriched.agg(F.count_if(F.col("review_count") == 0)).scalar()
    added = len([c for c in S.ENRICHMENT_DEFAULTS if c in stages.enriched.columns])
    facts = review_totals(reviews, config.key).select(
        "*", without.alias("books_without_reviews"), F.lit(added).alias("features_added")
    )
    enrichment = ["books_with_reviews", "books_without_reviews", "features_added"]
    filtering = rare_filter_counters(stages.enriched, config.target, config.min_samples_per_category)
    before = stages.filtered.agg(F.count(F.lit(1))).scalar()
    sampling = stages.sampled.agg(F.count(F.lit(1)).alias("sampled_count")).select(
        before.alias("original_count"),
        "sampled_count",
        F.lit(config.sampling_fraction).alias("sampling_fraction"),
    )
    parts = [
        catalogue_counters(catalogue, config.key, config.target),
        step_metrics(
            facts, {"reviews": [c for c in facts.columns if c not in enrichment], "enrichment": enrichment}
        ),
        step_metrics(filtering, {"filtering": filtering.columns}),
        step_metrics(sampling, {"sampling": sampling.columns}),
    ]
    return reduce(DataFrame.unionByName, parts)


def save_prepared(
    sampled: DataFrame,
    output_path: str,
    fmt: str = "parquet",
    weights: DataFrame | None = None,
    weights_path: str | None = None,
) -> None:
    """Write the sampled table, and the weights where a path is given."""
    write_table(sampled, output_path, fmt)
    if weights is not None and weights_path is not None:
        write_json(weights, weights_path)


def load_prepared(spark: SparkSession, path: str, target: str = S.TARGET, fmt: str | None = None) -> DataFrame:
    """Read a prepared table and require its target column."""
    df = read_table(spark, path, fmt)
    if target not in df.columns:
        raise ValueError(f"target column {target!r} not found; columns: {df.columns}")
    return df


def target_profile(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Distinct and missing targets."""
    sizes = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(target).alias("unique_values"),
        F.coalesce(F.sum(F.when(F.col(target).isNull(), F.col("n"))), F.lit(0)).alias("missing_values"),
    )


def save_splits(df: DataFrame, output_dir: str, config: SplitConfig) -> dict[str, str]:
    """Write both splits in one pass, partitioned by ``split``, and their info."""
    paths = {
        "splits": f"{output_dir}/{config.splits_name}",
        "split_info": f"{output_dir}/{config.info_name}",
    }
    df.write.mode("overwrite").partitionBy("split").parquet(paths["splits"])
    written = df.sparkSession.read.parquet(paths["splits"])
    write_json(split_summary(written, config.target, config.test_size, config.seed), paths["split_info"])
    return paths | {s: f"{paths['splits']}/split={s}" for s in ("train", "test")}


def run_split(spark: SparkSession, path: str, output_dir: str, config: SplitConfig) -> dict:
    """Load, split, save, and hand back the two parts as written."""
    df = load_prepared(spark, path, config.target)
    split = train_test_split(df, config.target, config.test_size, [config.key], config.seed)
    paths = save_splits(split, output_dir, config)
    written = spark.read.parquet(paths["splits"])
    return {
        "train": written.where("split = 'train'").drop("split"),
        "test": written.where("split = 'test'").drop("split"),
        "split_info": spark.read.json(paths["split_info"]),
        "paths": paths,
    }
