"""Duplicate removal and the ordered cleaning of both tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from shelfwise import schemas as S
from shelfwise.functions.numeric import clean_ranges, flag, nan_to_null, non_negative_int
from shelfwise.functions.text import (
    clean_text,
    clean_text_columns,
    fallback_description,
    is_blank,
)

REVIEW_IDENTITY = ["parent_asin", "user_id", "rating", "text"]


def keep_first(df: DataFrame, key: list[str], order_by: list[str] | None = None) -> DataFrame:
    """The first row per key in the given order (default: the other columns).

    Spark limits each key to one row per map task before the shuffle, so a key
    with many copies does not gather in one task. Null keys count as equal.
    """
    order = order_by or [c for c in df.columns if c not in key] or key
    first = W.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(first)).where("_rn = 1").drop("_rn")


def drop_missing_target(df: DataFrame, target: str = S.TARGET) -> DataFrame:
    """Rows that have a category."""
    return df.where(F.col(target).isNotNull())


def valid_ratings(reviews: DataFrame) -> DataFrame:
    """Reviews rated 1 to 5; missing ratings are dropped."""
    return reviews.where(F.col("rating").between(1, 5))


def clean_catalogue(
    df: DataFrame, key: str = S.KEY, target: str = S.TARGET, order_by: list[str] | None = None
) -> DataFrame:
    """Dedup, fill descriptions, clean text, require a category, check ranges."""
    first = keep_first(nan_to_null(df), [key], order_by)
    filled = first.withColumn("description", fallback_description(first))
    return clean_ranges(drop_missing_target(clean_text_columns(filled, S.TEXT_COLUMNS), target))


def clean_reviews(df: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """Dedup on raw text, check ratings, clean text, settle flags and votes."""
    out = valid_ratings(keep_first(nan_to_null(df), REVIEW_IDENTITY, order_by))
    out = out.withColumn("text", clean_text(F.col("text"))).where(F.col("text") != "")
    if "verified_purchase" in out.columns:
        out = out.withColumn("verified_purchase", flag(F.col("verified_purchase")))
    if "helpful_vote" in out.columns:
        out = out.withColumn("helpful_vote", non_negative_int(F.col("helpful_vote")))
    return out


def text_cleaning_counters(df: DataFrame, column: str) -> DataFrame:
    """Non-null texts before and non-empty texts after cleaning."""
    return df.agg(
        F.count(column).alias("non_empty_before"),
        F.count_if(clean_text(F.col(column)) != "").alias("non_empty_after"),
    )


def step_metrics(one_row: DataFrame, steps: dict[str, list[str]]) -> DataFrame:
    """A one-row frame of counters as (step, metric, value) rows."""
    entries = [
        F.struct(F.lit(step).alias("step"), F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for step, columns in steps.items()
        for c in columns
    ]
    return one_row.select(F.explode(F.array(*entries)).alias("_r")).select("_r.*")


def catalogue_counters(df: DataFrame, key: str = S.KEY, target: str = S.TARGET) -> DataFrame:
    """Rows before, removed by each cleaning step, and left."""
    raw = df.agg(F.count(F.lit(1))).scalar()
    first = keep_first(df, [key])
    one_row = first.agg(
        F.count(F.lit(1)).alias("_unique"),
        F.count_if(F.col("description").isNull()).alias("descriptions_filled"),
        F.count_if(F.col("description").isNotNull() & is_blank(F.col("description"))).alias("blank_descriptions_filled"),
        F.count_if(F.col(target).isNull()).alias("no_category_removed"),
        F.count(target).alias("final_count"),
    ).select(
        raw.alias("original_count"),
        (raw - F.col("_unique")).alias("duplicates_removed"),
        "descriptions_filled",
        "blank_descriptions_filled",
        "no_category_removed",
        "final_count",
        (raw - F.col("final_count")).alias("total_removed"),
    )
    return step_metrics(one_row, {"catalogue": one_row.columns})


def review_totals(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """Rows before, removed by each cleaning step and left, and the books left.

    One pass over the distinct identities; nothing else of a review matters.
    """
    raw = df.agg(F.count(F.lit(1))).scalar()
    valid = F.col("rating").between(1, 5)
    identity = nan_to_null(df.select(*REVIEW_IDENTITY)).distinct().withColumn("_clean", clean_text(F.col("text")))
    left = valid & (F.col("_clean") != "")
    return identity.agg(
        F.count(F.lit(1)).alias("_unique"),
        F.count_if(~valid).alias("invalid_ratings_removed"),
        F.count_if(valid & (F.col("_clean") == "")).alias("empty_text_removed"),
        F.count_if(left).alias("final_count"),
        F.count_distinct(F.when(left, F.col(key))).alias("books_with_reviews"),
    ).select(
        raw.alias("original_count"),
        (raw - F.col("_unique")).alias("duplicates_removed"),
        "invalid_ratings_removed",
        "empty_text_removed",
        "final_count",
        (raw - F.col("final_count")).alias("total_removed"),
        "books_with_reviews",
    )


def review_counters(df: DataFrame) -> DataFrame:
    """Rows before, removed by each cleaning step, and left."""
    totals = review_totals(df).drop("books_with_reviews")
    return step_metrics(totals, {"reviews": totals.columns})
