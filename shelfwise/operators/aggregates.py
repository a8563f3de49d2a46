"""Aggregations of reviews and categories, and the filters built on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F, types as T

from shelfwise import schemas as S
from shelfwise.functions.numeric import nan_to_null, round_half_even
from shelfwise.functions.text import text_length
from shelfwise.session import small_side


def category_analysis(df: DataFrame, level: str = S.TARGET) -> DataFrame:
    """Size, share of all rows and mean rating, price and pages per category.

    One scan; the total counts rows without a category too.
    """
    means = {"avg_rating": ("average_rating", 2), "avg_price": ("price_numeric", 2), "avg_pages": ("page_count", 0)}
    sizes = nan_to_null(df).groupBy(level).agg(
        F.count(F.lit(1)).alias("count"),
        *[
            (round_half_even(F.avg(c), digits) if c in df.columns else F.lit(None).cast("double")).alias(name)
            for name, (c, digits) in means.items()
        ],
    )
    total = sizes.agg(F.sum("count")).scalar()
    return (
        sizes.where(F.col(level).isNotNull())
        .select(
            F.col(level).alias("category"),
            "count",
            round_half_even(F.col("count") / total * 100, 2).alias("percentage"),
            *means,
        )
        .orderBy(F.desc("count"), "category")
    )


def filter_by_category(df: DataFrame, categories: list[str], level: str = S.TARGET) -> DataFrame:
    """Rows of the listed categories."""
    return df.where(F.col(level).isin(list(categories)))


def kept_share(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a filter, and the kept percentage."""
    n_before = before.agg(F.count(F.lit(1)).alias("n")).scalar()
    return after.agg(F.count(F.lit(1)).alias("rows_after")).select(
        n_before.alias("rows_before"),
        "rows_after",
        round_half_even(F.try_divide(F.col("rows_after"), n_before) * 100, 1).alias("kept_percentage"),
    )


def reviews_per_book(reviews: DataFrame, key: str = S.KEY) -> DataFrame:
    """Ratings, mean, sample deviation and distinct users of every book."""
    return (
        nan_to_null(reviews.select(key, "rating", "user_id"))
        .where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count("rating").alias("num_reviews"),
            F.avg("rating").alias("avg_rating"),
            F.stddev_samp("rating").alias("rating_std"),
            F.count_distinct("user_id").alias("unique_users"),
        )
    )


def rating_counts(reviews: DataFrame, key: str = S.KEY) -> DataFrame:
    """Reviews per (book, rating): the pre-aggregate used before wide joins."""
    rated = nan_to_null(reviews.select(key, F.col("rating").cast("double").alias("rating")))
    return rated.where(F.col(key).isNotNull()).groupBy(key, "rating").agg(F.count(F.lit(1)).alias("_c"))


def rating_by_category(
    catalogue: DataFrame, reviews: DataFrame, level: str = S.TARGET, key: str = S.KEY
) -> DataFrame:
    """Ratings of each category over the inner join of both tables.

    Reviews shrink to counts per (book, rating) before the join and to counts
    per (category, rating) after it, so neither a hot book nor a dominant category
    reaches one task as rows; moments, books and the exact median come from
    that class-level table.
    """
    books = catalogue.where(F.col(level).isNotNull()).groupBy(key, level).agg(F.count(F.lit(1)).alias("_m"))
    first = F.row_number().over(W.partitionBy(key).orderBy("rating")) == 1
    joined = books.join(rating_counts(reviews, key).withColumn("_book", first.cast("int")), key)
    counts = joined.groupBy(level, "rating").agg(F.sum(F.col("_c") * F.col("_m")).alias("_c"), F.sum("_book").alias("_books"))
    n, r = F.when(F.col("rating").isNotNull(), F.col("_c")).otherwise(0), F.col("rating")
    moments = counts.groupBy(level).agg(
        F.sum(n).alias("num_reviews"),
        F.sum(r * n).alias("_s1"),
        F.sum(r * r * n).alias("_s2"),
        F.expr("percentile(rating, 0.5, _c)").alias("median_rating"),
        F.sum("_books").alias("num_books"),
    )
    mean = F.try_divide(F.col("_s1"), F.col("num_reviews"))
    spread = F.greatest(F.col("_s2") - F.col("_s1") * mean, F.lit(0.0))
    std = F.when(F.col("num_reviews") > 1, F.sqrt(spread / (F.col("num_reviews") - 1)))
    return moments.select(
        level,
        "num_reviews",
        mean.alias("avg_rating"),
        std.alias("rating_std"),
        "median_rating",
        "num_books",
    ).orderBy(F.desc("num_reviews"), level)


def review_features(reviews: DataFrame, key: str = S.KEY) -> DataFrame:
    """Per-book review features; optional inputs add their column if present."""
    aggs = [
        F.count("rating").alias("review_count"),
        F.avg("rating").alias("avg_rating_from_reviews"),
        F.stddev_samp("rating").alias("rating_std"),
    ]
    if "verified_purchase" in reviews.columns:
        verified = F.coalesce(F.col("verified_purchase").cast("int"), F.lit(0))
        aggs.append((F.avg(verified) * 100).alias("verified_purchase_pct"))
    if "helpful_vote" in reviews.columns:
        aggs.append(F.sum("helpful_vote").alias("helpful_votes_total"))
    if "text" in reviews.columns:
        aggs.append(F.avg(F.length("text")).alias("review_text_avg_length"))
    return nan_to_null(reviews).where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def enrich_with_reviews(catalogue: DataFrame, reviews: DataFrame, key: str = S.KEY) -> DataFrame:
    """Catalogue with review features; books without reviews get defaults.

    The review side is one row per book after the aggregate, so this join has
    no skew from popular books.
    """
    features = review_features(reviews, key)
    defaults = {c: v for c, v in S.ENRICHMENT_DEFAULTS.items() if c in features.columns}
    return catalogue.join(features, key, "left").fillna(defaults)


def enrichment_counters(catalogue: DataFrame, reviews: DataFrame, key: str = S.KEY) -> DataFrame:
    """Books with and without reviews, columns added, mean and top counts."""
    features = review_features(reviews, key)
    joined = catalogue.select(key).join(features.withColumn("_hit", F.lit(1)), key, "left")
    n = F.coalesce(F.col("review_count"), F.lit(0))
    rating = F.coalesce(F.col("avg_rating_from_reviews"), F.lit(3.0))
    with_reviews = features.agg(F.count(F.lit(1))).scalar()
    return joined.agg(
        F.count_if(F.col("_hit").isNull()).alias("books_without_reviews"),
        F.avg(n).alias("avg_review_count"),
        F.max(n).alias("max_review_count"),
        F.avg(rating).alias("avg_rating"),
    ).select(
        with_reviews.alias("books_with_reviews"),
        "books_without_reviews",
        F.lit(len(features.columns) - 1).cast("bigint").alias("features_added"),
        "avg_review_count",
        "max_review_count",
        "avg_rating",
    )


def category_sizes(df: DataFrame, level: str = S.TARGET) -> DataFrame:
    """Rows per category."""
    return df.where(F.col(level).isNotNull()).groupBy(level).agg(F.count(F.lit(1)).alias("n"))


def filter_rare_categories(df: DataFrame, level: str = S.TARGET, min_samples: int = 50) -> DataFrame:
    """Rows of categories with at least ``min_samples`` rows."""
    frequent = category_sizes(df, level).where(F.col("n") >= min_samples).select(level)
    return df.join(small_side(frequent), level, "left_semi")


def removed_categories(df: DataFrame, level: str = S.TARGET, min_samples: int = 50) -> DataFrame:
    """Categories below the minimum, with their size."""
    return category_sizes(df, level).where(F.col("n") < min_samples)


def rare_filter_counters(df: DataFrame, level: str = S.TARGET, min_samples: int = 50) -> DataFrame:
    """Rows and categories before and after the rare-category filter."""
    sizes = df.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
    kept = F.col(level).isNotNull() & (F.col("n") >= min_samples)
    return sizes.agg(
        F.sum("n").alias("original_count"),
        F.coalesce(F.sum(F.when(kept, F.col("n"))), F.lit(0)).alias("final_count"),
        F.count(level).alias("original_categories"),
        F.count_if(kept).alias("final_categories"),
    ).withColumn("removed_categories", F.col("original_categories") - F.col("final_categories"))


def filter_by_review_count(df: DataFrame, min_reviews: int = 0) -> DataFrame:
    """Books with enough reviews; 0 or a missing column leaves all."""
    if min_reviews == 0 or "review_count" not in df.columns:
        return df
    return df.where(F.col("review_count") >= min_reviews)


def distinct_and_duplicates(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of a column and its repeated rows.

    Texts are grouped by their SHA-256, so the shuffle carries no text.
    """
    text = isinstance(df.schema[column].dataType, T.StringType)
    value = F.sha2(F.col(column).cast("binary"), 256) if text else F.col(column)
    sizes = df.groupBy(value.alias("_value")).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count("_value").alias("distinct_values"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def unknown_values(df: DataFrame, column: str, known: list[str]) -> DataFrame:
    """Values of a column outside the known list, with their rows."""
    return category_sizes(df.where(~F.col(column).isin(list(known))), column)


def with_text_length(df: DataFrame, column: str = "text") -> DataFrame:
    """Adds the length of a text column in code points."""
    return df.withColumn("text_length", text_length(F.col(column)))
