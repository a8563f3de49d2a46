"""Profiles of the catalogue and review tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from shelfwise import schemas as S
from shelfwise.functions.numeric import is_missing, round_half_even
from shelfwise.operators.quantiles import exact_quantiles, quantiles_from_counts


def _unpivot(df: DataFrame, columns: list[str], value: str = "value") -> DataFrame:
    return df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias(value)) for c in columns])
        ).alias("_r")
    ).select("_r.*")


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def validate_schema(catalogue: DataFrame, reviews: DataFrame | None = None) -> dict[str, dict]:
    """Required and optional columns found, from the plans alone (no job runs)."""
    tables = {"catalogue": (catalogue, S.REQUIRED_CATALOGUE, S.OPTIONAL_CATALOGUE)}
    if reviews is not None:
        tables["reviews"] = (reviews, S.REQUIRED_REVIEWS, S.OPTIONAL_REVIEWS)
    return {
        name: {
            "has_required_columns": set(required) <= set(df.columns),
            "missing_required_columns": [c for c in required if c not in df.columns],
            "optional_columns_present": {c: c in df.columns for c in optional},
            "total_columns": len(df.columns),
            "column_list": df.columns,
        }
        for name, (df, required, optional) in tables.items()
    }


def schema_presence(df: DataFrame, dataset: str, required: list[str], optional: list[str]) -> DataFrame:
    """Every expected column with its presence and its number of filled rows."""
    types = {f.name: f.dataType for f in df.schema.fields}
    expected = [(c, True) for c in required] + [(c, False) for c in optional]
    filled = {
        c: F.count_if(~is_missing(F.col(c), types[c])) if c in types else F.lit(0).cast("bigint")
        for c, _ in expected
    }
    one_row = df.agg(F.count(F.lit(1)).alias("_n"), *[v.alias(f"_f_{c}") for c, v in filled.items()])
    return one_row.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(dataset).alias("dataset"),
                        F.lit(c).alias("column"),
                        F.lit(needed).alias("required"),
                        F.lit(c in types).alias("present"),
                        F.col(f"_f_{c}").alias("filled_rows"),
                    )
                    for c, needed in expected
                ]
            )
        ).alias("_r")
    ).select("_r.*")


def missing_report(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, from a single scan."""
    one_row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.count_if(is_missing(F.col(f"`{f.name}`"), f.dataType)).alias(f"_m{i}")
            for i, f in enumerate(df.schema.fields)
        ],
    )
    return (
        one_row.select(
            "_n",
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(f.name).alias("column"),
                            F.col(f"_m{i}").alias("missing_count"),
                            F.lit(f.dataType.simpleString()).alias("dtype"),
                        )
                        for i, f in enumerate(df.schema.fields)
                    ]
                )
            ).alias("_r"),
        )
        .select(
            "_r.column",
            "_r.missing_count",
            round_half_even(
                F.coalesce(F.try_divide(F.col("_r.missing_count"), F.col("_n")), F.lit(0.0)) * 100, 2
            ).alias("missing_percentage"),
            "_r.dtype",
        )
        .orderBy(F.desc("missing_percentage"), "column")
    )


def missing_required(df: DataFrame, required: list[str]) -> DataFrame:
    """Required columns with any missing value."""
    return missing_report(df).where(
        F.col("column").isin(required) & (F.col("missing_count") > 0)
    )


def duplicate_count(df: DataFrame, key: list[str]) -> DataFrame:
    """Rows, and rows beyond the first of each key (null keys are one key)."""
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
    )


def table_profile(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """Row, column and duplicate-key counts."""
    return duplicate_count(df, [key]).withColumn(
        "total_columns", F.lit(len(df.columns)).cast("bigint")
    )


def category_stats(df: DataFrame, level: str = S.TARGET) -> DataFrame:
    """Distinct and missing categories, as one row."""
    sizes = df.groupBy(level).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.count(level).alias("unique_categories"),
        F.coalesce(F.sum(F.when(F.col(level).isNull(), F.col("n"))), F.lit(0)).alias(
            "missing_values"
        ),
    )


def top_categories(df: DataFrame, level: str = S.TARGET, n: int = 5) -> DataFrame:
    """The ``n`` largest categories."""
    return category_distribution(df, level).limit(n)


def category_distribution(df: DataFrame, level: str = S.TARGET, top_n: int | None = None) -> DataFrame:
    """Rows per category, largest first; ties by name."""
    if level not in df.columns:
        known = [c for c in df.columns if "category" in c.lower()]
        raise ValueError(f"column {level!r} not found; category columns: {known}")
    out = (
        df.where(F.col(level).isNotNull())
        .groupBy(level)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), level)
    )
    return out if top_n is None else out.limit(top_n)


def _value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return _unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("_c"))


def text_profile(df: DataFrame, columns: list[str] | None = None, digits: int = 2) -> DataFrame:
    """Missing count and length statistics of each text column.

    The texts are read once: all figures come from the rows per length.
    """
    columns = _present(df, columns or S.PROFILE_TEXT_COLUMNS)
    counts = _value_counts(df.select(*[F.length(F.col(c)).alias(c) for c in columns]), columns)
    filled = F.when(F.col("value").isNotNull(), F.col("_c"))
    basic = counts.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_c"))), F.lit(0)).alias("missing_count"),
        round_half_even(F.try_divide(F.sum(F.col("value") * filled), F.sum(filled)), digits).alias("avg_length"),
        F.max("value").cast("bigint").alias("max_length"),
        F.min("value").cast("bigint").alias("min_length"),
    )
    medians = quantiles_from_counts(counts, ["column"], "value", "_c", {"median_length": 0.5})
    return basic.join(F.broadcast(medians), "column", "left").where(F.col("max_length").isNotNull())


def numeric_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, median, sample deviation, extremes and missing of numbers."""
    columns = _present(df, columns or S.PROFILE_NUMERIC_COLUMNS)
    numbers = df.select(
        *[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns]
    )
    values = _unpivot(numbers, columns)
    basic = values.groupBy("column").agg(
        F.count("value").alias("count"),
        round_half_even(F.avg("value"), 2).alias("mean"),
        round_half_even(F.stddev_samp("value"), 2).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.count_if(F.col("value").isNull()).alias("missing"),
    )
    medians = exact_quantiles(values, ["column"], "value", {"median": 0.5}, True)
    return basic.join(F.broadcast(medians), "column", "left")


def describe_column(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles of one column.

    Rows per key, as whole numbers, are described from their value counts.
    """
    quartiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    whole = isinstance(df.schema[column].dataType, T.IntegralType)
    values = _unpivot(df.select(F.col(column).cast("double").alias(column)), [column])
    basic = values.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    if whole:
        counts = _value_counts(df.select(F.col(column).cast("double").alias(column)), [column])
        marks = quantiles_from_counts(counts, ["column"], "value", "_c", quartiles)
    else:
        marks = exact_quantiles(values, ["column"], "value", quartiles, True)
    return basic.join(F.broadcast(marks), "column", "left")


def null_rate_by_group(df: DataFrame, group: str, column: str) -> DataFrame:
    """Share of rows of each group in which ``column`` is missing."""
    data_type = df.schema[column].dataType
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.avg(is_missing(F.col(column), data_type).cast("int")).alias("null_rate"))
    )


def reviews_summary(reviews: DataFrame) -> DataFrame:
    """Reviews, distinct users and books, mean and median rating, as one row.

    Everything but the distinct users comes from counts per (book, rating), so
    a hot book shrinks to a few rows before the shuffle.
    """
    per_book = reviews.groupBy(S.KEY, "rating").agg(F.count(F.lit(1)).alias("n"))
    per_rating = per_book.groupBy("rating").agg(F.sum("n").alias("n"))
    users = reviews.select("user_id").distinct().agg(F.count("user_id")).scalar()
    books = per_book.select(S.KEY).distinct().agg(F.count(S.KEY)).scalar()
    rated = F.nanvl(F.col("rating").cast("double"), F.lit(None).cast("double"))
    return (
        per_rating.withColumn("rating", rated)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_reviews"),
            round_half_even(
                F.try_divide(
                    F.sum(F.col("rating") * F.col("n")),
                    F.sum(F.when(F.col("rating").isNotNull(), F.col("n"))),
                ),
                2,
            ).alias("avg_rating"),
            F.expr("percentile(rating, 0.5, n)").alias("median_rating"),
        )
        .select(
            "total_reviews",
            users.alias("unique_users"),
            books.alias("unique_books"),
            "avg_rating",
            "median_rating",
        )
    )


def share_of_total(counts: DataFrame, count: str = "count") -> Column:
    """Percentage of the total of a small table of counts."""
    total = counts.agg(F.sum(count)).scalar()
    return F.try_divide(F.col(count), total) * 100


def rating_histogram(reviews: DataFrame) -> DataFrame:
    """Reviews per rating with their percentage of all reviews."""
    counts = reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.withColumn("percentage", round_half_even(share_of_total(counts), 2))
        .where(F.col("rating").isNotNull() & ~F.isnan(F.col("rating").cast("double")))
        .orderBy("rating")
    )


def verified_share(reviews: DataFrame) -> DataFrame:
    """Verified and unverified reviews, and the verified percentage of all."""
    flag = F.col("verified_purchase")
    return reviews.agg(
        F.count_if(flag).alias("verified"),
        F.count_if(~flag).alias("not_verified"),
        round_half_even(F.try_divide(F.count_if(flag), F.count(F.lit(1))) * 100, 2).alias(
            "percentage_verified"
        ),
    )


def helpful_votes(reviews: DataFrame) -> DataFrame:
    """Total, mean and largest votes and the reviews that got any."""
    votes = F.coalesce(F.col("helpful_vote"), F.lit(0))
    return reviews.agg(
        F.sum(votes).cast("bigint").alias("total"),
        round_half_even(F.avg(votes), 2).alias("avg_per_review"),
        F.max(votes).cast("bigint").alias("max"),
        F.count_if(votes > 0).alias("reviews_with_votes"),
    )


def yearly_histogram(reviews: DataFrame) -> DataFrame:
    """Reviews per year, earliest first."""
    return (
        reviews.where(F.col("year").isNotNull())
        .groupBy("year")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("year")
    )


def year_report(reviews: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` earliest and the ``n`` largest years, with the overall bounds."""
    years = yearly_histogram(reviews)
    bounds = years.agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    earliest = years.orderBy("year").limit(n).withColumn("list", F.lit("earliest"))
    largest = years.orderBy(F.desc("count"), "year").limit(n).withColumn("list", F.lit("largest"))
    return earliest.unionByName(largest).select(
        "list",
        "year",
        "count",
        bounds.select("lo").scalar().alias("earliest_year"),
        bounds.select("hi").scalar().alias("latest_year"),
    )


def final_statistics(df: DataFrame, level: str = S.TARGET) -> DataFrame:
    """Rows, classes, columns, mean review count and mean rating, as one row."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_distinct(level).alias("total_categories"),
        F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.avg("review_count").alias("avg_reviews_per_book"),
        F.avg("avg_rating_from_reviews").alias("avg_rating"),
    )


def top_category_shares(df: DataFrame, level: str = S.TARGET, n: int = 5) -> DataFrame:
    """The ``n`` largest categories with their percentage of all rows."""
    counts = df.groupBy(level).agg(F.count(F.lit(1)).alias("count"))
    return (
        counts.withColumn("percentage", round_half_even(share_of_total(counts), 1))
        .where(F.col(level).isNotNull())
        .orderBy(F.desc("count"), level)
        .limit(n)
    )


def summary_sections(
    spark: SparkSession, catalogue: DataFrame, reviews: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every section of the written data report, each a small frame."""
    sections = {
        "basic_info": table_profile(catalogue),
        "category_stats": category_stats(catalogue),
        "missing_values": missing_report(catalogue),
        "category_distribution": category_distribution(catalogue, top_n=20),
        "text_features": text_profile(catalogue),
        "numerical_features": numeric_profile(catalogue),
    }
    if reviews is not None:
        from shelfwise.operators.aggregates import reviews_per_book

        per_book = reviews_per_book(reviews)
        sections |= {
            "reviews": reviews_summary(reviews),
            "ratings": rating_histogram(reviews),
            "most_reviewed": per_book.orderBy(F.desc("num_reviews"), S.KEY).limit(10),
            "reviews_per_book": describe_column(per_book, "num_reviews"),
        }
        if "text" in reviews.columns:
            sections["review_text"] = text_profile(reviews, ["text"], digits=0)
        if "verified_purchase" in reviews.columns:
            sections["verified_purchase"] = verified_share(reviews)
        if "helpful_vote" in reviews.columns:
            sections["helpful_votes"] = helpful_votes(reviews)
        if "year" in reviews.columns:
            sections["years"] = year_report(reviews)
    return sections
