"""Profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise import schemas as S
from shelfwise.operators import aggregates, profile
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query

CATALOGUE_COLUMNS = {
    "parent_asin": "bigint",
    "title": "string",
    "category_level_2_sub": "string",
    "category_level_1_main": "string",
    "description": "string",
    "features_text": "string",
    "author_name": "string",
    "price_numeric": "double",
    "page_count": "double",
    "average_rating": "double",
    "rating_number": "bigint",
    "format": "string",
}


def _presence_sql(dataset: str, required: list[str], optional: list[str], have: list[str]) -> str:
    rows = []
    for needed, columns in (("true", required), ("false", optional)):
        for c in columns:
            filled = f"(SELECT count({c}) FROM {dataset})" if c in have else "0"
            rows.append(
                f"SELECT '{dataset}' AS dataset, '{c}' AS \"column\", {needed} AS required, "
                f"{'true' if c in have else 'false'} AS present, {filled}::BIGINT AS filled_rows"
            )
    return " UNION ALL ".join(rows)


REVIEW_COLUMNS = ["parent_asin", "user_id", "rating", "title", "text", "helpful_vote", "verified_purchase", "year"]


@query(
    f"WITH {I.CATALOGUE}, {I.REVIEWS} "
    + _presence_sql("catalogue", S.REQUIRED_CATALOGUE, S.OPTIONAL_CATALOGUE, list(CATALOGUE_COLUMNS))
    + " UNION ALL "
    + _presence_sql("reviews", S.REQUIRED_REVIEWS, S.OPTIONAL_REVIEWS, REVIEW_COLUMNS)
)
def schema_check(spark, d):
    """Expected columns of both tables, with presence and filled rows."""
    return profile.schema_presence(
        I.catalogue(spark, d), "catalogue", S.REQUIRED_CATALOGUE, S.OPTIONAL_CATALOGUE
    ).unionByName(
        profile.schema_presence(I.reviews(spark, d), "reviews", S.REQUIRED_REVIEWS, S.OPTIONAL_REVIEWS)
    )


_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
    f"{I.half_even_sql(f'count(*) FILTER ({c} IS NULL) / count(*) * 100', 2)} AS missing_percentage, "
    f"'{t}' AS dtype FROM catalogue"
    for c, t in CATALOGUE_COLUMNS.items()
)


@query(f"WITH {I.CATALOGUE} {_MISSING}")
def missing_report(spark, d):
    return profile.missing_report(I.catalogue(spark, d))


@query(
    f"WITH {I.CATALOGUE}, report AS ({_MISSING}) SELECT * FROM report WHERE missing_percentage > 0 "
    "AND \"column\" IN ('parent_asin', 'title', 'category_level_2_sub', 'description')"
)
def missing_required(spark, d):
    return profile.missing_required(I.catalogue(spark, d), S.REQUIRED_CATALOGUE)


@query(
    f"WITH {I.RAW_CATALOGUE} SELECT count(*) AS total_rows, count(*) - count(DISTINCT parent_asin) AS duplicates, "
    "12::BIGINT AS total_columns FROM raw_catalogue"
)
def table_profile(spark, d):
    return profile.table_profile(I.raw_catalogue(spark, d))


@query(
    f"WITH {I.CATALOGUE} SELECT count(DISTINCT category_level_2_sub) AS unique_categories, "
    "count(*) FILTER (category_level_2_sub IS NULL) AS missing_values FROM catalogue"
)
def category_stats(spark, d):
    return profile.category_stats(I.catalogue(spark, d)).withColumn(
        "missing_values", F.col("missing_values").cast("bigint")
    )


_DISTRIBUTION = (
    f"WITH {I.CATALOGUE} SELECT category_level_2_sub, count(*) AS count FROM catalogue "
    "WHERE category_level_2_sub IS NOT NULL GROUP BY 1"
)


@query(_DISTRIBUTION)
def category_distribution(spark, d):
    return profile.category_distribution(I.catalogue(spark, d))


@query(f"{_DISTRIBUTION} ORDER BY count DESC, 1 LIMIT 5")
def category_distribution_top(spark, d):
    return profile.category_distribution(I.catalogue(spark, d), top_n=5)


def _text_sql(source: str, columns: list[str], digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing_count, "
        f"{I.half_even_sql(f'avg(length({c}))', digits)} AS avg_length, max(length({c}))::BIGINT AS max_length, "
        f"min(length({c}))::BIGINT AS min_length, median(length({c})::DOUBLE) AS median_length FROM {source}"
        for c in columns
    )


@query(f"WITH {I.CATALOGUE} {_text_sql('catalogue', S.PROFILE_TEXT_COLUMNS, 2)}")
def text_profile(spark, d):
    return profile.text_profile(I.catalogue(spark, d))


@query(_text_sql("documents", ["text"], 2))
def document_text_profile(spark, d):
    return profile.text_profile(I.table(spark, d, "documents"), ["text"])


@query(f"WITH {I.REVIEWS} {_text_sql('reviews', ['text'], 0)}")
def review_text_profile(spark, d):
    return profile.text_profile(I.reviews(spark, d), ["text"], digits=0)


def _numeric_sql(source: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, {I.half_even_sql(f'avg({c})', 2)} AS mean, "
        f"{I.half_even_sql(f'stddev_samp({c})', 2)} AS std, round(min({c})::DOUBLE, 6) AS min, "
        f"round(max({c})::DOUBLE, 6) AS max, count(*) FILTER ({c} IS NULL) AS missing, "
        f"round(median({c}::DOUBLE), 6) AS median FROM {source}"
        for c in columns
    )


@query(f"WITH {I.CLEAN_CATALOGUE} {_numeric_sql('clean_catalogue', S.PROFILE_NUMERIC_COLUMNS)}")
def numeric_profile(spark, d):
    from shelfwise.operators.cleaning import clean_catalogue

    return profile.numeric_profile(clean_catalogue(I.raw_catalogue(spark, d), order_by=["title"]))


@query(_numeric_sql("orders", ["o_totalprice"]))
def order_price_profile(spark, d):
    return profile.numeric_profile(I.table(spark, d, "orders"), ["o_totalprice"])


@query(
    f"WITH {I.CATALOGUE} SELECT category_level_1_main, round(avg((description IS NULL)::INT), 6) AS null_rate "
    "FROM catalogue GROUP BY 1"
)
def null_rate_by_group(spark, d):
    return profile.null_rate_by_group(I.catalogue(spark, d), "category_level_1_main", "description")


@query(
    f"WITH {I.REVIEWS} SELECT count(*) AS total_reviews, count(DISTINCT user_id) AS unique_users, "
    f"count(DISTINCT parent_asin) AS unique_books, {I.half_even_sql('avg(rating)', 2)} AS avg_rating, "
    "median(rating) AS median_rating FROM reviews"
)
def reviews_summary(spark, d):
    return profile.reviews_summary(I.reviews(spark, d))


@query(
    f"WITH {I.REVIEWS} SELECT rating, count(*) AS count, "
    f"{I.half_even_sql('count(*) / sum(count(*)) OVER () * 100', 2)} AS percentage FROM reviews GROUP BY rating"
)
def rating_histogram(spark, d):
    return profile.rating_histogram(I.reviews(spark, d))


@query(
    f"WITH {I.REVIEWS} SELECT count(*) FILTER (verified_purchase) AS verified, "
    "count(*) FILTER (NOT verified_purchase) AS not_verified, "
    f"{I.half_even_sql('count(*) FILTER (verified_purchase) / count(*) * 100', 2)} AS percentage_verified FROM reviews"
)
def verified_share(spark, d):
    return profile.verified_share(I.reviews(spark, d))


@query(
    f"WITH {I.REVIEWS} SELECT sum(helpful_vote)::BIGINT AS total, {I.half_even_sql('avg(helpful_vote)', 2)} AS avg_per_review, "
    "max(helpful_vote) AS max, count(*) FILTER (helpful_vote > 0) AS reviews_with_votes FROM reviews"
)
def helpful_votes(spark, d):
    return profile.helpful_votes(I.reviews(spark, d))


@query(f"WITH {I.REVIEWS} SELECT year::BIGINT AS year, count(*) AS count FROM reviews GROUP BY 1")
def yearly_histogram(spark, d):
    return profile.yearly_histogram(I.reviews(spark, d))


@query(
    f"""WITH {I.REVIEWS}, years AS (SELECT year::BIGINT AS year, count(*) AS count FROM reviews GROUP BY 1),
picked AS (
  SELECT * FROM (SELECT 'earliest' AS list, * FROM years ORDER BY year LIMIT 5)
  UNION ALL SELECT * FROM (SELECT 'largest' AS list, * FROM years ORDER BY count DESC, year LIMIT 5))
SELECT *, (SELECT min(year) FROM years) AS earliest_year, (SELECT max(year) FROM years) AS latest_year FROM picked"""
)
def year_report(spark, d):
    return profile.year_report(I.reviews(spark, d))


_PER_BOOK = (
    "SELECT parent_asin, count(rating) AS num_reviews, round(avg(rating), 6) AS avg_rating, "
    "round(stddev_samp(rating), 6) AS rating_std, count(DISTINCT user_id) AS unique_users FROM reviews GROUP BY 1"
)


@query(f"WITH {I.REVIEWS} {_PER_BOOK}")
def reviews_per_book(spark, d):
    return aggregates.reviews_per_book(I.reviews(spark, d))


@query(
    f"""WITH {I.REVIEWS}, per_book AS ({_PER_BOOK})
SELECT 'num_reviews' AS "column", count(*) AS count, round(avg(num_reviews), 6) AS mean,
  round(stddev_samp(num_reviews), 6) AS std, min(num_reviews)::DOUBLE AS min, max(num_reviews)::DOUBLE AS max,
  round(quantile_cont(num_reviews::DOUBLE, 0.25), 6) AS p25, round(quantile_cont(num_reviews::DOUBLE, 0.5), 6) AS p50,
  round(quantile_cont(num_reviews::DOUBLE, 0.75), 6) AS p75 FROM per_book"""
)
def reviews_per_book_describe(spark, d):
    per_book = aggregates.reviews_per_book(I.reviews(spark, d))
    return profile.describe_column(per_book, "num_reviews")


@query(
    f"WITH {I.REVIEWS}, per_book AS ({_PER_BOOK}) SELECT * FROM per_book ORDER BY num_reviews DESC, parent_asin LIMIT 10"
)
def most_reviewed_books(spark, d):
    per_book = aggregates.reviews_per_book(I.reviews(spark, d))
    return per_book.orderBy(F.desc("num_reviews"), "parent_asin").limit(10)


@query(
    f"""WITH {I.ENRICHED} SELECT count(*) AS total_rows, count(DISTINCT category_level_2_sub) AS total_categories,
  18::BIGINT AS total_columns, round(avg(review_count), 6) AS avg_reviews_per_book,
  round(avg(avg_rating_from_reviews), 6) AS avg_rating FROM enriched"""
)
def final_statistics(spark, d):
    from shelfwise.queries.cleaning import enriched

    return profile.final_statistics(enriched(spark, d))


@query(
    f"""WITH {I.CATALOGUE}, counts AS (
  SELECT category_level_2_sub, count(*) AS count, sum(count(*)) OVER () AS total FROM catalogue GROUP BY 1)
SELECT category_level_2_sub, count, {I.half_even_sql('count / total * 100', 1)} AS percentage FROM counts
WHERE category_level_2_sub IS NOT NULL ORDER BY count DESC, category_level_2_sub LIMIT 5"""
)
def top_category_shares(spark, d):
    return profile.top_category_shares(I.catalogue(spark, d))


@query(
    "SELECT count(DISTINCT text) AS distinct_values, count(*) - count(DISTINCT text) AS duplicates FROM documents"
)
def duplicate_texts(spark, d):
    return aggregates.distinct_and_duplicates(I.table(spark, d, "documents"), "text")
