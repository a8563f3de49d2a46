"""Cleaning, enrichment and preparation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import numeric, text
from shelfwise.operators import aggregates, cleaning
from shelfwise.plans import prepare as plan
from shelfwise.plans.config import PrepareConfig
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query


def enriched(spark, d):
    books = cleaning.clean_catalogue(I.raw_catalogue(spark, d), order_by=["title"])
    return aggregates.enrich_with_reviews(books, cleaning.clean_reviews(I.reviews(spark, d, True)))


@query(
    """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY p_name, p_type ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1"""
)
def dedup_catalogue(spark, d):
    return cleaning.keep_first(I.table(spark, d, "part"), ["p_name", "p_type"], ["p_partkey"])


@query(
    f"""WITH {I.REVIEWS} SELECT * EXCLUDE (rn) REPLACE (year::BIGINT AS year) FROM (
  SELECT *, row_number() OVER (PARTITION BY parent_asin, user_id, rating, text
    ORDER BY title, helpful_vote, verified_purchase, year) AS rn FROM reviews) WHERE rn = 1"""
)
def dedup_reviews(spark, d):
    return cleaning.keep_first(I.reviews(spark, d, True), cleaning.REVIEW_IDENTITY)


@query("SELECT min(doc_id) AS doc_id, text FROM documents GROUP BY text")
def dedup_documents(spark, d):
    docs = I.table(spark, d, "documents").select("doc_id", "text")
    return cleaning.keep_first(docs, ["text"], ["doc_id"])


@query(f"SELECT doc_id, {I.clean_sql('text')} AS text FROM documents")
def clean_text(spark, d):
    return cleaning.clean_text_columns(I.texts(spark, d).select("doc_id", "text"), ["text"])


@query(f"SELECT page_id, {I.clean_sql('html')} AS html, {I.clean_sql('url')} AS url FROM pages")
def clean_html(spark, d):
    return cleaning.clean_text_columns(I.texts(spark, d, "pages").select("page_id", "html", "url"), ["html", "url"])


@query(f"SELECT conv_id, turn, role, {I.clean_sql('text')} AS text FROM conversations")
def clean_conversations(spark, d):
    return cleaning.clean_text_columns(I.texts(spark, d, "conversations"), ["text"])


@query(
    f"SELECT count(text) AS non_empty_before, count(*) FILTER ({I.clean_sql('text')} <> '') AS non_empty_after FROM documents"
)
def text_cleaning_counters(spark, d):
    return cleaning.text_cleaning_counters(I.texts(spark, d), "text")


@query(
    f"""WITH {I.CATALOGUE} SELECT parent_asin,
  CASE WHEN trim(coalesce(description, '')) <> '' THEN description
    WHEN title IS NULL AND features_text IS NULL AND author_name IS NULL THEN 'No description available'
    ELSE concat_ws(' ', title, features_text, 'by ' || author_name) END AS description FROM catalogue"""
)
def fallback_description(spark, d):
    books = I.catalogue(spark, d)
    return books.select("parent_asin", text.fallback_description(books).alias("description"))


@query(
    f"""WITH {I.CATALOGUE} SELECT parent_asin, round(CASE WHEN price_numeric >= 0 THEN price_numeric END, 6) AS price_numeric,
  CASE WHEN page_count BETWEEN 10 AND 5000 THEN page_count END AS page_count,
  CASE WHEN average_rating BETWEEN 1 AND 5 THEN average_rating END AS average_rating FROM catalogue"""
)
def range_checks(spark, d):
    return numeric.clean_ranges(
        I.catalogue(spark, d).select("parent_asin", "price_numeric", "page_count", "average_rating")
    )


@query(f"WITH {I.CATALOGUE} SELECT parent_asin, category_level_2_sub FROM catalogue WHERE category_level_2_sub IS NOT NULL")
def drop_missing_target(spark, d):
    return cleaning.drop_missing_target(I.catalogue(spark, d).select("parent_asin", "category_level_2_sub"))


@query(f"WITH {I.REVIEWS} SELECT parent_asin, user_id, rating FROM reviews WHERE rating BETWEEN 1 AND 5")
def valid_ratings(spark, d):
    return cleaning.valid_ratings(I.reviews(spark, d).select("parent_asin", "user_id", "rating"))


@query(f"WITH {I.CLEAN_CATALOGUE} SELECT * REPLACE (round(price_numeric, 6) AS price_numeric) FROM clean_catalogue")
def clean_catalogue(spark, d):
    return cleaning.clean_catalogue(I.raw_catalogue(spark, d), order_by=["title"])


@query(f"WITH {I.CLEAN_REVIEWS} SELECT * FROM clean_reviews")
def clean_reviews(spark, d):
    return cleaning.clean_reviews(I.reviews(spark, d, True))


_ROUNDED = ", ".join(
    f"round({c}, 6) AS {c}"
    for c in ("price_numeric", "avg_rating_from_reviews", "rating_std", "verified_purchase_pct", "review_text_avg_length")
)


@query(f"WITH {I.ENRICHED} SELECT * REPLACE ({_ROUNDED}) FROM enriched")
def enrich_reviews(spark, d):
    return enriched(spark, d)


CONFIG = PrepareConfig(min_samples_per_category=3, sampling_fraction=0.5, min_reviews_per_book=10)


@query(
    f"""WITH {I.ENRICHED}, frequent AS (SELECT category_level_2_sub FROM enriched GROUP BY 1 HAVING count(*) >= 3),
filtered AS (SELECT * FROM enriched WHERE category_level_2_sub IN (SELECT * FROM frequent) AND review_count >= 10),
sampled AS (
  SELECT *, row_number() OVER (PARTITION BY category_level_2_sub ORDER BY md5('42:' || parent_asin)) AS rn,
    count(*) OVER (PARTITION BY category_level_2_sub) AS n FROM filtered)
SELECT * EXCLUDE (rn, n) REPLACE ({_ROUNDED}) FROM sampled WHERE rn <= round_even(n * 0.5::DOUBLE, 0)"""
)
def prepared_table(spark, d):
    """Clean, enrich, drop rare categories and thin books, sample by category."""
    return plan.prepare(I.raw_catalogue(spark, d), I.reviews(spark, d, True), CONFIG).sampled.drop("has_series")


@query(
    f"""WITH {I.ENRICHED}, frequent AS (SELECT category_level_2_sub FROM enriched GROUP BY 1 HAVING count(*) >= 3),
filtered AS (SELECT * FROM enriched WHERE category_level_2_sub IN (SELECT * FROM frequent) AND review_count >= 10),
per_class AS (SELECT category_level_2_sub AS c, round_even(count(*) * 0.5::DOUBLE, 0) AS q FROM filtered GROUP BY 1),
distinct_reviews AS (SELECT DISTINCT parent_asin, user_id, rating, text FROM reviews),
cleaned AS (SELECT rating, {I.clean_sql('text')} AS t FROM distinct_reviews),
m AS (SELECT 'catalogue' AS step, unnest([
    {{'metric': 'original_count', 'value': (SELECT count(*) FROM raw_catalogue)}},
    {{'metric': 'duplicates_removed', 'value': (SELECT count(*) - count(DISTINCT parent_asin) FROM raw_catalogue)}},
    {{'metric': 'descriptions_filled', 'value': (SELECT count(*) FROM first_rows WHERE description IS NULL)}},
    {{'metric': 'blank_descriptions_filled', 'value': (SELECT count(*) FROM first_rows WHERE trim(description) = '')}},
    {{'metric': 'no_category_removed', 'value': (SELECT count(*) FROM first_rows WHERE category_level_2_sub IS NULL)}},
    {{'metric': 'final_count', 'value': (SELECT count(*) FROM clean_catalogue)}},
    {{'metric': 'total_removed', 'value': (SELECT count(*) FROM raw_catalogue) - (SELECT count(*) FROM clean_catalogue)}}]) AS r
  UNION ALL SELECT 'reviews', unnest([
    {{'metric': 'original_count', 'value': (SELECT count(*) FROM reviews)}},
    {{'metric': 'duplicates_removed', 'value': (SELECT count(*) FROM reviews) - (SELECT count(*) FROM distinct_reviews)}},
    {{'metric': 'invalid_ratings_removed', 'value': (SELECT count(*) FROM cleaned WHERE rating NOT BETWEEN 1 AND 5)}},
    {{'metric': 'empty_text_removed', 'value': (SELECT count(*) FROM cleaned WHERE rating BETWEEN 1 AND 5 AND t = '')}},
    {{'metric': 'final_count', 'value': (SELECT count(*) FROM clean_reviews)}},
    {{'metric': 'total_removed', 'value': (SELECT count(*) FROM reviews) - (SELECT count(*) FROM clean_reviews)}}])
  UNION ALL SELECT 'enrichment', unnest([
    {{'metric': 'books_with_reviews', 'value': (SELECT count(*) FROM review_features)}},
    {{'metric': 'books_without_reviews', 'value': (SELECT count(*) FROM clean_catalogue WHERE parent_asin NOT IN (SELECT parent_asin FROM review_features))}},
    {{'metric': 'features_added', 'value': 6}}])
  UNION ALL SELECT 'filtering', unnest([
    {{'metric': 'original_count', 'value': (SELECT count(*) FROM enriched)}},
    {{'metric': 'final_count', 'value': (SELECT count(*) FROM enriched WHERE category_level_2_sub IN (SELECT * FROM frequent))}},
    {{'metric': 'original_categories', 'value': (SELECT count(DISTINCT category_level_2_sub) FROM enriched)}},
    {{'metric': 'final_categories', 'value': (SELECT count(*) FROM frequent)}},
    {{'metric': 'removed_categories', 'value': (SELECT count(DISTINCT category_level_2_sub) FROM enriched) - (SELECT count(*) FROM frequent)}}])
  UNION ALL SELECT 'sampling', unnest([
    {{'metric': 'original_count', 'value': (SELECT count(*) FROM filtered)}},
    {{'metric': 'sampled_count', 'value': (SELECT sum(q) FROM per_class)}},
    {{'metric': 'sampling_fraction', 'value': 0.5}}]))
SELECT step, r.metric AS metric, r.value::DOUBLE AS value FROM m"""
)
def preparation_report(spark, d):
    """Rows before, removed and left at every preparation step."""
    return plan.preparation_report(I.raw_catalogue(spark, d), I.reviews(spark, d, True), CONFIG)


@query("SELECT count(DISTINCT lang) AS unique_values, count(*) FILTER (lang IS NULL) AS missing_values FROM documents")
def target_profile(spark, d):
    return plan.target_profile(I.table(spark, d, "documents"), "lang").withColumn(
        "missing_values", F.col("missing_values").cast("bigint")
    )
