"""Join, aggregate and category-filter queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import aggregates, joins
from shelfwise.operators.cleaning import clean_reviews, drop_missing_target
from shelfwise.queries import inputs as I
from shelfwise.queries.registry import query


@query(
    f"""WITH {I.CATALOGUE}, {I.REVIEWS}
SELECT category_level_2_sub, count(rating) AS num_reviews, round(avg(rating), 6) AS avg_rating,
  round(stddev_samp(rating), 6) AS rating_std, median(rating) AS median_rating,
  count(DISTINCT parent_asin) AS num_books
FROM catalogue JOIN reviews USING (parent_asin) WHERE category_level_2_sub IS NOT NULL GROUP BY 1"""
)
def rating_by_category(spark, d):
    """The flagship: rating statistics of every category."""
    return aggregates.rating_by_category(I.catalogue(spark, d), I.reviews(spark, d))


_JOIN_COLUMNS = "parent_asin, c.title AS title_book, category_level_2_sub, price_numeric, user_id, rating, r.title AS title_review, r.year::BIGINT AS year"
_KEPT = "kept AS (SELECT * FROM reviews WHERE parent_asin IN (SELECT parent_asin FROM reviews GROUP BY 1 HAVING count(*) >= 30))"


def _join_sql(how: str) -> str:
    return (
        f"WITH {I.CATALOGUE}, {I.REVIEWS}, {_KEPT}, named AS (SELECT * FROM catalogue WHERE category_level_2_sub IS NOT NULL) "
        f"SELECT {_JOIN_COLUMNS.replace('price_numeric', 'round(price_numeric, 6) AS price_numeric')} "
        f"FROM named c {how} JOIN kept r USING (parent_asin)"
    )


def _join(spark, d, how):
    named = drop_missing_target(I.catalogue(spark, d)).select(
        "parent_asin", "title", "category_level_2_sub", "price_numeric"
    )
    facts = I.reviews(spark, d).select("parent_asin", "user_id", "rating", "title", "year")
    return joins.join_reviews(named, facts, how, min_reviews_per_book=30)


@query(_join_sql("INNER"))
def join_inner(spark, d):
    return _join(spark, d, "inner")


@query(_join_sql("LEFT"))
def join_left(spark, d):
    return _join(spark, d, "left")


@query(_join_sql("RIGHT"))
def join_right(spark, d):
    return _join(spark, d, "right")


@query(_join_sql("FULL"))
def join_outer(spark, d):
    return _join(spark, d, "outer")


# Without a review filter: some keys are missing on both sides and one book holds every review rated 5.
_ALL_BOOKS = "CASE WHEN rating_number = 470 THEN NULL ELSE parent_asin END AS parent_asin"
_ALL_REVIEWS = "CASE WHEN helpful_vote = 4 THEN NULL WHEN rating = 5 THEN 7 ELSE parent_asin END AS parent_asin"


def _join_all_sql(how: str) -> str:
    return (
        f"WITH {I.CATALOGUE}, {I.REVIEWS}, c AS (SELECT {_ALL_BOOKS}, title, category_level_2_sub, price_numeric FROM catalogue "
        f"WHERE category_level_2_sub IS NOT NULL), r AS (SELECT {_ALL_REVIEWS}, user_id, rating, title, year FROM reviews) "
        f"SELECT {_JOIN_COLUMNS.replace('price_numeric', 'round(price_numeric, 6) AS price_numeric')} FROM c {how} JOIN r USING (parent_asin)"
    )


def _join_all(spark, d, how):
    named = drop_missing_target(I.catalogue(spark, d)).selectExpr(_ALL_BOOKS, "title", "category_level_2_sub", "price_numeric")
    facts = I.reviews(spark, d).selectExpr(_ALL_REVIEWS, "user_id", "rating", "title", "year")
    return joins.join_reviews(named, facts, how)


@query(_join_all_sql("INNER"))
def join_all_inner(spark, d):
    return _join_all(spark, d, "inner")


@query(_join_all_sql("LEFT"))
def join_all_left(spark, d):
    return _join_all(spark, d, "left")


@query(_join_all_sql("RIGHT"))
def join_all_right(spark, d):
    return _join_all(spark, d, "right")


@query(_join_all_sql("FULL"))
def join_all_outer(spark, d):
    return _join_all(spark, d, "outer")


@query(
    f"WITH {I.CATALOGUE}, {I.REVIEWS}, {_KEPT} SELECT count(*) AS rows, count(DISTINCT parent_asin) AS unique_books, "
    "count(DISTINCT user_id) AS unique_users FROM catalogue JOIN kept USING (parent_asin)"
)
def join_counts(spark, d):
    joined = joins.join_reviews(I.catalogue(spark, d), I.reviews(spark, d), "inner", 30)
    return joins.join_counts(joined)


@query(f"WITH {I.REVIEWS} SELECT parent_asin FROM reviews GROUP BY 1 HAVING count(*) >= 30")
def books_with_min_reviews(spark, d):
    return joins.books_with_min_reviews(I.reviews(spark, d), 30)


@query("SELECT * FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def keep_labelled_documents(spark, d):
    return joins.keep_keys(I.table(spark, d, "documents"), I.table(spark, d, "labels"), "doc_id")


@query("SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def drop_labelled_documents(spark, d):
    return joins.drop_keys(I.table(spark, d, "documents"), I.table(spark, d, "labels"), "doc_id")


@query(
    f"""WITH {I.CLEAN_REVIEWS} SELECT parent_asin, count(rating) AS review_count,
  round(avg(rating), 6) AS avg_rating_from_reviews, round(stddev_samp(rating), 6) AS rating_std,
  round(100 * avg(verified_purchase::INT), 6) AS verified_purchase_pct,
  sum(helpful_vote)::BIGINT AS helpful_votes_total, round(avg(length(text)), 6) AS review_text_avg_length
FROM clean_reviews GROUP BY 1"""
)
def review_features(spark, d):
    return aggregates.review_features(clean_reviews(I.reviews(spark, d, True)))


@query(
    """WITH f AS (SELECT doc_id, count(quality) AS review_count, avg(quality) AS m, stddev_samp(quality) AS s,
  100 * avg(toxic) AS v FROM labels GROUP BY 1)
SELECT doc_id, lang, coalesce(review_count, 0) AS review_count, round(coalesce(m, 3.0), 6) AS avg_rating_from_reviews,
  round(coalesce(s, 0.0), 6) AS rating_std, round(coalesce(v, 0.0), 6) AS verified_purchase_pct
FROM documents LEFT JOIN f USING (doc_id)"""
)
def enrich_sparse(spark, d):
    """Documents enriched by their labels; most have none and get defaults."""
    labels = I.table(spark, d, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("rating"), (F.col("toxic") == 1).alias("verified_purchase")
    )
    docs = I.table(spark, d, "documents").select("doc_id", "lang")
    return aggregates.enrich_with_reviews(docs, labels, "doc_id")


@query(
    """WITH f AS (SELECT doc_id, count(quality) AS n, avg(quality) AS m FROM labels GROUP BY 1),
j AS (SELECT doc_id, coalesce(n, 0) AS n, coalesce(m, 3.0) AS m, n IS NULL AS alone FROM documents LEFT JOIN f USING (doc_id))
SELECT (SELECT count(*) FROM f) AS books_with_reviews, count(*) FILTER (alone) AS books_without_reviews,
  4::BIGINT AS features_added, round(avg(n), 6) AS avg_review_count, max(n)::BIGINT AS max_review_count,
  round(avg(m), 6) AS avg_rating FROM j"""
)
def enrichment_counters(spark, d):
    labels = I.table(spark, d, "labels").select(
        "doc_id", F.col("quality").cast("double").alias("rating"), (F.col("toxic") == 1).alias("verified_purchase")
    )
    return aggregates.enrichment_counters(I.table(spark, d, "documents"), labels, "doc_id")


@query(
    f"""WITH {I.CLEAN_CATALOGUE}, sizes AS (
  SELECT category_level_2_sub AS category, count(*) AS count, sum(count(*)) OVER () AS total,
    avg(average_rating) AS r, avg(price_numeric) AS p, avg(page_count) AS g FROM clean_catalogue GROUP BY 1)
SELECT category, count, {I.half_even_sql('count / total * 100', 2)} AS percentage,
  {I.half_even_sql('r', 2)} AS avg_rating, {I.half_even_sql('p', 2)} AS avg_price, {I.half_even_sql('g', 0)} AS avg_pages FROM sizes"""
)
def category_analysis(spark, d):
    from shelfwise.operators.cleaning import clean_catalogue

    return aggregates.category_analysis(clean_catalogue(I.raw_catalogue(spark, d), order_by=["title"]))


@query("SELECT * FROM documents WHERE lang IN ('fr', 'de')")
def filter_category(spark, d):
    return aggregates.filter_by_category(I.table(spark, d, "documents"), ["fr", "de"], "lang")


_KEPT_SHARE = "count(*) FILTER (lang IN ('fr', 'de')) / count(*) * 100"


@query(
    "SELECT count(*) AS rows_before, count(*) FILTER (lang IN ('fr', 'de')) AS rows_after, "
    f"{I.half_even_sql(_KEPT_SHARE, 1)} AS kept_percentage FROM documents"
)
def filter_kept_share(spark, d):
    docs = I.table(spark, d, "documents")
    return aggregates.kept_share(docs, aggregates.filter_by_category(docs, ["fr", "de"], "lang"))


_FREQUENT = "frequent AS (SELECT p_brand FROM part GROUP BY 1 HAVING count(*) >= (SELECT count(*) / 25 FROM part))"


def _min_rows(parts) -> int:
    """The mean brand size, so that the filter bites at every scale."""
    return -(-parts.count() // 25)


@query(f"WITH {_FREQUENT} SELECT p_partkey, p_brand FROM part WHERE p_brand IN (SELECT p_brand FROM frequent)")
def rare_filter(spark, d):
    parts = I.table(spark, d, "part").select("p_partkey", "p_brand")
    return aggregates.filter_rare_categories(parts, "p_brand", _min_rows(parts))


@query(f"WITH {_FREQUENT} SELECT p_brand, count(*) AS n FROM part WHERE p_brand NOT IN (SELECT p_brand FROM frequent) GROUP BY 1")
def removed_categories(spark, d):
    parts = I.table(spark, d, "part")
    return aggregates.removed_categories(parts, "p_brand", _min_rows(parts))


@query(
    f"""WITH {_FREQUENT} SELECT count(*) AS original_count,
  count(*) FILTER (p_brand IN (SELECT p_brand FROM frequent)) AS final_count,
  count(DISTINCT p_brand) AS original_categories, (SELECT count(*) FROM frequent) AS final_categories,
  count(DISTINCT p_brand) - (SELECT count(*) FROM frequent) AS removed_categories FROM part"""
)
def rare_filter_counters(spark, d):
    parts = I.table(spark, d, "part")
    return aggregates.rare_filter_counters(parts, "p_brand", _min_rows(parts))


@query(
    f"WITH {I.REVIEWS}, n AS (SELECT parent_asin, count(*) AS review_count FROM reviews GROUP BY 1) "
    "SELECT * FROM n WHERE review_count >= 30"
)
def review_count_filter(spark, d):
    counts = aggregates.reviews_per_book(I.reviews(spark, d)).select(
        "parent_asin", F.col("num_reviews").alias("review_count")
    )
    return aggregates.filter_by_review_count(counts, 30)


@query("SELECT lang, count(*) AS n FROM documents WHERE lang NOT IN ('en', 'fr') GROUP BY 1")
def unknown_values(spark, d):
    return aggregates.unknown_values(I.table(spark, d, "documents"), "lang", ["en", "fr"])
