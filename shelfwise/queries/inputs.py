"""The given tables seen as catalogue, reviews and texts.

Each frame has its SQL twin, so that a query and its check start alike. The
catalogue stands on ``part``, the reviews on ``lineitem``, texts and targets on
``documents``. Missing, blank, invalid and duplicate values come from
conditions on size, price and discount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise.session import spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A table of long texts, spread over the task slots where it is small."""
    return spread(table(spark, sf_dir, name))


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per part."""
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS parent_asin",
        "p_name AS title",
        "CASE WHEN p_size = 50 THEN NULL ELSE p_brand END AS category_level_2_sub",
        "p_type AS category_level_1_main",
        """CASE WHEN p_size >= 45 THEN NULL WHEN p_size <= 3 THEN '  '
           ELSE concat('The <b>', p_type, '</b> ', p_name, ' (Part ', p_size, ') at http://shop/', p_partkey, ' #', p_size)
           END AS description""",
        "CASE WHEN p_size < 48 THEN concat(p_type, ' & more') END AS features_text",
        "CASE WHEN p_size NOT IN (46, 49) THEN concat('Maker ', p_brand) END AS author_name",
        "p_retailprice - 905 AS price_numeric",
        "CASE WHEN p_size <= 2 THEN p_size * 1D ELSE p_size * 105D END AS page_count",
        "p_size / 8D AS average_rating",
        "p_size * 10L AS rating_number",
        "CASE WHEN p_size <= 40 THEN p_type END AS format",
    )


CATALOGUE = """catalogue AS (
  SELECT p_partkey AS parent_asin, p_name AS title,
    CASE WHEN p_size = 50 THEN NULL ELSE p_brand END AS category_level_2_sub,
    p_type AS category_level_1_main,
    CASE WHEN p_size >= 45 THEN NULL WHEN p_size <= 3 THEN '  '
      ELSE concat('The <b>', p_type, '</b> ', p_name, ' (Part ', p_size, ') at http://shop/', p_partkey, ' #', p_size)
      END AS description,
    CASE WHEN p_size < 48 THEN concat(p_type, ' & more') END AS features_text,
    CASE WHEN p_size NOT IN (46, 49) THEN concat('Maker ', p_brand) END AS author_name,
    p_retailprice - 905 AS price_numeric,
    CASE WHEN p_size <= 2 THEN p_size * 1::DOUBLE ELSE p_size * 105::DOUBLE END AS page_count,
    p_size / 8::DOUBLE AS average_rating,
    p_size::BIGINT * 10 AS rating_number,
    CASE WHEN p_size <= 40 THEN p_type END AS format
  FROM part)"""


def raw_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue with a reprint of every larger part: duplicate keys."""
    books = catalogue(spark, sf_dir)
    reprints = books.where("rating_number > 250").withColumn("title", F.concat("title", F.lit(" reprint")))
    return books.unionByName(reprints)


RAW_CATALOGUE = f"""{CATALOGUE}, raw_catalogue AS (
  SELECT * FROM catalogue
  UNION ALL BY NAME
  SELECT * REPLACE (title || ' reprint' AS title) FROM catalogue WHERE rating_number > 250)"""


def reviews(spark: SparkSession, sf_dir: str, long_work: bool = False) -> DataFrame:
    """One row per line item; ratings 0 and 6 are invalid, some texts empty."""
    items = table(spark, sf_dir, "lineitem")
    return (spread(items) if long_work else items).selectExpr(
        "l_partkey AS parent_asin",
        "l_suppkey AS user_id",
        "CAST(CAST(l_quantity AS INT) % 7 AS DOUBLE) AS rating",
        "concat(l_returnflag, l_linestatus) AS title",
        """CASE WHEN l_discount >= 0.1D THEN '###'
           ELSE concat(l_returnflag, ' ', l_linestatus, ' <i>lot</i> ', l_linenumber) END AS text""",
        "CAST(l_linenumber - 3 AS BIGINT) AS helpful_vote",
        "l_returnflag = 'R' AS verified_purchase",
        "year(l_shipdate) AS year",
    )


REVIEWS = """reviews AS (
  SELECT l_partkey AS parent_asin, l_suppkey AS user_id,
    (l_quantity::INT % 7)::DOUBLE AS rating,
    concat(l_returnflag, l_linestatus) AS title,
    CASE WHEN l_discount >= 0.1::DOUBLE THEN '###'
      ELSE concat(l_returnflag, ' ', l_linestatus, ' <i>lot</i> ', l_linenumber) END AS text,
    (l_linenumber - 3)::BIGINT AS helpful_vote,
    l_returnflag = 'R' AS verified_purchase,
    year(l_shipdate) AS year
  FROM lineitem)"""


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as catalogue rows: title is the first line, target the language."""
    return texts(spark, sf_dir).selectExpr(
        "doc_id", "split_part(text, '\n', 1) AS title", "text AS description", "lang AS category_level_2_sub", "source"
    )


BOOKS = """books AS (
  SELECT doc_id, split_part(text, chr(10), 1) AS title, text AS description, lang AS category_level_2_sub, source
  FROM documents)"""


def clean_sql(column: str) -> str:
    """The cleaning of a text column in SQL."""
    return (
        "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace("
        f"lower(coalesce({column}, '')), '<[^>]+>', '', 'g'), 'http\\S+|www.\\S+', '', 'g'), "
        "'[^a-z0-9\\s.,!?''\"-]', '', 'g'), '\\s+', ' ', 'g'))"
    )


def half_even_sql(expression: str, digits: int) -> str:
    """Scale, round half to even, scale back."""
    scale = f"{10**digits}::DOUBLE"
    return f"round_even(({expression}) * {scale}, 0) / {scale}"


CLEAN_CATALOGUE = f"""{RAW_CATALOGUE}, first_rows AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY parent_asin ORDER BY title) AS rn FROM raw_catalogue) WHERE rn = 1),
clean_catalogue AS (
  SELECT parent_asin, category_level_2_sub, category_level_1_main, rating_number, format,
    {clean_sql('title')} AS title,
    {clean_sql('''CASE WHEN trim(coalesce(description, '')) <> '' THEN description
      WHEN title IS NULL AND features_text IS NULL AND author_name IS NULL THEN 'No description available'
      ELSE concat_ws(' ', title, features_text, 'by ' || author_name) END''')} AS description,
    {clean_sql('features_text')} AS features_text,
    {clean_sql('author_name')} AS author_name,
    CASE WHEN price_numeric >= 0 THEN price_numeric END AS price_numeric,
    CASE WHEN page_count BETWEEN 10 AND 5000 THEN page_count END AS page_count,
    CASE WHEN average_rating BETWEEN 1 AND 5 THEN average_rating END AS average_rating
  FROM first_rows WHERE category_level_2_sub IS NOT NULL)"""

# The order within duplicates is every column, in the order of the frame.
CLEAN_REVIEWS = f"""{REVIEWS}, first_reviews AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY parent_asin, user_id, rating, text
      ORDER BY title, helpful_vote, verified_purchase, year) AS rn FROM reviews) WHERE rn = 1),
clean_reviews AS (
  SELECT * FROM (
    SELECT parent_asin, user_id, rating, title, {clean_sql('text')} AS text,
      greatest(helpful_vote, 0)::BIGINT AS helpful_vote, verified_purchase, year::BIGINT AS year
    FROM first_reviews WHERE rating BETWEEN 1 AND 5) WHERE text <> '')"""

ENRICHED = f"""{CLEAN_CATALOGUE}, {CLEAN_REVIEWS}, review_features AS (
  SELECT parent_asin, count(rating)::BIGINT AS review_count, avg(rating) AS avg_rating_from_reviews,
    stddev_samp(rating) AS rating_std, 100 * avg(verified_purchase::INT) AS verified_purchase_pct,
    sum(helpful_vote)::BIGINT AS helpful_votes_total, avg(length(text)) AS review_text_avg_length
  FROM clean_reviews GROUP BY parent_asin),
enriched AS (
  SELECT c.*, coalesce(review_count, 0) AS review_count,
    coalesce(avg_rating_from_reviews, 3.0) AS avg_rating_from_reviews, coalesce(rating_std, 0.0) AS rating_std,
    coalesce(verified_purchase_pct, 0.0) AS verified_purchase_pct,
    coalesce(helpful_votes_total, 0) AS helpful_votes_total,
    coalesce(review_text_avg_length, 0.0) AS review_text_avg_length
  FROM clean_catalogue c LEFT JOIN review_features USING (parent_asin))"""


# Spark's English stop words, as far as they are whole words of two characters or more.
STOP_WORDS = tuple(
    "me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself "
    "they them their theirs themselves what which who whom this that these those am is are was were be been being have has had having "
    "do does did doing an the and but if or because as until while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further then once here there when where why how all any both each "
    "few more most other some such no nor not only own same so than too very can cannot could would ought will just don should now".split()
)


def class_query(source: str, class_column: str, key: str) -> str:
    """CTEs ``rows_`` and ``ranked`` (class, key, rank by hash, class size)."""
    return f"""rows_ AS (SELECT {class_column} AS c, {key} AS k FROM {source} WHERE {class_column} IS NOT NULL),
ranked AS (
  SELECT c, k, row_number() OVER (PARTITION BY c ORDER BY md5('42:' || k), k) AS rn,
    count(*) OVER (PARTITION BY c) AS n FROM rows_)"""


def quota_query(test_size: float = 0.2) -> str:
    """CTE ``quotas``: largest-remainder train and test rows per class of ``rows_``."""
    return f"""sizes AS (SELECT c, count(*) AS n FROM rows_ GROUP BY c),
totals AS (SELECT sum(n) AS total, ceil(sum(n)::DOUBLE * {test_size}::DOUBLE)::HUGEINT AS test FROM sizes),
scaled AS (SELECT c, n, total - test AS train, (n::HUGEINT * (total - test)) // total AS base,
  (n::HUGEINT * (total - test)) % total AS rest FROM sizes, totals),
quotas AS (
  SELECT c, n, (base + CASE WHEN row_number() OVER (ORDER BY rest DESC, c) <= train - sum(base) OVER () THEN 1 ELSE 0 END)::BIGINT
    AS train_rows FROM scaled)"""
