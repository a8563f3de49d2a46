"""Column names and types of the catalogue and review tables."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "parent_asin"
TARGET = "category_level_2_sub"

# Column lists of the two input tables.
REQUIRED_CATALOGUE = ["parent_asin", "title", "category_level_2_sub", "description"]
OPTIONAL_CATALOGUE = [
    "author_name",
    "price_numeric",
    "page_count",
    "average_rating",
    "rating_number",
    "category_level_1_main",
    "features_text",
    "publisher",
    "format",
    "language",
]
REQUIRED_REVIEWS = ["parent_asin", "user_id", "rating", "text"]
OPTIONAL_REVIEWS = [
    "title",
    "images",
    "asin",
    "timestamp",
    "helpful_vote",
    "verified_purchase",
    "date",
    "year",
]

CATALOGUE_TYPES: dict[str, T.DataType] = {
    "parent_asin": T.StringType(),
    "title": T.StringType(),
    "description": T.StringType(),
    "category_level_2_sub": T.StringType(),
    "category_level_1_main": T.StringType(),
    "author_name": T.StringType(),
    "features_text": T.StringType(),
    "publisher": T.StringType(),
    "format": T.StringType(),
    "language": T.StringType(),
    "price_numeric": T.DoubleType(),
    "price": T.DoubleType(),
    "page_count": T.DoubleType(),
    "average_rating": T.DoubleType(),
    "rating_number": T.LongType(),
}
REVIEW_TYPES: dict[str, T.DataType] = {
    "parent_asin": T.StringType(),
    "user_id": T.StringType(),
    "rating": T.DoubleType(),
    "text": T.StringType(),
    "title": T.StringType(),
    "images": T.StringType(),
    "asin": T.StringType(),
    "timestamp": T.StringType(),
    "date": T.StringType(),
    "helpful_vote": T.LongType(),
    "verified_purchase": T.BooleanType(),
    "year": T.IntegerType(),
}

# What a book without reviews gets after enrichment.
ENRICHMENT_DEFAULTS = {
    "review_count": 0,
    "avg_rating_from_reviews": 3.0,
    "rating_std": 0.0,
    "verified_purchase_pct": 0.0,
    "helpful_votes_total": 0,
    "review_text_avg_length": 0.0,
}

TEXT_COLUMNS = ["title", "description", "features_text", "author_name"]
PROFILE_TEXT_COLUMNS = ["title", "description", "features_text"]
PROFILE_NUMERIC_COLUMNS = ["price_numeric", "page_count", "average_rating", "rating_number"]

# Numeric model inputs; the price, review length and vote names are those that
# cleaning and enrichment produce.
NUMERIC_FEATURES = [
    "price_numeric",
    "average_rating",
    "review_count",
    "rating_std",
    "verified_purchase_pct",
    "helpful_votes_total",
    "review_text_avg_length",
]
ENGINEERED_FEATURES = [
    "title_length",
    "desc_length",
    "has_series",
    "price_rating_ratio",
    "engagement_score",
]
CATEGORICAL_FEATURES = ["format", "binned_rating", "price_category"]

REQUEST_SCHEMA = T.StructType(
    [
        T.StructField("title", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("rating_count", T.IntegerType()),
        T.StructField("book_format", T.StringType()),
    ]
)
