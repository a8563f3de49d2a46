"""Catalogue and review joins.

A hot book can own a third of all reviews. Adaptive execution splits such a
partition only in a join of two freshly shuffled inputs, and only on the side
whose unmatched rows need not be kept. So the reviews take part in no chain of
joins on the same key, and the forms that keep unmatched catalogue rows are a
splittable join plus the rows without a partner.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from shelfwise import schemas as S
from shelfwise.session import cut_lineage, small_side


def books_with_min_reviews(reviews: DataFrame, min_reviews: int, key: str = S.KEY) -> DataFrame:
    """Keys with at least ``min_reviews`` reviews, one row each."""
    keyed = reviews.where(F.col(key).isNotNull())
    return (
        keyed.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_reviews)
        .select(key)
    )


def _suffix_overlap(catalogue: DataFrame, reviews: DataFrame, key: str):
    shared = (set(catalogue.columns) & set(reviews.columns)) - {key}
    return (
        catalogue.withColumnsRenamed({c: f"{c}_book" for c in shared}),
        reviews.withColumnsRenamed({c: f"{c}_review" for c in shared}),
    )


def join_reviews(
    catalogue: DataFrame,
    reviews: DataFrame,
    how: str = "inner",
    min_reviews_per_book: int = 1,
    key: str = S.KEY,
) -> DataFrame:
    """Join both tables on the key, after an optional review-count filter.

    Shared column names get ``_book`` and ``_review``. Null keys never match;
    an outer form still keeps their rows.
    """
    if how not in ("inner", "left", "right", "outer"):
        raise ValueError(f"unsupported join type: {how!r}")
    left, right = _suffix_overlap(catalogue, reviews, key)
    filtered = min_reviews_per_book > 1
    keys = books_with_min_reviews(right, max(1, min_reviews_per_book), key)
    columns = [key, *[c for c in left.columns if c != key], *[c for c in right.columns if c != key]]
    if filtered:
        # The catalogue is filtered rather than the far larger reviews. Few
        # keys are broadcast; else the filtered catalogue is written, so that
        # the join below reads two plain inputs either way.
        # The counts per key are taken once, whatever the form needs them for.
        keys = cut_lineage(keys, "book_keys")
        few = small_side(keys)
        wanted = left.join(few, key, "left_semi")
        if few is keys:
            wanted = cut_lineage(wanted, "wanted_books")
        parts = [wanted.join(right, key, "inner").select(*columns)]
        if how in ("right", "outer"):
            orphans = keys.join(left, key, "left_anti")
            few = small_side(orphans)
            if few is orphans:
                few = cut_lineage(orphans, "orphan_keys")
            parts.append(right.join(few, key, "left_semi"))
    elif how in ("inner", "left"):
        parts = [left.join(right, key, "inner").select(*columns)]
    else:
        parts = [right.join(left, key, "left").select(*columns)]
    if how in ("left", "outer"):
        parts.append(left.join(keys, key, "left_anti"))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def join_counts(joined: DataFrame, key: str = S.KEY) -> DataFrame:
    """Rows, distinct books and distinct users of a joined table."""
    return joined.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(key).alias("unique_books"),
        F.count_distinct("user_id").alias("unique_users"),
    )


def keep_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is among the keys."""
    return df.join(keys.select(column), column, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is not among the keys."""
    return df.join(keys.select(column), column, "left_anti")
