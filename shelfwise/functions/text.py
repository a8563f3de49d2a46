"""Text expressions: cleaning, fallbacks, combination, lengths, series titles.

Every pattern runs with ``(?Ud)``: Unicode character classes and only the
newline as line end. ``\\x1c-\\x1f`` are added because Java does not count
these four separators as white space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The removal patterns, applied in this order.
TAG_PATTERN = r"(?Ud)<[^>]+>"
URL_PATTERN = r"(?Ud)http[^\s\x1c-\x1f]+|www.[^\s\x1c-\x1f]+"
OTHER_PATTERN = r"(?Ud)[^a-z0-9\s\x1c-\x1f.,!?'\"-]"
SPACE_PATTERN = r"(?Ud)[\s\x1c-\x1f]+"
SERIES_PATTERN = r"(?U)(?:book \d+|volume \d+|part \d+|#\d+|vol\. \d+)"
NO_DESCRIPTION = "No description available"
NO_TEXT = "no_text"


def clean_text(text: Column) -> Column:
    """Lower-case, drop tags, URLs and other symbols, squeeze white space."""
    out = F.lower(F.coalesce(text.cast("string"), F.lit("")))
    for pattern in (TAG_PATTERN, URL_PATTERN, OTHER_PATTERN):
        out = F.regexp_replace(out, pattern, "")
    return F.trim(F.regexp_replace(out, SPACE_PATTERN, " "))


def is_blank(text: Column) -> Column:
    """True for null and for text of white space only."""
    return F.coalesce(F.regexp_replace(text, SPACE_PATTERN, "") == "", F.lit(True))


def clean_text_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Clean those of ``columns`` that the frame has."""
    return df.withColumns({c: clean_text(F.col(c)) for c in columns if c in df.columns})


def fallback_description(df: DataFrame) -> Column:
    """The description, else title, features and author, else a fixed sentence."""
    parts = [F.col(c) for c in ("title", "features_text") if c in df.columns]
    if "author_name" in df.columns:
        parts.append(F.concat(F.lit("by "), F.col("author_name")))
    nothing = F.lit(True)
    for part in parts:
        nothing = nothing & part.isNull()
    return (
        F.when(~is_blank(F.col("description")), F.col("description"))
        .when(nothing, F.lit(NO_DESCRIPTION))
        .otherwise(F.concat_ws(" ", *parts))
    )


def combined_text(title: Column, description: Column) -> Column:
    """Title and description joined for the text features; never empty."""
    both = F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.coalesce(description, F.lit("")))
    stripped = F.regexp_replace(both, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    return F.when(stripped == "", F.lit(NO_TEXT)).otherwise(stripped)


def text_length(text: Column) -> Column:
    """Code points, with null as zero."""
    return F.length(F.coalesce(text, F.lit("")))


def has_series(title: Column) -> Column:
    """1 where the title carries a series number such as ``book 2`` or ``#4``."""
    return F.lower(F.coalesce(title, F.lit(""))).rlike(SERIES_PATTERN).cast("int")
