"""Numeric expressions: missing values, ranges, rounding, bins, ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Right-closed bins.
RATING_BINS = [(0.0, 3.0, "low"), (3.0, 4.0, "medium"), (4.0, 4.5, "high"), (4.5, 5.0, "very_high")]
PRICE_BINS = [
    (0.0, 10.0, "budget"),
    (10.0, 20.0, "moderate"),
    (20.0, 50.0, "premium"),
    (50.0, float("inf"), "luxury"),
]
# Inclusive bounds outside which a number counts as missing.
VALID_RANGES = {
    "price_numeric": (0.0, None),
    "page_count": (10.0, 5000.0),
    "average_rating": (1.0, 5.0),
}


def is_missing(column: Column, data_type: T.DataType) -> Column:
    """Null, or NaN in a floating point column."""
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into null in every floating point column."""
    return df.withColumns(
        {
            f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
            for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        }
    )


def round_half_even(column: Column, digits: int = 0) -> Column:
    """Round like NumPy: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(column * scale) / scale


def in_range(column: Column, low: float | None, high: float | None) -> Column:
    """The value where it lies within the inclusive bounds, else null."""
    keep = F.lit(True)
    if low is not None:
        keep = keep & (column >= low)
    if high is not None:
        keep = keep & (column <= high)
    return F.when(keep & ~F.isnan(column.cast("double")), column)


def clean_ranges(df: DataFrame) -> DataFrame:
    """Null out-of-range prices, page counts and ratings, where present."""
    return df.withColumns(
        {c: in_range(F.col(c), *bounds) for c, bounds in VALID_RANGES.items() if c in df.columns}
    )


def coerce_number(column: Column) -> Column:
    """Parse as a number; what does not parse, null and NaN become 0."""
    parsed = column.try_cast("double")
    return F.coalesce(F.nanvl(parsed, F.lit(None).cast("double")), F.lit(0.0))


def binned(column: Column, bins: list[tuple[float, float, str]]) -> Column:
    """Label of the right-closed bin, ``unknown`` outside all of them."""
    number = F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for low, high, label in bins:
        out = out.when((number > low) & (number <= high), F.lit(label))
    return out.otherwise(F.lit("unknown"))


def finite_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, with 0 where it is null or not finite."""
    ratio = F.try_divide(numerator.cast("double"), denominator.cast("double"))
    finite = ~F.isnan(ratio) & (F.abs(ratio) != float("inf"))
    return F.when(finite, ratio).otherwise(F.lit(0.0))


def engagement(review_count: Column, rating: Column) -> Column:
    """``log(1 + reviews) * rating`` with missing inputs as 0."""
    return F.log1p(coerce_number(review_count)) * coerce_number(rating)


def non_negative_int(column: Column) -> Column:
    """Missing and negative counts become 0."""
    return F.greatest(F.coalesce(column.try_cast("bigint"), F.lit(0)), F.lit(0)).cast("int")


def flag(column: Column) -> Column:
    """Missing flags become false."""
    return F.coalesce(column.cast("boolean"), F.lit(False))
