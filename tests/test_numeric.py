import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfwise.functions import numeric as N

NAN, INF = float("nan"), float("inf")


def values(spark, data, expression, kind="double"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("x"))).collect()]


def test_rounding_matches_numpy(spark):
    data = [0.5, 1.5, 2.5, -0.5, 2.675, 1.005, 33.335, 1 / 3]
    assert values(spark, data, lambda c: N.round_half_even(c, 2)) == list(np.round(data, 2))
    assert values(spark, data, lambda c: N.round_half_even(c, 0)) == list(np.round(data, 0))


def test_rating_bins_are_right_closed(spark):
    data = [0.0, 0.1, 3.0, 3.01, 4.0, 4.5, 4.51, 5.0, 5.1, None, NAN]
    got = values(spark, data, lambda c: N.binned(c, N.RATING_BINS))
    edges = pd.cut(pd.Series(data, dtype=float), [0, 3, 4, 4.5, 5], labels=["low", "medium", "high", "very_high"])
    assert got == ["unknown" if pd.isna(v) else v for v in edges]


def test_price_bins_are_right_closed(spark):
    data = [-1.0, 0.0, 10.0, 10.01, 20.0, 50.0, 50.01, 1e9, INF, None]
    got = values(spark, data, lambda c: N.binned(c, N.PRICE_BINS))
    assert got == ["unknown", "unknown", "budget", "moderate", "moderate", "premium", "luxury", "luxury", "luxury", "unknown"]


def test_ranges_are_inclusive(spark):
    rows = [(0.0, 10.0, 1.0), (-0.1, 9.9, 0.9), (5.0, 5000.0, 5.0), (None, 5001.0, 5.1), (NAN, NAN, NAN)]
    df = spark.createDataFrame(rows, "price_numeric double, page_count double, average_rating double")
    got = [tuple(r) for r in N.clean_ranges(df).collect()]
    assert got == [(0.0, 10.0, 1.0), (None, None, None), (5.0, 5000.0, 5.0), (None, None, None), (None, None, None)]


def test_coerce_number(spark):
    assert values(spark, ["1.5", " 2 ", "x", None, "NaN"], N.coerce_number, "string") == [1.5, 2.0, 0.0, 0.0, 0.0]


def test_finite_ratio(spark):
    rows = [(6.0, 3.0), (1.0, 0.0), (0.0, 0.0), (None, 2.0), (1.0, None), (NAN, 1.0), (INF, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert [r[0] for r in df.select(N.finite_ratio(F.col("a"), F.col("b"))).collect()] == [2.0, 0, 0, 0, 0, 0, 0]


def test_engagement(spark):
    df = spark.createDataFrame([(9, 2.0), (None, 4.0), (3, None)], "n int, r double")
    got = [r[0] for r in df.select(N.engagement(F.col("n"), F.col("r"))).collect()]
    assert np.allclose(got, [np.log(10) * 2, 0, 0])


def test_votes_and_flags(spark):
    assert values(spark, [-1, None, 0, 7], N.non_negative_int, "bigint") == [0, 0, 0, 7]
    assert values(spark, [2.0, NAN, None, -3.0], N.non_negative_int) == [2, 0, 0, 0]
    assert values(spark, [True, None, False], N.flag, "boolean") == [True, False, False]


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(NAN, "a"), (1.0, None)], "x double, s string")
    assert [r.x for r in N.nan_to_null(df).collect()] == [None, 1.0]
