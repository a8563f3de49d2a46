import math
import random

import pandas as pd
import pytest

from shelfwise.operators import aggregates, joins, profile

NAN = float("nan")


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(5)
    books = [(f"b{i}", f"T{i}", rng.choice(["X", "Y", "Z", None])) for i in range(30)] + [("b3", "copy", "X")]
    keys = ["b1"] * 20 + [f"b{i}" for i in range(2, 40)]
    reviews = [
        (rng.choice(keys), f"u{rng.randrange(9)}", rng.choice([1.0, 2.0, 4.5, 5.0, None]), f"R{i}") for i in range(300)
    ]
    return (
        spark.createDataFrame(books, "parent_asin string, title string, category_level_2_sub string"),
        spark.createDataFrame(reviews, "parent_asin string, user_id string, rating double, title string"),
    )


def as_rows(frame):
    out = frame.astype(object).where(frame.notna(), None)
    return sorted(map(tuple, out.to_numpy().tolist()), key=repr)


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("minimum", [1, 8])
def test_join_matches_pandas(tables, how, minimum):
    books, reviews = tables
    got = joins.join_reviews(books, reviews, how, minimum).toPandas()
    facts = reviews.toPandas()
    counts = facts["parent_asin"].value_counts()
    facts = facts[facts["parent_asin"].isin(counts[counts >= minimum].index)]
    want = books.toPandas().merge(facts, on="parent_asin", how=how, suffixes=("_book", "_review"))
    assert list(got.columns) == list(want.columns)
    assert as_rows(got) == as_rows(want)


def test_null_keys_never_match_but_outer_keeps_them(spark):
    books = spark.createDataFrame([(None, "n"), ("a", "x")], "parent_asin string, t string")
    reviews = spark.createDataFrame([(None, 1.0), ("a", 2.0)], "parent_asin string, rating double")
    assert joins.join_reviews(books, reviews, "inner").count() == 1
    assert joins.join_reviews(books, reviews, "left").count() == 2
    assert joins.join_reviews(books, reviews, "right").count() == 2
    assert joins.join_reviews(books, reviews, "outer").count() == 3


def test_join_rejects_other_types(tables):
    with pytest.raises(ValueError):
        joins.join_reviews(*tables, how="cross")


def test_rating_by_category_matches_pandas(tables):
    books, reviews = tables
    got = aggregates.rating_by_category(books, reviews).toPandas().set_index("category_level_2_sub").sort_index()
    joined = books.toPandas().merge(reviews.toPandas(), on="parent_asin")
    g = joined.groupby("category_level_2_sub")
    want = pd.DataFrame(
        {
            "num_reviews": g["rating"].count(),
            "avg_rating": g["rating"].mean(),
            "rating_std": g["rating"].std(),
            "median_rating": g["rating"].median(),
            "num_books": g["parent_asin"].nunique(),
        }
    )
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_rating_std_of_one_review_is_missing(spark):
    books = spark.createDataFrame([("a", "X")], "parent_asin string, category_level_2_sub string")
    reviews = spark.createDataFrame([("a", 4.0)], "parent_asin string, rating double")
    row = aggregates.rating_by_category(books, reviews).first()
    assert (row["num_reviews"], row["avg_rating"], row["rating_std"], row["median_rating"]) == (1, 4.0, None, 4.0)


def test_category_analysis_counts_uncategorised_rows_in_the_total(spark):
    rows = [("X", 4.0, 10.0), ("X", NAN, 20.0), (None, 1.0, 1.0), ("Y", 3.0, None)]
    df = spark.createDataFrame(rows, "category_level_2_sub string, average_rating double, price_numeric double")
    got = [tuple(r) for r in aggregates.category_analysis(df).collect()]
    assert got == [("X", 2, 50.0, 4.0, 15.0, None), ("Y", 1, 25.0, 3.0, None, None)]


def test_rare_filter_keeps_exact_minimum(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 2 + [(None,)] * 5, "category_level_2_sub string")
    assert aggregates.filter_rare_categories(df, min_samples=3).count() == 3
    assert [tuple(r) for r in aggregates.removed_categories(df, min_samples=3).collect()] == [("b", 2)]
    counters = aggregates.rare_filter_counters(df, min_samples=3).first().asDict()
    assert counters == {
        "original_count": 10, "final_count": 3, "original_categories": 2, "final_categories": 1, "removed_categories": 1,
    }


def test_review_count_filter_is_optional(spark):
    df = spark.createDataFrame([(1,), (5,)], "review_count int")
    assert aggregates.filter_by_review_count(df, 0).count() == 2
    assert aggregates.filter_by_review_count(df, 5).count() == 1
    assert aggregates.filter_by_review_count(df.withColumnRenamed("review_count", "n"), 5).count() == 2


def test_distribution_breaks_ties_by_name_and_names_known_columns(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "category_level_2_sub string")
    assert [tuple(r) for r in profile.category_distribution(df).collect()] == [("c", 2), ("a", 1), ("b", 1)]
    assert profile.category_distribution(df, top_n=1).count() == 1
    with pytest.raises(ValueError, match="category_level_2_sub"):
        profile.category_distribution(df, "other")


def test_validate_schema(spark):
    books = spark.createDataFrame([], "parent_asin string, title string, price_numeric double")
    report = profile.validate_schema(books)
    assert set(report) == {"catalogue"}
    assert report["catalogue"]["missing_required_columns"] == ["category_level_2_sub", "description"]
    assert report["catalogue"]["optional_columns_present"]["price_numeric"]
    assert not report["catalogue"]["has_required_columns"]
    reviews = spark.createDataFrame([], "parent_asin string, user_id string, rating double, text string")
    assert profile.validate_schema(books, reviews)["reviews"]["has_required_columns"]


def test_missing_report_counts_null_and_nan(spark):
    df = spark.createDataFrame([(1.0, "a"), (NAN, None), (None, "b")], "x double, s string")
    got = [tuple(r) for r in profile.missing_report(df).collect()]
    assert got == [("x", 2, 66.67, "double"), ("s", 1, 33.33, "string")]


def test_profiles_match_pandas(spark):
    rng = random.Random(1)
    data = [rng.choice([None, NAN, rng.random() * 50]) for _ in range(200)]
    df = spark.createDataFrame([(v, "x" * (i % 13) if i % 5 else None) for i, v in enumerate(data)], "page_count double, title string")
    numbers = pd.Series([NAN if v is None else v for v in data])
    row = profile.numeric_profile(df).first()
    assert row["count"] == numbers.count() and row["missing"] == numbers.isna().sum()
    assert row["mean"] == round(numbers.mean(), 2) and row["std"] == round(numbers.std(), 2)
    assert row["median"] == pytest.approx(numbers.median(), rel=1e-12)
    lengths = pd.Series(["x" * (i % 13) for i in range(200) if i % 5]).str.len()
    row = profile.text_profile(df).first()
    assert row["avg_length"] == round(lengths.mean(), 2) and row["median_length"] == lengths.median()
    assert (row["missing_count"], row["max_length"], row["min_length"]) == (40, 12, 0)


def test_describe_matches_pandas(spark):
    data = [float(x) for x in (1, 2, 2, 3, 9, 11, 40)]
    row = profile.describe_column(spark.createDataFrame([(v,) for v in data], "n double"), "n").first()
    want = pd.Series(data).describe()
    got = [row[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
    assert all(math.isclose(a, b) for a, b in zip(got, want))


SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
@pytest.mark.parametrize("minimum, bound", [(1, 50_000), (5, 50_000), (5, 10)])
def test_hot_book_is_split_in_the_join(spark, capsys, monkeypatch, how, minimum, bound):
    from shelfwise.session import small_side

    monkeypatch.setattr(joins, "small_side", lambda df: small_side(df, bound))
    before = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    try:
        books = spark.range(2000).selectExpr("id AS parent_asin", "concat('t', id) AS title")
        # Book 7 holds a third of the reviews.
        reviews = spark.range(0, 60_000, 1, 6).selectExpr(
            "CASE WHEN id < 20000 THEN 7 ELSE id % 3000 END AS parent_asin", "id AS user_id", "sha2(string(id), 256) AS text"
        )
        joined = joins.join_reviews(books, reviews, how, minimum)
        n = len(joined.collect())
        joined.explain()
        assert "skew=true" in capsys.readouterr().out
        matched = reviews.where("parent_asin < 2000").count()
        extra = {"inner": 0, "left": 0, "right": reviews.count() - matched, "outer": reviews.count() - matched}
        assert n == matched + extra[how]
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_few_missing_values_among_many_are_reported(spark):
    from shelfwise.operators import profile

    rows = spark.range(1_000_000).selectExpr("if(id < 4, null, id) AS k")
    assert profile.missing_required(rows, ["k"]).first().missing_count == 4
