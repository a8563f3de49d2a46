import random

import pandas as pd
from test_text import python_clean

from shelfwise.operators import cleaning
from shelfwise.operators.aggregates import enrich_with_reviews

NAN = float("nan")
REVIEW = "seq int, parent_asin string, user_id string, rating double, text string, helpful_vote bigint, verified_purchase boolean"


def random_reviews(n, seed=3):
    rng = random.Random(seed)
    texts = ["Good <b>book</b>", "###", "good book", None, "www.x.com", "So-so!", "café"]
    # One book holds a third of the rows.
    books = ["hot"] * 10 + [f"b{i}" for i in range(20)]
    return [
        (
            i,
            rng.choice(books),
            f"u{rng.randrange(6)}",
            rng.choice([0.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None, NAN]),
            rng.choice(texts),
            rng.choice([None, -2, 0, 3]),
            rng.choice([None, True, False]),
        )
        for i in range(n)
    ]


def test_keep_first_with_nulls_and_payloads(spark):
    rows = [("k", 2, "b"), ("k", 1, "a"), (None, 5, "x"), (None, 4, "y"), ("z", 9, None)]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    got = {tuple(r) for r in cleaning.keep_first(df, ["k"], ["o"]).collect()}
    assert got == {("k", 1, "a"), (None, 4, "y"), ("z", 9, None)}


def test_keep_first_limits_before_the_shuffle(spark, capsys):
    df = spark.range(100).selectExpr("id % 3 AS k", "id")
    cleaning.keep_first(df, ["k"], ["id"]).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan and "WindowGroupLimit" in plan


def test_clean_reviews_matches_pandas(spark):
    rows = random_reviews(600)
    df = spark.createDataFrame(rows, REVIEW)
    got = cleaning.clean_reviews(df, order_by=["seq"]).toPandas().sort_values("seq").reset_index(drop=True)

    want = pd.DataFrame(rows, columns=[c.split()[0] for c in REVIEW.split(", ")])
    want["rating"] = want["rating"].astype(float)
    want = want.drop_duplicates(["parent_asin", "user_id", "rating", "text"], keep="first")
    want = want[want["rating"].between(1, 5)].copy()
    want["text"] = want["text"].map(python_clean)
    want = want[want["text"] != ""].reset_index(drop=True)
    assert list(got["seq"]) == list(want["seq"])
    assert list(got["text"]) == list(want["text"])
    assert list(got["helpful_vote"]) == [max(0, int(v)) if pd.notna(v) else 0 for v in want["helpful_vote"]]
    assert list(got["verified_purchase"]) == [v is True for v in want["verified_purchase"]]


def test_enrichment_matches_pandas(spark):
    reviews = cleaning.clean_reviews(spark.createDataFrame(random_reviews(600), REVIEW), order_by=["seq"])
    books = spark.createDataFrame([(f"b{i}",) for i in range(25)] + [("hot",)], "parent_asin string")
    got = enrich_with_reviews(books, reviews).toPandas().set_index("parent_asin").sort_index()

    facts = reviews.toPandas()
    facts["length"] = facts["text"].str.len()
    g = facts.groupby("parent_asin")
    want = pd.DataFrame(
        {
            "review_count": g["rating"].count(),
            "avg_rating_from_reviews": g["rating"].mean(),
            "rating_std": g["rating"].std(),
            "verified_purchase_pct": g["verified_purchase"].mean() * 100,
            "helpful_votes_total": g["helpful_vote"].sum(),
            "review_text_avg_length": g["length"].mean(),
        }
    ).reindex(got.index)
    defaults = dict(zip(want.columns, [0, 3.0, 0.0, 0.0, 0, 0.0]))
    pd.testing.assert_frame_equal(got, want.fillna(defaults), check_dtype=False)


def test_catalogue_counters_add_up(spark):
    schema = "parent_asin string, title string, description string, category_level_2_sub string, price_numeric double"
    rows = [
        ("a", "Book 2", None, "X", -1.0),
        ("a", "Book 3", "d", "X", 2.0),
        ("b", "T", "  ", None, 3.0),
        ("c", "T", "Fine <i>text</i>", "Y", NAN),
        (None, "N", "d", "Y", 1.0),
        (None, "O", "d", "Y", 1.0),
    ]
    df = spark.createDataFrame(rows, schema)
    clean = {r["parent_asin"]: r for r in cleaning.clean_catalogue(df, order_by=["title"]).collect()}
    assert set(clean) == {"a", "c", None}
    assert clean["a"]["description"] == "book 2" and clean["a"]["price_numeric"] is None
    assert clean["c"]["description"] == "fine text" and clean["c"]["price_numeric"] is None
    counters = {r["metric"]: r["value"] for r in cleaning.catalogue_counters(df).collect()}
    assert counters["original_count"] - counters["total_removed"] == counters["final_count"] == 3
    assert counters["duplicates_removed"] == 2 and counters["no_category_removed"] == 1
    assert counters["blank_descriptions_filled"] == 1


def test_review_counters_add_up(spark):
    df = spark.createDataFrame(random_reviews(300), REVIEW)
    clean_rows = cleaning.clean_reviews(df).count()
    counters = {r["metric"]: r["value"] for r in cleaning.review_counters(df).collect()}
    assert counters["final_count"] == clean_rows
    assert counters["original_count"] - counters["total_removed"] == clean_rows
