import re

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import text


def python_clean(value):
    if value is None:
        return ""
    value = value.lower()
    for pattern in (r"<[^>]+>", r"http\S+|www.\S+", r"[^a-z0-9\s.,!?'\"-]"):
        value = re.sub(pattern, "", value)
    return " ".join(value.split())


SAMPLES = [
    None,
    "",
    "   ",
    "Plain Text",
    "<p>Tag <b>soup</b></p> & more",
    "a < b and c > d",
    "see http://x.example/a?b=c now, or www.example.com/x!",
    "www\nline",
    "café naïve über",
    "no break space　here",
    "sep\x1carated\x1dby\x1econtrols\x1f",
    "tabs\tand\r\nlines\x0b\x0c",
    "İstanbul Kelvin",
    "###",
    "it's \"quoted\" - 100% sure?!",
    "line sep www. x",
    "next\u0085line",
]


@pytest.mark.parametrize("i", range(len(SAMPLES)))
def test_clean_text_matches_python(spark, i):
    df = spark.createDataFrame([(SAMPLES[i],)], "t string")
    assert df.select(text.clean_text(F.col("t"))).first()[0] == python_clean(SAMPLES[i])


def test_fallback_description(spark):
    rows = [
        ("keep me", "T", "F", "A"),
        (None, "T", "F", "A"),
        ("   ", "T", None, "A"),
        (None, None, None, "A"),
        (None, None, None, None),
        ("", "T", "", None),
    ]
    df = spark.createDataFrame(rows, "description string, title string, features_text string, author_name string")
    got = [r[0] for r in df.select(text.fallback_description(df)).collect()]
    assert got == ["keep me", "T F by A", "T by A", "by A", "No description available", "T "]


def test_fallback_without_optional_columns(spark):
    df = spark.createDataFrame([(None, "T"), (None, None)], "description string, title string")
    got = [r[0] for r in df.select(text.fallback_description(df)).collect()]
    assert got == ["T", "No description available"]


def test_combined_text(spark):
    rows = [("a", "b"), (None, "b"), ("a", None), (None, None), ("  ", " ")]
    df = spark.createDataFrame(rows, "t string, d string")
    got = [r[0] for r in df.select(text.combined_text(F.col("t"), F.col("d"))).collect()]
    assert got == ["a b", "b", "a", "no_text", "no_text"]


def test_series_titles(spark):
    titles = ["Saga Book 2", "Vol. 3", "Tale #4", "Volume 12 of", "Part 1", "Books 2", "vol 3", None]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    got = [r[0] for r in df.select(text.has_series(F.col("t"))).collect()]
    assert got == [1, 1, 1, 1, 1, 0, 0, 0]


def test_length_counts_code_points(spark):
    df = spark.createDataFrame([("\U0001f600a",), (None,)], "t string")
    assert [r[0] for r in df.select(text.text_length(F.col("t"))).collect()] == [2, 0]
