"""Term weighting as relational operators, checked against SQL.

Terms are words of two or more characters; phrases are built after stop words
are removed; terms outside the document-frequency limits are dropped and the
most frequent ``max_features`` kept (ties by term); columns are alphabetical.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from shelfwise.session import SMALL_TABLE_ROWS

TOKEN_PATTERN = r"(?U)\b\w\w+\b"


@dataclass(frozen=True)
class TermConfig:
    """Vocabulary limits: size, phrase lengths, document frequencies."""

    max_features: int
    ngram_range: tuple[int, int] = (1, 1)
    min_df: int = 2
    max_df: float = 0.95
    stop_words: tuple[str, ...] = field(default=())

    def __post_init__(self):
        low, high = self.ngram_range
        if self.max_features < 1 or not 1 <= low <= high:
            raise ValueError("max_features and ngram_range must be positive and ordered")


def words(text: Column, stop_words: tuple[str, ...] = ()) -> Column:
    """Lower-case words of two or more characters without stop words."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))
    if not stop_words:
        return found
    return F.filter(found, lambda w: ~w.isin(sorted(set(stop_words))))


def phrases(tokens: Column, ngram_range: tuple[int, int]) -> Column:
    """All runs of ``low`` to ``high`` neighbouring words, joined by blanks.

    ``tokens`` should be a stored column: it is looked up once per position.
    """
    low, high = ngram_range

    def run(n: int) -> Column:
        if n == 1:
            return tokens
        # A sequence up to -1 would count down, hence the guard.
        starts = F.when(
            F.size(tokens) >= n, F.sequence(F.lit(0), F.size(tokens) - n)
        ).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + j) for j in range(n)]))

    runs = [run(n) for n in range(low, high + 1)]
    return runs[0] if len(runs) == 1 else F.concat(*runs)


def with_terms(df: DataFrame, text: str, config: TermConfig, column: str = "_terms") -> DataFrame:
    """Adds the array of words and phrases of a text column."""
    return (
        df.withColumn("_words", words(F.col(text), config.stop_words))
        .withColumn(column, phrases(F.col("_words"), config.ngram_range))
        .drop("_words")
    )


def vocabulary(df: DataFrame, terms: str, config: TermConfig) -> DataFrame:
    """Kept terms with corpus and document frequency and smoothed idf.

    One scan and one shuffle: every term occurrence counts once, and every
    distinct term of a row once more, both summed map-side.
    """
    both = F.concat(
        F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(1).alias("tf"), F.lit(0).alias("df"))),
        F.transform(
            F.array_distinct(F.col(terms)),
            lambda t: F.struct(t.alias("term"), F.lit(0).alias("tf"), F.lit(1).alias("df")),
        ),
    )
    rows = df.agg(F.count(F.lit(1))).scalar()
    counted = (
        df.select(F.explode_outer(both).alias("_t"))
        .select("_t.*")
        .where(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))
    )
    return (
        counted.where((F.col("df") >= config.min_df) & (F.col("df") <= rows * config.max_df))
        .orderBy(F.desc("tf"), "term")
        .limit(config.max_features)
        .withColumn("idf", F.log((1 + rows) / (1 + F.col("df"))) + 1)
    )


def tfidf_weights(df: DataFrame, doc: str, text: str, config: TermConfig) -> DataFrame:
    """(document, term, weight) rows with unit length per document.

    The vocabulary has at most ``max_features`` rows, so it is broadcast when
    that bound is small; hot terms then never shuffle. The texts shuffle once
    by document, which serves both the term counts and the norms.
    """
    vocab = vocabulary(with_terms(df, text, config), "_terms", config).select("term", "idf")
    if config.max_features <= SMALL_TABLE_ROWS:
        vocab = F.broadcast(vocab)
    counted = (
        with_terms(df.select(doc, text).repartition(doc), text, config)
        # The outer form keeps Spark from adding a filter on the array's size,
        # which would compute the whole array a second time.
        .select(doc, F.explode_outer("_terms").alias("term"))
        .join(vocab, "term")
        .groupBy(doc, "term")
        .agg(F.count(F.lit(1)).alias("tf"), F.first("idf").alias("idf"))
        .withColumn("_raw", F.col("tf") * F.col("idf"))
    )
    norm = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(W.partitionBy(doc)))
    return counted.select(doc, "term", "tf", (F.col("_raw") / norm).alias("weight"))
