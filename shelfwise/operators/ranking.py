"""Top-k of score arrays, feature importances and class coefficients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, not once per element."""
    return F.get(F.transform(F.array(value), body), 0)


def top_k(scores: Column, labels: Column, k: int = 3) -> Column:
    """The k best (class, probability) pairs of a row; the higher index wins ties.

    Works inside the row: no shuffle, and the array is as long as the classes.
    """
    named = F.zip_with(scores, labels, lambda s, c: F.struct(s.alias("probability"), c.alias("class")))
    pairs = F.transform(
        named, lambda p, i: F.struct(p["probability"].alias("probability"), i.alias("i"), p["class"].alias("class"))
    )
    best = F.slice(F.sort_array(pairs, asc=False), 1, k)
    return F.transform(best, lambda p: F.struct(p["class"].alias("class"), p["probability"].alias("probability")))


def softmax(scores: Column) -> Column:
    """Exponentials scaled to a sum of 1, shifted by the maximum."""
    return _let(
        F.array_max(scores),
        lambda top: _let(
            F.transform(scores, lambda s: F.exp(s - top)),
            lambda powers: _let(
                F.aggregate(powers, F.lit(0.0), lambda a, x: a + x),
                lambda total: F.transform(powers, lambda x: x / total),
            ),
        ),
    )


def top_features(importances: DataFrame, n: int = 20) -> DataFrame:
    """The n most important features."""
    return importances.orderBy(F.desc("importance"), "feature").limit(n)


def top_coefficients(coefficients: DataFrame, n: int = 20) -> DataFrame:
    """The n lowest and the n highest coefficients of every class."""
    parts = []
    for side, order in (("negative", F.asc("coefficient")), ("positive", F.desc("coefficient"))):
        rank = F.row_number().over(W.partitionBy("class").orderBy(order, "feature"))
        parts.append(coefficients.withColumn("rank", rank).where(F.col("rank") <= n).withColumn("side", F.lit(side)))
    return parts[0].unionByName(parts[1])
