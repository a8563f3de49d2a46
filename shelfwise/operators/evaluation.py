"""Classification metrics from one confusion count per (label, prediction)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window as W, functions as F


def confusion_counts(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction) pair."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts with their share of the true label, in long form."""
    counts = confusion_counts(df, label, prediction)
    return counts.withColumn("share", F.col("n") / F.sum("n").over(W.partitionBy("label")))


def _ratio(top, bottom):
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def per_class_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where undefined."""
    counts = confusion_counts(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("s"), none.alias("p"), hit.alias("t")),
                F.struct(F.col("prediction").alias("class"), none.alias("s"), F.col("n").alias("p"), none.alias("t")),
            )
        ).alias("_r")
    ).select("_r.*")
    totals = sides.groupBy("class").agg(
        F.sum("s").alias("support"), F.sum("p").alias("predicted"), F.sum("t").alias("hits")
    )
    return totals.select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(F.col("hits") * 2, F.col("support") + F.col("predicted")).alias("f1_score"),
        "support",
        "hits",
    )


def overall_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and the weighted and macro averages, as one row."""
    classes = per_class_metrics(df, label, prediction)
    total = F.sum("support")
    averages = []
    for out, c in (("precision", "precision"), ("recall", "recall"), ("f1", "f1_score")):
        averages += [
            (F.sum(F.col(c) * F.col("support")) / total).alias(f"{out}_weighted"),
            F.avg(c).alias(f"{out}_macro"),
        ]
    return classes.agg(
        (F.sum("hits") / total).alias("accuracy"), *averages, total.alias("support")
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction", digits: int = 4
) -> DataFrame:
    """Per-class rows followed by accuracy, macro and weighted averages."""
    overall = overall_metrics(df, label, prediction)
    none = F.lit(None).cast("double")
    rows = [
        per_class_metrics(df, label, prediction).select(
            F.col("class").cast("string").alias("class"), "precision", "recall", "f1_score", "support"
        ),
        overall.select(
            F.lit("accuracy").alias("class"),
            none.alias("precision"),
            none.alias("recall"),
            F.col("accuracy").alias("f1_score"),
            "support",
        ),
    ]
    for kind in ("macro", "weighted"):
        rows.append(
            overall.select(
                F.lit(f"{kind} avg").alias("class"),
                F.col(f"precision_{kind}").alias("precision"),
                F.col(f"recall_{kind}").alias("recall"),
                F.col(f"f1_{kind}").alias("f1_score"),
                "support",
            )
        )
    numbers = ("precision", "recall", "f1_score")
    return reduce(DataFrame.unionByName, rows).select(
        "class", *[F.round(c, digits).alias(c) for c in numbers], "support"
    )


def compare_models(metrics: dict[str, DataFrame]) -> DataFrame:
    """One row of overall metrics per model, best weighted F1 first."""
    rows = [df.withColumn("model", F.lit(name)) for name, df in metrics.items()]
    return reduce(DataFrame.unionByName, rows).orderBy(F.desc("f1_weighted"), "model")


def best_model(comparison: DataFrame) -> DataFrame:
    """The model with the highest weighted F1; the first name on ties."""
    return comparison.orderBy(F.desc("f1_weighted"), "model").limit(1)


def fold_summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Mean, population deviation and extremes of the fold scores."""
    return scores.agg(
        F.count(F.lit(1)).alias("folds"),
        F.avg(score).alias("mean"),
        F.stddev_pop(score).alias("std"),
        F.min(score).alias("min"),
        F.max(score).alias("max"),
    )
