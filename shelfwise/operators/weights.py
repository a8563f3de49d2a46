"""Class weights and the class-imbalance report (all class-level tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from shelfwise import schemas as S
from shelfwise.functions.numeric import round_half_even
from shelfwise.operators.sampling import class_sizes
from shelfwise.session import small_side

# Exponent of the aggressive weights, report thresholds.
AGGRESSIVE_EXPONENT = 1.2
SMALL_SHARE, DOMINANT_SHARE = 0.01, 0.10
SEVERE_RATIO, HIGH_RATIO, MODERATE_RATIO = 50, 20, 10
CRITICAL_ROWS = 20


def class_weights(df: DataFrame, by: str = S.TARGET, strategy: str = "class_weight") -> DataFrame:
    """Balanced weights ``n / (k * n_c)``; strategy ``none`` gives no rows."""
    sizes = class_sizes(df, by)
    if strategy == "none":
        return sizes.where(F.lit(False)).withColumn("weight", F.lit(None).cast("double"))
    totals = sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    total, classes = totals.select("rows").scalar(), totals.select("classes").scalar()
    return sizes.withColumn("weight", total / (classes * F.col("n")))


def minority_classes(df: DataFrame, by: str = S.TARGET, n: int = 5) -> DataFrame:
    """The ``n`` classes with the highest balanced weight."""
    return class_weights(df, by).orderBy(F.desc("weight"), by).limit(n)


def aggressive_weights(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Balanced weights raised to 1.2 and scaled to a mean of 1."""
    raised = class_weights(df, by).withColumn("_w", F.pow("weight", F.lit(AGGRESSIVE_EXPONENT)))
    mean = raised.agg(F.avg("_w")).scalar()
    return raised.select(by, "n", (F.col("_w") / mean).alias("weight"))


def weight_extremes(weights: DataFrame, by: str = S.TARGET, n: int = 10) -> DataFrame:
    """The ``n`` highest and the ``n`` lowest weights."""
    highest = weights.orderBy(F.desc("weight"), by).limit(n).withColumn("end", F.lit("highest"))
    lowest = weights.orderBy(F.asc("weight"), by).limit(n).withColumn("end", F.lit("lowest"))
    return highest.unionByName(lowest)


def imbalance_report(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Rows, share and size band of every class, largest first."""
    sizes = class_sizes(df, by)
    total = sizes.agg(F.sum("n")).scalar()
    band = (
        F.when(F.col("n") < total * SMALL_SHARE, "small")
        .when(F.col("n") > total * DOMINANT_SHARE, "dominant")
        .otherwise("normal")
    )
    return sizes.select(
        by,
        F.col("n").alias("samples"),
        round_half_even(F.col("n") / total * 100, 2).alias("percentage"),
        band.alias("band"),
    ).orderBy(F.desc("samples"), by)


def class_spread(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Mean, median, population deviation and ratio of the class sizes."""
    sizes = class_sizes(df, by)
    ratio = F.col("max_samples") / F.col("min_samples")
    return (
        sizes.agg(
            F.sum("n").alias("total_samples"),
            F.count(F.lit(1)).alias("n_classes"),
            F.avg("n").alias("mean_samples"),
            F.median("n").alias("median_samples"),
            F.stddev_pop("n").alias("std_samples"),
            F.min("n").alias("min_samples"),
            F.max("n").alias("max_samples"),
        )
        .withColumn("imbalance_ratio", ratio)
        .withColumn(
            "severity",
            F.when(F.col("imbalance_ratio") > SEVERE_RATIO, "severe")
            .when(F.col("imbalance_ratio") > HIGH_RATIO, "high")
            .when(F.col("imbalance_ratio") > MODERATE_RATIO, "moderate")
            .otherwise("acceptable"),
        )
    )


def recommendations(df: DataFrame, by: str = S.TARGET) -> DataFrame:
    """One row per advised action of every small or dominant class."""
    report = imbalance_report(df, by)
    small, critical = F.col("band") == "small", F.col("samples") < CRITICAL_ROWS
    actions = (
        F.when(small & critical, F.array(*map(F.lit, ["remove class", "merge with similar class", "get more data"])))
        .when(small, F.array(*map(F.lit, ["use aggressive class weights", "apply oversampling"])))
        .when(F.col("band") == "dominant", F.array(*map(F.lit, ["undersample to 10 % of rows", "use class weights"])))
        .otherwise(F.array().cast("array<string>"))
    )
    level = (
        F.when(small & critical, "critical").when(small, "few samples").otherwise("dominant")
    )
    return report.where(F.col("band") != "normal").select(
        by, "samples", "percentage", level.alias("finding"), F.explode(actions).alias("action")
    )


def missing_from_weights(df: DataFrame, weights: DataFrame, by: str = S.TARGET) -> DataFrame:
    """Classes of the data that the weight table lacks."""
    return class_sizes(df, by).select(by).join(weights.select(by), by, "left_anti")


def sample_weights(df: DataFrame, weights: DataFrame, by: str = S.TARGET, column: str = "sample_weight") -> DataFrame:
    """Adds the weight of each row's class, joined by class name; 1 without one."""
    small = small_side(weights.select(by, F.col("weight").alias(column)))
    return df.join(small, by, "left").fillna(1.0, [column])


def resolve_weights(df: DataFrame, weights: DataFrame | None, by: str = S.TARGET) -> DataFrame:
    """The given weights if they cover every class, else balanced ones."""
    if weights is None or missing_from_weights(df, weights, by).limit(1).count():
        return class_weights(df, by)
    return weights
