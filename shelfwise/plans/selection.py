"""Cross-validation, evaluation records and model choice."""

from __future__ import annotations

from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, functions as F

from shelfwise.operators.evaluation import (
    best_model,
    compare_models,
    fold_summary,
    overall_metrics,
    per_class_metrics,
)
from shelfwise.operators.sampling import stratified_folds
from shelfwise.plans.training import predict
from shelfwise.session import cut_lineage
from shelfwise.sources.sinks import write_json, write_model_comparison

Trainer = Callable[[DataFrame], object]


def cross_validate(
    featured: DataFrame,
    train: Trainer,
    key: list[str],
    folds: int = 5,
    scoring: str = "f1_weighted",
    label: str = "label",
    seed: int = 42,
    parallelism: int = 2,
) -> DataFrame:
    """The score of each stratified fold, as (fold, score) rows.

    ``featured`` should be a stored frame. Fold numbers are added map-only;
    folds train at the same time, up to ``parallelism``, and only their score
    reaches the driver.
    """
    assigned = stratified_folds(featured.select("features", label, *key), label, folds, key, seed)

    def score(fold: int) -> tuple[int, float]:
        model = train(assigned.where(F.col("fold") != fold))
        held_out = predict(model, assigned.where(F.col("fold") == fold), label)
        return fold, overall_metrics(held_out).first()[scoring]

    with ThreadPool(parallelism) as pool:
        rows = pool.map(score, range(folds))
    return featured.sparkSession.createDataFrame(rows, "fold int, score double")


def evaluation_record(predictions: DataFrame, class_names: list[str], cv: DataFrame | None = None) -> DataFrame:
    """Overall, per-class and cross-validated metrics as one nested row.

    Class names join on the label id, so an absent class shifts nothing.
    """
    names = F.array(*[F.lit(n) for n in class_names])
    per_class = per_class_metrics(predictions).agg(
        F.map_from_entries(
            F.collect_list(
                F.struct(
                    F.get(names, F.col("class").cast("int")).alias("key"),
                    F.struct("precision", "recall", "f1_score").alias("value"),
                )
            )
        ).alias("per_class")
    )
    record = overall_metrics(predictions).select("*", per_class.scalar().alias("per_class"))
    if cv is not None:
        summary = fold_summary(cv).select(F.struct("mean", "std", "min", "max").alias("cv"))
        record = record.select("*", summary.scalar().alias("cv_results"))
    return record


def choose_model(
    metrics: dict[str, DataFrame], comparison_path: str | None = None, best_path: str | None = None
) -> tuple[DataFrame, str]:
    """Compare models by overall metrics; the name of the best comes back."""
    comparison = cut_lineage(compare_models(metrics), "comparison")
    if comparison_path:
        write_model_comparison(comparison, comparison_path)
    best = best_model(comparison)
    if best_path:
        write_json(best, best_path)
    return comparison, best.first()["model"]
