"""From two raw tables to a saved, evaluated classifier."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from shelfwise.operators.aggregates import rating_by_category
from shelfwise.operators.evaluation import (
    classification_report,
    confusion_matrix,
    overall_metrics,
)
from shelfwise.operators.joins import join_counts, join_reviews
from shelfwise.operators.profile import summary_sections, validate_schema
from shelfwise.operators.weights import imbalance_report, recommendations
from shelfwise.plans import prepare as P
from shelfwise.plans import selection, training
from shelfwise.plans.config import PrepareConfig, SplitConfig
from shelfwise.plans.features import FeatureConfig, fit_features, load_features, save_features_and_metadata
from shelfwise.session import cut_lineage
from shelfwise.sources import sinks, tables
from shelfwise.sources.models import save_metadata, save_model


@dataclass(frozen=True)
class WorkflowConfig:
    """Settings of every step; the defaults are those of a full run."""

    prepare: PrepareConfig = PrepareConfig(
        min_samples_per_category=100, sampling_fraction=0.5, min_reviews_per_book=5
    )
    split: SplitConfig = SplitConfig()
    features: FeatureConfig = FeatureConfig(max_features=8000, ngram_range=(1, 3))
    boosted: training.BoostedConfig = training.BoostedConfig(n_estimators=200, max_depth=8)
    logistic: training.LogisticConfig = training.LogisticConfig()
    min_reviews_in_join: int = 5
    folds: int = 2
    aggressive: bool = False
    models: tuple[str, ...] = field(default=("boosted", "logistic"))


def run_workflow(
    spark: SparkSession, catalogue_path: str, reviews_path: str, output: str, config: WorkflowConfig = WorkflowConfig()
) -> dict:
    """Profile, prepare, split, fit, train, evaluate, choose and save.

    Everything lands under ``output``; the answer names the best model and the
    folders that ``Classifier.load`` needs.
    """
    target, key, label = config.prepare.target, config.prepare.key, config.features.label
    catalogue, reviews = tables.read_catalogue(spark, catalogue_path), tables.read_reviews(spark, reviews_path)
    schema = validate_schema(catalogue, reviews)
    if not all(report["has_required_columns"] for report in schema.values()):
        raise ValueError(f"required columns are missing: {schema}")
    save_metadata(spark, schema, f"{output}/schema")
    sinks.write_summary_report(summary_sections(spark, catalogue, reviews), f"{output}/profile")
    joined = join_reviews(catalogue, reviews, "inner", config.min_reviews_in_join, key)
    sinks.write_json(join_counts(joined, key), f"{output}/join")
    sinks.write_json(rating_by_category(catalogue, reviews, target, key), f"{output}/ratings")

    stages = P.prepare(catalogue, reviews, config.prepare)
    sampled = f"{output}/sampled.parquet"
    P.save_prepared(stages.sampled, sampled, weights=stages.weights, weights_path=f"{output}/class_weights")
    parts = P.run_split(spark, sampled, f"{output}/split", config.split)
    sinks.write_json(imbalance_report(parts["train"], target), f"{output}/imbalance")
    sinks.write_json(recommendations(parts["train"], target), f"{output}/recommendations")

    fitted = fit_features(parts["train"], config.features)
    split = spark.read.parquet(parts["paths"]["splits"])
    paths = save_features_and_metadata(split, fitted, f"{output}/features", f"{output}/extractor", [key])
    featured = load_features(spark, paths["features"])
    train, test = featured.where("split = 'train'"), featured.where("split = 'test'")
    weights = training.aggressive_class_weights(train, label) if config.aggressive else None

    trainers = {
        "boosted": lambda rows, w, balanced: training.train_boosted(rows, config.boosted, w, label, [key], balanced),
        "logistic": lambda rows, w, balanced: training.train_logistic(rows, config.logistic, w, label, balanced),
    }
    metrics, models = {}, {}
    for name in config.models:
        fit = trainers[name]
        models[name] = fit(train, weights, True)
        predictions = cut_lineage(training.predict(models[name], test, label), "predictions")
        metrics[name] = overall_metrics(predictions)
        # Fold models are unweighted.
        cv = selection.cross_validate(
            train, lambda rows, fit=fit: fit(rows, None, False), [key], config.folds, label=label
        )
        folder = f"{output}/models/{name}"
        sinks.write_json(selection.evaluation_record(predictions, fitted.class_names, cv), f"{folder}/metrics")
        sinks.write_json(confusion_matrix(predictions), f"{folder}/confusion")
        sinks.write_classification_report(classification_report(predictions), f"{folder}/report", name)
        if name == "logistic":
            top = training.coefficient_importance(spark, models[name], fitted.feature_names, fitted.class_names)
        else:
            top = training.feature_importance(spark, models[name], fitted.feature_names)
        sinks.write_json(top, f"{folder}/top_features")
        save_model(
            spark, models[name], folder, n_features=len(fitted.feature_names),
            n_classes=len(fitted.class_names), class_names=fitted.class_names,
        )
    _, best = selection.choose_model(metrics, f"{output}/comparison", f"{output}/best")
    return {"best": best, "model": f"{output}/models/{best}", "extractor": f"{output}/extractor"}
