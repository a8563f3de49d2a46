"""Saving and loading fitted stages with their metadata."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.ml.util import DefaultParamsReader, MLWritable
from pyspark.sql import SparkSession


def save_metadata(spark: SparkSession, metadata: dict, path: str) -> None:
    """Write one JSON document through Spark, so any shared storage works."""
    spark.createDataFrame([(json.dumps(metadata),)], "value string").coalesce(1).write.mode(
        "overwrite"
    ).text(path)


def load_metadata(spark: SparkSession, path: str) -> dict:
    """Read the JSON document back."""
    try:
        return json.loads(spark.read.text(path, wholetext=True).first().value)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no saved model at {path}") from error
        raise


def default_model_path(root: str, name: str) -> str:
    """``root/name_YYYYmmdd_HHMMSS``."""
    return f"{root.rstrip('/')}/{name.lower()}_{datetime.now(timezone.utc):%Y%m%d_%H%M%S}"


def save_model(spark: SparkSession, model, path: str, **metadata) -> str:
    """Save a fitted model with its name, sizes, class names and time."""
    if isinstance(model, MLWritable):
        model.write().overwrite().save(f"{path}/model")
    else:
        model.save(spark, f"{path}/model")
    described = {
        "model_name": type(model).__name__,
        "timestamp": datetime.now(timezone.utc).isoformat(),
        **metadata,
    }
    save_metadata(spark, described, f"{path}/metadata")
    return path


def load_model(spark: SparkSession, path: str):
    """Load a saved model of any kind, with its metadata."""
    metadata = load_metadata(spark, f"{path}/metadata")
    if metadata["model_name"] == "SoftmaxModel":
        from shelfwise.plans.boosting import SoftmaxModel

        return SoftmaxModel.load(spark, f"{path}/model"), metadata
    model = DefaultParamsReader.loadParamsInstance(f"{path}/model", spark)
    return model, metadata
