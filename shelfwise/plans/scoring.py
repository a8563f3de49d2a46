"""Scoring of new records, one or many, with the preprocessing of training."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfwise import schemas as S
from shelfwise.functions.text import clean_text_columns, has_series
from shelfwise.operators.ranking import top_k
from shelfwise.plans.features import FittedFeatures
from shelfwise.plans.training import with_probabilities
from shelfwise.sources.models import load_model

# Request names and the model inputs they feed.
REQUEST_INPUTS = {
    "price": "price_numeric",
    "rating": "average_rating",
    "rating_count": "review_count",
    "book_format": "format",
}


@dataclass
class Classifier:
    """Fitted features and model; ``defaults`` fill inputs a request lacks."""

    features: FittedFeatures
    model: object
    defaults: dict[str, float] = field(default_factory=dict)

    @classmethod
    def load(cls, spark: SparkSession, model_path: str, features_path: str) -> Classifier:
        """Load both saved parts."""
        model, _ = load_model(spark, model_path)
        return cls(FittedFeatures.load(spark, features_path), model)

    def request_frame(self, requests: DataFrame) -> DataFrame:
        """Requests as model inputs: renamed, series flag taken, text cleaned.

        Inputs a request cannot know get the training median unless
        ``defaults`` says otherwise.
        """
        frame = requests.withColumnsRenamed({k: v for k, v in REQUEST_INPUTS.items() if k in requests.columns})
        if "has_series" not in frame.columns:
            frame = frame.withColumn("has_series", has_series(F.col("title")))
        frame = clean_text_columns(frame, S.TEXT_COLUMNS)
        fill = {**self.features.medians, **self.defaults}
        absent = [c for c in self.features.names["numerical"] if c not in frame.columns]
        return frame.withColumns({c: F.lit(float(fill.get(c, 0.0))) for c in absent})

    def score(self, requests: DataFrame, k: int = 3) -> DataFrame:
        """Adds predicted_class, confidence and the top k classes.

        Map-only: one pass over the requests, batch or streaming.
        """
        featured = self.features.transform_inference(self.request_frame(requests))
        scored = with_probabilities(self.model, featured, "_probabilities")
        names = F.array(*[F.lit(c) for c in self.features.class_names])
        winner = F.col("prediction").cast("int")
        return (
            scored.withColumn("predicted_class", F.get(names, winner))
            .withColumn("confidence", F.get("_probabilities", winner))
            .withColumn("top_3", top_k(F.col("_probabilities"), names, k))
            .drop("features", "_probabilities", "prediction")
        )

    def predict(
        self,
        spark: SparkSession,
        title: str,
        description: str,
        price: float,
        rating: float,
        rating_count: int,
        book_format: str,
    ) -> dict:
        """Score one record.

        The record enters as literals, so no input job is needed.
        """
        values = dict(zip(S.REQUEST_SCHEMA.names, (title, description, price, rating, rating_count, book_format)))
        columns = ", ".join(
            f"CAST(:{f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in S.REQUEST_SCHEMA.fields
        )
        request = spark.sql(f"SELECT {columns}", args=values)
        row = self.score(request).select("predicted_class", "confidence", "top_3").first()
        return row.asDict(recursive=True)
