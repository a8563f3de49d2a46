import random
from collections import Counter

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from shelfwise.operators import evaluation, ranking


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(4)
    # Class 3 is only ever predicted, class 4 never predicted.
    rows = [(float(rng.choice([0, 0, 0, 1, 2, 4])), float(rng.choice([0, 0, 1, 2, 3]))) for _ in range(500)]
    return rows, spark.createDataFrame(rows, "label double, prediction double")


def test_overall_metrics_match_spark_ml(pairs):
    _, df = pairs
    got = evaluation.overall_metrics(df).first()
    ml = lambda name: MulticlassClassificationEvaluator(metricName=name).evaluate(df)
    assert got["accuracy"] == pytest.approx(ml("accuracy"))
    assert got["f1_weighted"] == pytest.approx(ml("f1"))
    assert got["precision_weighted"] == pytest.approx(ml("weightedPrecision"))
    assert got["recall_weighted"] == pytest.approx(ml("weightedRecall"))


def test_undefined_scores_are_zero_and_macro_counts_every_class(pairs):
    rows, df = pairs
    got = {r["class"]: r for r in evaluation.per_class_metrics(df).collect()}
    assert set(got) == {0.0, 1.0, 2.0, 3.0, 4.0}
    assert got[3.0]["recall"] == got[3.0]["f1_score"] == 0 and got[3.0]["support"] == 0
    assert got[4.0]["precision"] == 0
    overall = evaluation.overall_metrics(df).first()
    assert overall["f1_macro"] == pytest.approx(sum(r["f1_score"] for r in got.values()) / 5)
    assert overall["support"] == len(rows)


def test_confusion_rows_sum_to_one(pairs):
    rows, df = pairs
    matrix = evaluation.confusion_matrix(df).collect()
    assert {(r.label, r.prediction): r.n for r in matrix} == Counter(rows)
    shares = Counter()
    for r in matrix:
        shares[r.label] += r.share
    assert all(v == pytest.approx(1) for v in shares.values())


def test_report_layout(pairs):
    _, df = pairs
    names = [r["class"] for r in evaluation.classification_report(df).collect()]
    assert len(names) == 8 and {"accuracy", "macro avg", "weighted avg"} < set(names)


def test_best_model(pairs):
    _, df = pairs
    perfect = df.select("label", F.col("label").alias("prediction"))
    table = evaluation.compare_models({"a": evaluation.overall_metrics(df), "b": evaluation.overall_metrics(perfect)})
    assert evaluation.best_model(table).first()["model"] == "b"


def test_top_k_orders_by_score_then_higher_index(spark):
    df = spark.createDataFrame([([0.2, 0.5, 0.2, 0.1],)], "s array<double>")
    labels = F.array(*[F.lit(c) for c in "abcd"])
    got = df.select(ranking.top_k(F.col("s"), labels, 3).alias("t")).first().t
    assert [(p["class"], p["probability"]) for p in got] == [("b", 0.5), ("c", 0.2), ("a", 0.2)]


def test_softmax_is_stable(spark):
    df = spark.createDataFrame([([1000.0, 1000.0, -1000.0],)], "s array<double>")
    assert df.select(ranking.softmax(F.col("s")).alias("p")).first().p == pytest.approx([0.5, 0.5, 0.0])


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([(0, 1.0), (1, 3.0)], "fold int, score double")
    assert evaluation.fold_summary(df).first()[:] == (2, 2.0, 1.0, 1.0, 3.0)
