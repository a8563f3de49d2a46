"""The joint boosted model against a plain NumPy run of the same rules."""

import random

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from shelfwise.plans import boosting, training
from shelfwise.plans.boosting import SoftmaxConfig, train_softmax
from shelfwise.session import scratch_path
from shelfwise.sources.models import load_model, save_model

CONFIG = SoftmaxConfig(n_estimators=4, max_depth=3, learning_rate=0.3, subsample=1.0, feature_fraction=1.0, bins=8, refresh=2)


def rows_of(n, seed=3, classes=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        label = rng.randrange(classes)
        values = {f: rng.choice([1.0, 2.0, -1.5]) + label for f in rng.sample(range(6), 3)}
        values[6 + label] = rng.random() + 0.2
        out.append((i, float(label), rng.choice([1.0, 2.0]), Vectors.sparse(10, values) if i % 3 else Vectors.dense(Vectors.sparse(10, values).toArray())))
    return out


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(rows_of(200), ["id", "label", "w", "features"]).repartition(4).cache()


def by_numpy(rows, edges, config, classes):
    x = np.array([r[3].toArray() for r in rows])
    y, w = np.array([int(r[1]) for r in rows]), np.array([r[2] for r in rows])
    cuts = [edges.get(f, [0.0]) for f in range(x.shape[1])]
    margins, losses = np.zeros((len(x), classes)), []
    for _ in range(config.n_estimators):
        p = boosting.softmax(margins)
        step = np.zeros_like(margins)
        for k in range(classes):
            g, h = w * (p[:, k] - (y == k)), w * p[:, k] * (1 - p[:, k])

            def grow(own, depth):
                total_g, total_h = g[own].sum(), h[own].sum()
                best = None
                if depth < config.max_depth:
                    for f in range(x.shape[1]):
                        for b, cut in enumerate(cuts[f]):
                            left = own[x[own, f] <= cut]
                            lg, lh = g[left].sum(), h[left].sum()
                            if lh < config.min_child_weight or total_h - lh < config.min_child_weight:
                                continue
                            gain = lg**2 / (lh + 1) + (total_g - lg) ** 2 / (total_h - lh + 1) - total_g**2 / (total_h + 1)
                            if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                                best = (gain, f, cut)
                if best is None:
                    step[own, k] = -config.learning_rate * total_g / (total_h + 1)
                else:
                    grow(own[x[own, best[1]] <= best[2]], depth + 1)
                    grow(own[x[own, best[1]] > best[2]], depth + 1)

            grow(np.arange(len(x)), 0)
        margins = margins + step
        p = boosting.softmax(margins)
        losses.append(float((-w * np.log(p[np.arange(len(y)), y])).sum() / w.sum()))
    return boosting.softmax(margins), losses


@pytest.fixture(scope="module")
def model(frame):
    return train_softmax(frame, CONFIG, weight="w")


def test_equals_numpy(frame, model):
    rows = sorted(frame.collect())
    want, losses = by_numpy(rows, model.edges, CONFIG, 3)
    scored = model.with_probabilities(frame, "p").orderBy("id").collect()
    assert np.allclose([r.p for r in scored], want, atol=1e-9)
    assert [h[0] for h in model.history] == pytest.approx(losses)


def test_probabilities_and_loss(frame, model):
    p = np.array([r.p for r in model.with_probabilities(frame, "p").select("p").collect()])
    assert np.allclose(p.sum(1), 1) and (p > 0).all()
    losses = [h[0] for h in model.history]
    assert len(losses) == 4 and all(b < a for a, b in zip(losses, losses[1:]))
    assert sum(model.featureImportances.values) == pytest.approx(1)


def test_sampling_is_repeatable_and_stops_early(frame):
    config = SoftmaxConfig(n_estimators=12, max_depth=2, learning_rate=1.0, bins=8, validation_fraction=0.3, patience=2, refresh=3)
    a, b = (train_softmax(frame, config, key=["id"]) for _ in range(2))
    assert [h[1] for h in a.history] == pytest.approx([h[1] for h in b.history])
    best = int(np.argmin([h[1] for h in a.history])) + 1
    assert len(a.rounds) == best and len(a.history) <= 12
    with pytest.raises(ValueError, match="row key"):
        train_softmax(frame, config)


def test_beside_one_vs_rest(spark, frame):
    config = training.BoostedConfig(n_estimators=3, max_depth=3, objective="softmax")
    model = training.train_boosted(frame, config, balanced=True)
    got = training.predict(model, frame).collect()
    assert sum(r.label == r.prediction for r in got) / len(got) > 0.9
    path = save_model(spark, model, scratch_path(spark, "joint"), n_classes=3)
    loaded, metadata = load_model(spark, path)
    assert metadata["model_name"] == "SoftmaxModel"
    assert training.predict(loaded, frame).collect() == got
    assert training.importance_frame(spark, loaded, [f"f{i}" for i in range(10)]).agg(F.sum("importance")).first()[0] == pytest.approx(1)
    with pytest.raises(ValueError, match="objective"):
        training.BoostedConfig(objective="other")


def test_a_task_sends_one_record_for_each_node(spark, frame):
    """Sums are added up over all rows of a task, not sent for every Arrow batch."""
    bins = boosting.Bins(boosting.bin_edges(frame, "features", 8), 10)
    columns = "cast(label as int) label", "w as weight", "0 as slice", "id as row", "array(0) as idx", "array(0) as bins", "array(0D, 0D, 0D) as margins"
    table = frame.coalesce(1).selectExpr(*columns)
    fit = boosting._Fit(CONFIG, table, 3, bins)
    batch = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        sent = fit.sums(0, 0, [boosting.Tree.empty(3) for _ in range(3)], [(k, 0) for k in range(3)], True).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    assert len(bins.blocks) == 1 and len(sent) == 3 + 2
    assert all(len(r.sums) == 2 * 8 * bins.start[-1] for r in sent if r.tree >= 0)


def test_levels_too_large_for_a_task_take_several_jobs(frame, model, monkeypatch):
    monkeypatch.setattr(boosting, "HELD", 1)
    monkeypatch.setattr(boosting, "BLOCK", 16)
    again = train_softmax(frame, CONFIG, weight="w")
    assert [h[0] for h in again.history] == pytest.approx([h[0] for h in model.history])
    assert again.gains == pytest.approx(model.gains)
