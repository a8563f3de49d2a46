import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfwise.operators import quantiles
from shelfwise.operators.quantiles import exact_quantiles, quantiles_from_counts
from shelfwise.session import cut_lineage

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}


def check(spark, groups, large):
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    got = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", PROBS, large=large).collect()}
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-12, abs=1e-12), (g, name)


def test_small_groups(spark):
    check(spark, {str(n): list(range(n)) for n in range(1, 12)}, 10_000)


def test_bracketed_groups(spark):
    rng = np.random.default_rng(7)
    groups = {
        "uniform": rng.random(6000),
        "skewed": rng.exponential(size=6000) ** 4,
        "ties": rng.integers(0, 5, 6000),
        "one value": [3.5] * 5000,
        "hot": np.concatenate([[1.0] * 4000, rng.random(2000) * 9]),
        "sorted": np.arange(9001),
    }
    check(spark, groups, 100)


def test_no_task_orders_more_than_the_limit(spark, monkeypatch):
    """Skewed doubles: every range that is ordered in one task has at most the stated rows."""
    rng = np.random.default_rng(9)
    values = np.concatenate([np.exp(rng.normal(0, 40, 30_000)), [7.0] * 20_000, -np.exp(rng.normal(0, 90, 10_000))])
    seen = []
    monkeypatch.setattr(quantiles, "cut_lineage", lambda df, name: seen.append((name, cut_lineage(df, name))) or seen[-1][1])
    df = spark.createDataFrame([("a", float(v)) for v in values] + [("b", 1.0)], "g string, v double").repartition(5)
    got = exact_quantiles(df, ["g"], "v", PROBS, large=100).where("g = 'a'").first()
    assert [got[n] for n in PROBS] == pytest.approx(np.quantile(values, list(PROBS.values())), rel=1e-12)
    last = [frame for name, frame in seen if name == "ranges"][-1]
    assert last.where("_lo < _hi").agg(F.max("_n")).first()[0] <= 100
    assert len(seen) <= 8


def test_missing_values_are_left_out(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = exact_quantiles(df, ["g"], "v", {"m": 0.5}).collect()
    assert [tuple(r) for r in got] == [("a", 2.0)]


def test_whole_numbers(spark):
    df = spark.range(100_001).select(F.lit("x").alias("g"), "id")
    assert exact_quantiles(df, ["g"], "id", {"m": 0.5, "q": 0.999}).first()[1:] == (50_000.0, 99_900.0)


def test_quantiles_from_counts(spark):
    rng = np.random.default_rng(3)
    groups = {"a": rng.integers(0, 40, 999), "b": rng.integers(5, 9, 2), "c": np.array([7])}
    rows = [(g, int(v)) for g, vs in groups.items() for v in vs] + [("a", None)]
    counts = spark.createDataFrame(rows, "g string, v int").groupBy("g", "v").count()
    got = {r["g"]: r for r in quantiles_from_counts(counts, ["g"], "v", "count", PROBS).collect()}
    for g, vs in groups.items():
        for name, p in PROBS.items():
            assert got[g][name] == pytest.approx(np.quantile(vs, p), rel=1e-12), (g, name)
