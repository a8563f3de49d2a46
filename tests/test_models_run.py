"""Queries without a SQL twin, on the smallest tables: they run, and what must hold of a model holds."""

import pytest

from shelfwise.queries import QUERIES, SQL

UNCHECKED = sorted(set(QUERIES) - set(SQL))


@pytest.fixture(scope="module")
def rows(spark, sf_dir):
    return {name: QUERIES[name](spark, sf_dir).collect() for name in UNCHECKED}


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_gives_rows(rows, name):
    assert rows[name]


def test_scores_of_batch_and_stream_agree(rows):
    assert sorted(rows["score_batch"]) == sorted(rows["score_stream_files"])
    for r in rows["score_batch"]:
        top = [p.rsplit(":", 1) for p in r.top_3.split(",")]
        assert top[0][0] == r.predicted_class and float(top[0][1]) == pytest.approx(r.confidence, abs=1e-6)
        assert sum(float(p) for _, p in top) <= 1 + 1e-5


def test_losses_fall_and_importances_sum_to_one_at_most(rows):
    losses = [r.loss for r in sorted(rows["joint_boosted_losses"])]
    assert all(b < a for a, b in zip(losses, losses[1:]))
    assert 0 < sum(r.importance for r in rows["feature_importance"]) <= 1 + 1e-6
    assert len(rows["cross_validate"]) == 3
