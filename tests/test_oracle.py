"""Every registered query against its SQL twin, and the shape of its plan."""

import contextlib
import io

import oracle
import pytest

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


def plan_of(df):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue()


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sf_dir, con, name):
    df = entry.queries()[name](spark, sf_dir)
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    assert oracle.difference(df, con, entry.oracle_sql()[name]) is None


def test_entry_returns_rows(spark):
    assert entry.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
