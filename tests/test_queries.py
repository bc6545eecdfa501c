"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from checks import oracle, queries
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_but_the_trained_model_has_sql():
    assert set(queries.QUERIES) - set(SQL) == {"ml_predictions"}
    assert set(SQL) <= set(queries.QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, con, name):
    fn = queries.QUERIES[name]
    if name not in SQL:
        assert fn(spark, SF).count() > 0
        return
    df = fn(spark, SF)
    problem, n = compare(con, spark, SF, lambda *_: df, SQL[name])
    assert not problem, problem
    assert n > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython"):
        assert node not in plan


def test_entry(spark):
    assert entry.entry(spark).columns == ["day", "intent", "precision", "recall"]


def test_ablation_does_the_text_work_once(spark):
    """The two scorings are read from stored scores; no side cleans or scores texts again."""
    plan = queries.ablation_delta(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan and "md5" not in plan


@pytest.mark.parametrize("name", ["ablate_placeholders", "conflict_keys"])
def test_queries_without_slots_make_none(spark, name):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "map_from_entries" not in plan
