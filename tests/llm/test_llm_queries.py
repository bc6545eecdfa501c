"""The registered queries of the operators on the smallest tables."""

from __future__ import annotations

import pytest

pytest.importorskip("msgloom.llm")

import __spark_entry__ as entry  # noqa: E402
from msgloom.llm.oracle import ORACLE  # noqa: E402
from msgloom.llm.queries import QUERIES  # noqa: E402
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"
NATIVE = {"op3_personal_data", "op5_licenses", "op6_quality", "op7_decontamination"}


def test_queries_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(entry.oracle_sql())
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", *(["Python", "InPandas"] if name in NATIVE else [])):
        assert node not in plan
    if name not in ORACLE:
        table = "pages" if name == "op4_warc" else "documents"
        assert df.count() == spark.read.parquet(f"{SF}/{table}.parquet").count()
        return
    problem, n = compare(duck(SF), spark, SF, lambda *_: df, ORACLE[name])
    assert not problem, problem
    assert n > 0
