"""Every registered query against its DuckDB oracle (the correctness gate),
plus the driver's smoke entry."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oddsframe.plans.inspect import physical_operators
from oddsframe.plans.registry import ORACLE, QUERIES
from tests.conftest import SF_SMOKE
from tests.oracle_check import compare, duck


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMOKE)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


# Plan policy for every registered query: no cross joins, no Python UDFs.
FORBIDDEN = {"CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython",
             "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonMapInArrow"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    built = {}

    def run(session, sf):
        built["df"] = QUERIES[name](session, sf)
        return built["df"]

    res = compare(spark, con, name, run, ORACLE.get(name), SF_SMOKE)
    assert res["status"] == "OK", res["status"]
    assert res["rows"] > 0
    assert not FORBIDDEN & set(physical_operators(built["df"]))


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["league", "hit_pct"]
    assert [r.hit_pct for r in rows] == sorted((r.hit_pct for r in rows), reverse=True)
