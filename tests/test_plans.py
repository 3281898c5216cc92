"""Physical-plan properties: one scan, no joins, pruned reads, pushed filters."""

from __future__ import annotations

import pytest

from oddsframe.operators.analysis import hit_rate, house_dispersion, match_lookup, outcome_share
from oddsframe.operators.enrich import enrich
from oddsframe.plans.inspect import physical_operators, pushed_filters, read_schema
from oddsframe.plans.registry import bronze
from oddsframe.session import scratch_dir
from tests.conftest import SF_SMOKE

JOINS = {"BroadcastHashJoin", "SortMergeJoin", "ShuffledHashJoin", "BroadcastNestedLoopJoin",
         "CartesianProduct"}


@pytest.fixture(scope="module")
def stored(spark):
    root = scratch_dir(spark, "plans")
    bronze(spark, SF_SMOKE).write.parquet(f"{root}/bronze")
    enrich(spark.read.parquet(f"{root}/bronze")).write.parquet(f"{root}/silver")
    return spark.read.parquet(f"{root}/bronze"), spark.read.parquet(f"{root}/silver")


def test_enrichment_is_one_projection_over_the_scan(stored):
    b, _ = stored
    ops = physical_operators(enrich(b))
    assert "Exchange" not in ops and not JOINS & set(ops)
    assert ops.count("Project") == 1          # all silver columns in one pass
    assert len(read_schema(enrich(b))) == 1


def test_dispersion_is_one_scan_one_shuffle(stored):
    _, s = stored
    df = house_dispersion(s)
    ops = physical_operators(df)
    assert ops.count("Exchange") == 1 and not JOINS & set(ops)
    schemas = read_schema(df)
    assert len(schemas) == 1                       # a single parquet scan
    assert "League" not in schemas[0] and "MediaH" in schemas[0] and "WHA" in schemas[0]


@pytest.mark.parametrize("by", ["league", "month", None])
def test_hit_rates_are_joinless_and_pruned(stored, by):
    _, s = stored
    for weighted in (False, True):
        df = hit_rate(s, by=by, weighted=weighted)
        ops = set(physical_operators(df))
        assert not JOINS & ops
        (schema,) = read_schema(df)
        assert "B365H" not in schema and "HomeTeam" not in schema


def test_lookup_filters_reach_the_scan(stored):
    _, s = stored
    (filters,) = pushed_filters(match_lookup(s, "T3", "T10"))
    assert "EqualTo(HomeTeam,T3)" in filters and "EqualTo(AwayTeam,T10)" in filters


def test_outcome_share_reads_one_column(stored):
    _, s = stored
    (schema,) = read_schema(outcome_share(s, "HTR"))
    assert schema == "struct<HTR:string>"


def test_sorted_layer_write_needs_no_shuffle(spark, stored):
    from oddsframe.sources import tables
    from oddsframe.session import unique_name

    _, s = stored
    db = unique_name("sorted")
    tables.create_database(spark, db, scratch_dir(spark, f"{db}.db"))
    tables.write_layer(s, f"{db}.europa", sort_within=["HomeTeam", "AwayTeam"])
    back = spark.table(f"{db}.europa")
    assert back.count() == s.count()
    ops = physical_operators(s.sortWithinPartitions("HomeTeam", "AwayTeam"))
    assert "Sort" in ops and "Exchange" not in ops
    (filters,) = pushed_filters(match_lookup(back, "T3", "T10"))
    assert "EqualTo(HomeTeam,T3)" in filters


def test_all_levels_read_the_table_once(stored):
    from oddsframe.operators.analysis import hit_rate_levels

    _, s = stored
    df = hit_rate_levels(s)
    ops = physical_operators(df)
    assert ops.count("Expand") == 1 and not JOINS & set(ops)
    (schema,) = read_schema(df)          # one scan for overall + league + month
    assert "B365H" not in schema and "League" in schema and "DateMatch" in schema
