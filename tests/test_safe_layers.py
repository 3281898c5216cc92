"""Loads and rebuilds that must not lose data silently."""

from __future__ import annotations

import pytest

from oddsframe.operators.analysis import hit_rate
from oddsframe.operators.enrich import enrich
from oddsframe.plans.layers import build_bronze
from oddsframe.session import scratch_dir, unique_name
from oddsframe.sources import leagues, tables
from tests.frames import frame, match, uniform

PLAIN = "Div,Date,HomeTeam,AwayTeam,FTR,B365H,B365D,B365A"
EXTRA = "Div,Date,HomeTeam,AwayTeam,FTR,Referee,B365H,B365D,B365A"


def _folder(tmp_path):
    (tmp_path / "a.csv").write_text(PLAIN + "\nE0,11-08-2023,X,Y,H,1.5,3.0,6.0\n")
    (tmp_path / "b.csv").write_text(EXTRA + "\nE0,12-08-2023,Y,X,A,Smith,2.5,3.5,4.5\n")
    return str(tmp_path)


def test_one_folder_with_two_headers(spark, tmp_path):
    rows = leagues.ingest(spark, [_folder(tmp_path)]).orderBy("DateMatch").collect()
    assert [(r.B365H, r.B365D, r.B365A) for r in rows] == [(1.5, 3.0, 6.0), (2.5, 3.5, 4.5)]


def test_a_mismatched_header_raises(spark, tmp_path):
    folder = _folder(tmp_path)
    with pytest.raises(Exception, match="CSV header"):
        leagues.read_typed(spark, [folder], PLAIN.split(",")).collect()


def test_named_house_that_is_absent_raises(spark):
    df = frame(spark, [match(1, uniform(2.0, 3.0, 4.0))])
    with pytest.raises(ValueError, match="incomplete"):
        enrich(df.drop("WHA"), houses=("B365", "WH"))
    with pytest.raises(ValueError, match="XX"):
        enrich(df, houses=("B365", "XX"))


def test_null_league_survives_the_export(spark):
    df = leagues.to_raw_layout(frame(spark, [match(1, uniform(2.0, 3.0, 4.0), league=None),
                                             match(2, uniform(2.0, 3.0, 4.0), league="E0")]))
    out = scratch_dir(spark, "nulls")
    leagues.write_league_files(df, out)
    assert leagues.ingest(spark, [out]).count() == 2


def test_reports_print_all_groups(spark, capsys):
    tables.display(spark.range(35))
    assert "|34 |" in capsys.readouterr().out


def test_failed_rebuild_leaves_the_layer(spark):
    db = unique_name("kept")
    tables.create_database(spark, db, scratch_dir(spark, db))
    tables.write_layer(spark.range(3), f"{db}.europa", comments={})
    with pytest.raises(Exception):
        build_bronze(spark, ["/nowhere/at/all"], f"{db}.europa")
    assert spark.table(f"{db}.europa").count() == 3
    tables.write_layer(spark.table(f"{db}.europa").where("id > 0"), f"{db}.europa", comments={})
    assert spark.table(f"{db}.europa").count() == 2


def test_options_of_the_absolute_rate_are_refused_by_the_weighted(spark):
    df = enrich(frame(spark, [match(1, uniform(2.0, 3.0, 4.0))]))
    with pytest.raises(ValueError):
        hit_rate(df, by="league", weighted=True, drop_empty=True)


def test_pick_of_declared_length(spark, tmp_path):
    db = f"len_{tmp_path.name}".replace("-", "_")
    tables.create_database(spark, db, str(tmp_path / "db"))
    rows = spark.createDataFrame([(1, "H")], "MatchId long, VencedorAposta string")
    tables.create_layer(spark, f"{db}.t", rows, {"VencedorAposta": "VARCHAR(1)"})
    tables.write_layer(rows, f"{db}.t", mode="append", comments={})
    tables.write_layer(rows, f"{db}.t", mode="append", comments={})
    assert spark.table(f"{db}.t").count() == 2
    with pytest.raises(Exception, match="(?i)exceed"):
        tables.write_layer(rows.selectExpr("MatchId", "'HH' AS VencedorAposta"), f"{db}.t", mode="append", comments={})
    assert spark.table(f"{db}.t").count() == 2
