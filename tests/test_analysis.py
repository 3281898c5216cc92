"""Report semantics: denominators, empty groups, sorting, formatting."""

from __future__ import annotations

import datetime as dt

import pytest

from oddsframe.operators.analysis import (
    favourite_summary,
    hit_rate,
    house_dispersion,
    match_lookup,
    outcome_share,
)
from oddsframe.operators.enrich import enrich
from tests.frames import frame, match, uniform

FAV_H = uniform(1.5, 4.0, 6.0)   # home is the favourite


def _silver(spark, rows):
    return enrich(frame(spark, rows))


def test_absolute_rate_counts_every_match(spark):
    rows = [
        match(1, FAV_H, ftr="H"),
        match(2, FAV_H, ftr="A"),
        match(3, FAV_H, ftr=None),      # counted, never a hit
        match(4, FAV_H, ftr="H"),
    ]
    r = hit_rate(_silver(spark, rows)).collect()[0]
    assert r.hit_pct == 50.0


def test_weighted_rate_skips_null_probability_but_counts_zero(spark):
    none = {c: None for c in FAV_H}
    rows = [
        match(1, FAV_H, ftr="H"),
        match(2, FAV_H, ftr=None),      # probability 0, counted
        match(3, none, ftr="H"),        # probability null, skipped
    ]
    silver = _silver(spark, rows)
    p = {r.MatchId: r.Percentual for r in silver.collect()}
    r = hit_rate(silver, weighted=True).collect()[0]
    assert r.weighted_pct == pytest.approx((float(p[1]) + 0.0) / 2)


def test_zero_hit_league_kept_or_dropped(spark):
    rows = [
        match(1, FAV_H, ftr="H", league="E0"),
        match(2, FAV_H, ftr="A", league="F1"),   # F1 never hit
    ]
    silver = _silver(spark, rows)
    kept = {r.league: r.hit_pct for r in hit_rate(silver, by="league").collect()}
    assert kept == {"E0": 100.0, "F1": 0.0}
    dropped = {r.league: r.hit_pct for r in hit_rate(silver, by="league", drop_empty=True).collect()}
    assert dropped == {"E0": 100.0}


def test_numeric_sort_then_format(spark):
    # league rates 9.50 / 55.05 / 100.00 -> numeric order 100, 55.05, 9.5
    rows = []
    mid = 0
    for league, hits, total in (("A", 19, 200), ("B", 1101, 2000), ("C", 3, 3)):
        for i in range(total):
            mid += 1
            rows.append(match(mid, FAV_H, ftr="H" if i < hits else "D", league=league))
    silver = _silver(spark, rows)
    numeric = [r.hit_pct for r in hit_rate(silver, by="league").collect()]
    assert numeric == [100.0, 55.05, 9.5]
    text = [r.hit_pct for r in hit_rate(silver, by="league", formatted=True).collect()]
    assert text == ["100.00", "55.05", "9.50"]


def test_share_of_total_and_month_grouping(spark):
    rows = [
        match(1, FAV_H, ftr="H", league="E0", date=dt.date(2023, 8, 1)),
        match(2, FAV_H, ftr="H", league="I1", date=dt.date(2024, 8, 9)),
        match(3, FAV_H, ftr="D", league="I1", date=dt.date(2023, 9, 1)),
        match(4, FAV_H, ftr="H", league="I1", date=dt.date(2023, 9, 2)),
    ]
    silver = _silver(spark, rows)
    share = {r.league: (r.hit_pct, r.share_pct)
             for r in hit_rate(silver, by="league", share_of_total=True).collect()}
    assert share["E0"] == (100.0, 25.0)
    assert share["I1"] == (pytest.approx(200 / 3), 50.0)
    months = {r.month: r.hit_pct for r in hit_rate(silver, by="month").collect()}
    assert months == {8: 100.0, 9: 50.0}   # August of two years merge


def test_per_league_hits_add_up_to_overall(spark):
    rows = [match(i, FAV_H, ftr="HDA"[i % 3], league=["E0", "I1", "F1"][i % 3 - 1 if i % 5 else 0])
            for i in range(30)]
    s = favourite_summary(_silver(spark, rows), by="league").collect()
    overall = favourite_summary(_silver(spark, rows)).collect()[0]
    assert sum(r.hits for r in s) == overall.hits
    assert sum(r.matches for r in s) == overall.matches == 30


def test_dispersion_one_row_per_house(spark):
    q1 = uniform(2.0, 3.0, 4.0)
    q2 = uniform(2.0, 3.0, 4.0)
    q2["B365H"] = 2.6
    out = {r.house: r for r in house_dispersion(_silver(spark, [match(1, q1), match(2, q2)])).collect()}
    assert list(out) == ["Bet365", "Bet&Win", "Interwetten", "Pinnacle", "VC Bet", "William Hill"]
    assert out["Bet365"].sd_home > 0 and out["Bet365"].sd_draw == 0.0
    single = house_dispersion(_silver(spark, [match(1, q1)])).collect()
    assert all(r.sd_home is None for r in single)    # one row: sample stddev undefined


def test_outcome_shares(spark):
    rows = [match(i, FAV_H, ftr=f, htr=h)
            for i, (f, h) in enumerate([("H", "H"), ("D", "H"), ("A", "D"), (None, "A")])]
    silver = _silver(spark, rows)
    half = outcome_share(silver).collect()[0]
    assert (half.home_pct, half.draw_pct, half.away_pct) == (50.0, 25.0, 25.0)
    full = outcome_share(silver, "FTR").collect()[0]
    assert full.home_pct + full.draw_pct + full.away_pct == 75.0
    text = outcome_share(silver, formatted=True).collect()[0]
    assert text.home_pct == "50.00"


def test_match_lookup(spark):
    rows = [match(1, FAV_H, home="Barcelona", away="Girona"), match(2, FAV_H, home="Girona", away="Barcelona")]
    got = match_lookup(_silver(spark, rows), "Barcelona", "Girona").collect()
    assert len(got) == 1 and got[0].MediaH == 1.5


def test_season_grouping_splits_years(spark):
    rows = [
        match(1, FAV_H, ftr="H", date=dt.date(2023, 8, 1)),
        match(2, FAV_H, ftr="D", date=dt.date(2024, 5, 1)),   # same 2023 season
        match(3, FAV_H, ftr="H", date=dt.date(2024, 8, 9)),   # 2024 season
    ]
    got = {r.season: r.hit_pct for r in hit_rate(_silver(spark, rows), by="season").collect()}
    assert got == {2023: 50.0, 2024: 100.0}


def test_share_of_total_for_arbitrary_grouping(spark):
    rows = [match(i, FAV_H, ftr="H" if i % 2 else "D", home=f"T{i % 3}") for i in range(12)]
    silver = _silver(spark, rows)
    got = {r.HomeTeam: (r.hit_pct, r.share_pct)
           for r in hit_rate(silver, by="HomeTeam", share_of_total=True).collect()}
    # T0: ids 0,3,6,9 -> hits 3,9 ; T1: 1,4,7,10 -> 1,7 ; T2: 2,5,8,11 -> 5,11
    assert got == {"T0": (50.0, 2 * 100 / 12), "T1": (50.0, 2 * 100 / 12), "T2": (50.0, 2 * 100 / 12)}
    ops = " ".join(__import__("oddsframe.plans.inspect", fromlist=["x"]).physical_operators(
        hit_rate(silver, by="HomeTeam", share_of_total=True)))
    assert "Window" not in ops


def test_reports_on_empty_input(spark):
    empty = _silver(spark, [match(1, FAV_H)]).limit(0)
    assert hit_rate(empty).collect()[0].hit_pct is None
    assert hit_rate(empty, weighted=True).collect()[0].weighted_pct is None
    assert outcome_share(empty).collect()[0].home_pct is None
    assert hit_rate(empty, by="league").collect() == []


def test_share_denominator_keeps_dropped_groups(spark):
    rows = [match(1, FAV_H, ftr="H", league="E0"), match(2, FAV_H, ftr="A", league="F1"),
            match(3, FAV_H, ftr="A", league="F1"), match(4, FAV_H, ftr="D", league="E0")]
    got = {r.league: (r.hit_pct, r.share_pct)
           for r in hit_rate(_silver(spark, rows), by="league", share_of_total=True,
                             drop_empty=True).collect()}
    assert got == {"E0": (50.0, 25.0)}    # 1 hit of all 4 matches, F1 dropped


def test_all_levels_in_one_pass(spark):
    from oddsframe.operators.analysis import hit_rate_levels

    rows = [
        match(1, FAV_H, ftr="H", league="E0", date=dt.date(2023, 8, 1)),
        match(2, FAV_H, ftr="D", league="E0", date=dt.date(2023, 9, 1)),
        match(3, FAV_H, ftr="H", league="I1", date=dt.date(2023, 9, 2)),
        match(4, FAV_H, ftr=None, league="I1", date=dt.date(2023, 8, 3)),
    ]
    silver = _silver(spark, rows)
    got = {(r.level, r.league, r.month): (r.matches, r.hits, r.hit_pct)
           for r in hit_rate_levels(silver).collect()}
    assert got[("overall", None, None)] == (4, 2, 50.0)
    assert got[("league", "E0", None)] == (2, 1, 50.0)
    assert got[("league", "I1", None)] == (2, 1, 50.0)
    assert got[("month", None, 8)] == (2, 1, 50.0)
    assert got[("month", None, 9)] == (2, 1, 50.0)
    assert len(got) == 5


def test_all_levels_plan_is_one_scan(spark):
    from oddsframe.operators.analysis import hit_rate_levels
    from oddsframe.plans.inspect import physical_operators

    silver = _silver(spark, [match(1, FAV_H)])
    ops = physical_operators(hit_rate_levels(silver))
    assert "Expand" in ops and not {"BroadcastHashJoin", "SortMergeJoin"} & set(ops)


def test_grouping_by_any_column_expression(spark):
    from pyspark.sql import functions as F

    rows = [
        match(1, FAV_H, ftr="H", date=dt.date(2023, 8, 1)),
        match(2, FAV_H, ftr="D", date=dt.date(2024, 8, 1)),
        match(3, FAV_H, ftr="H", date=dt.date(2024, 9, 1)),
    ]
    df = hit_rate(_silver(spark, rows), by=F.year("DateMatch").alias("year"))
    assert df.columns == ["year", "hit_pct"]
    assert [(r.year, r.hit_pct) for r in df.collect()] == [(2023, 100.0), (2024, 50.0)]
