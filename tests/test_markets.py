"""Two-way markets: settlement at every line, margins, and fitted goal rates."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from oddsframe.functions.goals import goal_rates_sql, outcome_probabilities_sql, over_sql
from oddsframe.operators.markets import (
    RESULTS,
    fit_goal_rates,
    handicap_ladder,
    handicap_report,
    settle_handicap,
)

MATCH = "MatchId long, FTHG int, FTAG int, AHh double, AvgAHH double, AvgAHA double"


def settled(gap: float, line: float | None) -> str | None:
    """Both half stakes settled one by one."""
    if line is None or line * 4 != int(line * 4):
        return None
    legs = [line, line] if line * 2 == int(line * 2) else [line - 0.25, line + 0.25]
    points = sum((gap + leg > 0) - (gap + leg < 0) for leg in legs)
    return dict(zip((2, 1, 0, -1, -2), RESULTS))[points]


def test_every_quarter_line_for_both_sides(spark):
    lines = [k / 4 for k in range(-12, 13)] + [0.1, -0.3, None]
    rows = [(i * 100 + h * 10 + a, h, a, line, 1.9, 2.0)
            for i, line in enumerate(lines) for h in range(4) for a in range(4)]
    paid = {"won": lambda q: q - 1, "half_won": lambda q: (q - 1) / 2, "push": lambda q: 0.0,
            "half_lost": lambda q: -0.5, "lost": lambda q: -1.0, None: lambda q: None}
    found = settle_handicap(spark.createDataFrame(rows, MATCH)).collect()
    assert len(found) == len(rows)
    for r in found:
        home = settled(r.FTHG - r.FTAG, r.AHh)
        away = settled(r.FTAG - r.FTHG, None if r.AHh is None else -r.AHh)
        assert (r.ah_home, r.ah_away) == (home, away)
        assert (r.ah_home_profit, r.ah_away_profit) == (paid[home](1.9), paid[away](2.0))
        assert r.ah_p_home == pytest.approx((1 / 1.9) / (1 / 1.9 + 1 / 2.0))
        assert r.ah_margin == pytest.approx((1 / 1.9 + 1 / 2.0 - 1) * 100)


def test_unplayed_and_unquoted_matches_are_not_settled_or_counted(spark):
    rows = [(1, None, None, 0.5, 1.9, 1.9), (2, 1, 0, None, 1.9, 1.9), (3, 1, 0, -0.75, None, 2.1), (4, 1, 0, -0.75, 1.8, 0.0)]
    matches = spark.createDataFrame(rows, MATCH)
    by_id = {r.MatchId: r for r in settle_handicap(matches).collect()}
    assert by_id[1].ah_home is None and by_id[1].ah_home_profit is None
    assert by_id[2].ah_home is None and by_id[2].ah_p_home is not None
    assert by_id[3].ah_home == "half_won" and by_id[3].ah_home_profit is None and by_id[3].ah_margin is None
    assert by_id[4].ah_p_home is None  # a price of zero has no probability
    report = {(r.house, r.side): r for r in handicap_report(matches, houses=["Avg"]).collect()}
    assert report["Avg", "home"].bets == 1 and report["Avg", "home"].half_won == 1
    assert report["Avg", "home"].profit == pytest.approx(0.4)
    assert report["Avg", "away"].bets == 2 and report["Avg", "away"].profit == -1.0
    assert handicap_report(matches.limit(0), houses=["Avg"]).collect() == []


def test_the_ladder_counts_every_match_at_every_line(spark):
    goals = [(i, h, a, 0.0, 1.9, 1.9) for i, (h, a) in enumerate([(0, 0), (1, 0), (3, 1), (0, 2), (1, 0)])]
    ladder = {r.line: r for r in handicap_ladder(spark.createDataFrame(goals + [(9, None, 1, 0.0, 1.9, 1.9)], MATCH)).collect()}
    assert len(ladder) == 26
    for line, row in ladder.items():
        assert row.matches == 6
        want = [settled(h - a, line) for _, h, a, *_ in goals]
        assert [row[r] for r in RESULTS] == [want.count(r) for r in RESULTS]


def test_fitted_rates_give_the_prices_back(spark):
    prices = [(h, d, a) for h in (1.02, 1.3, 2.0, 4.5, 15.0, 80.0) for d in (1.2, 2.8, 4.0, 9.0, 30.0)
              for a in (1.05, 1.9, 3.3, 12.0, 60.0)]
    rows = spark.createDataFrame([(float(i), *p) for i, p in enumerate(prices)] + [(-1.0, None, 3.0, 3.0)],
                                 "k double, MediaH double, MediaD double, MediaA double")
    found = fit_goal_rates(rows).collect()
    assert len(found) == len(prices) + 1
    for r in found:
        if r.k < 0:
            assert r.goals_home is None and r.fit_draw is None
            continue
        book = 1 / r.MediaH + 1 / r.MediaD + 1 / r.MediaA
        for fit, price in ((r.fit_home, r.MediaH), (r.fit_draw, r.MediaD), (r.fit_away, r.MediaA)):
            assert fit == pytest.approx(1 / price / book, abs=1e-6)


def test_rates_come_back_from_their_own_probabilities(spark):
    rates = [(0.2, 0.3), (1.4, 1.1), (3.5, 0.4), (0.1, 4.0), (6.0, 6.0)]
    df = spark.createDataFrame(rates, "a double, b double").selectExpr("*", f"{outcome_probabilities_sql('a', 'b')} AS o")
    df = df.selectExpr("a", "b", "o.*").selectExpr(
        "a", "b", "home", "draw", "away", f"{goal_rates_sql('home', 'draw', 'away')} AS r",
        f"{over_sql('a', 'b')} AS over", "CAST(NULL AS DOUBLE) AS nothing")
    for r in df.collect():
        assert (r.r.home, r.r.away) == (pytest.approx(r.a, rel=1e-7), pytest.approx(r.b, rel=1e-7))
        t = r.a + r.b
        assert r.over == pytest.approx(1 - sum(math.exp(-t) * t ** k / math.factorial(k) for k in range(3)))
    outside = df.limit(1).withColumns({"h": F.lit(1.0), "d": F.lit(0.0), "x": F.lit(0.0)})
    assert outside.selectExpr(f"{goal_rates_sql('h', 'd', 'x')} AS r").first().r is None
    with pytest.raises(ValueError):
        over_sql("a", "b", 2.0)
