"""Property tests: invariants of the enrichment and the reports on random
match frames (quotes present or missing at random, any result)."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from oddsframe.operators.analysis import favourite_summary, outcome_share
from oddsframe.operators.enrich import enrich
from oddsframe.schema import HOUSE_CODES, OUTCOMES, quote_column
from tests.frames import frame, match

quote = st.one_of(st.none(), st.integers(101, 2000).map(lambda c: c / 100))
row = st.tuples(
    st.lists(quote, min_size=18, max_size=18),
    st.sampled_from(["H", "D", "A", None]),
    st.sampled_from(["H", "D", "A"]),
    st.sampled_from(["E0", "I1", "SP1"]),
)
COLS = [quote_column(h, o) for h in HOUSE_CODES for o in OUTCOMES]


def _frame(spark, rows):
    return frame(spark, [match(i, dict(zip(COLS, qs)), ftr=f, htr=h, league=lg)
                         for i, (qs, f, h, lg) in enumerate(rows)])


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_enrichment_invariants(spark, rows):
    out = enrich(_frame(spark, rows)).collect()
    for r in out:
        assert r.VencedorAposta in ("H", "D", "A")
        for o in OUTCOMES:
            best, mean = r[f"MaiorValor{o}"], r[f"Media{o}"]
            assert (best is None) == (mean is None)
            if best is not None:
                assert best >= mean - 0.005
        ps = [r[f"Percent{o}"] for o in OUTCOMES]
        if all(p is not None for p in ps):
            assert sum(ps) == pytest.approx(100.0, abs=1e-3)
        if r.FTR not in ("H", "D", "A"):
            assert r.Percentual == 0.0


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=25))
def test_report_invariants(spark, rows):
    silver = enrich(_frame(spark, rows))
    per_league = favourite_summary(silver, by="league").collect()
    overall = favourite_summary(silver).collect()[0]
    assert sum(r.hits for r in per_league) == overall.hits
    assert sum(r.matches for r in per_league) == overall.matches == len(rows)
    if overall.weighted_pct is not None:
        assert 0.0 <= overall.weighted_pct <= 100.0
    shares = outcome_share(silver, "HTR").collect()[0]
    assert shares.home_pct + shares.draw_pct + shares.away_pct == pytest.approx(100.0)
