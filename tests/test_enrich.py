"""Operator unit tests on hand-written frames (golden rows, nulls, ties)."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from oddsframe.functions import favourite
from oddsframe.operators.enrich import MARGIN_COLUMN, decode_league, enrich, to_long
from oddsframe.operators.quality import max_reconcile, mean_reconcile, mismatch_counts
from oddsframe.schema import HOUSE_CODES, quote_column
from tests.frames import frame, match, uniform


def _one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_golden_probability_example(spark):
    # consensus 1.51 / 4.74 / 5.62, away win
    df = enrich(frame(spark, [match(1, uniform(1.51, 4.74, 5.62), ftr="A")]), with_margin=True)
    r = _one(df)
    assert (r.MediaH, r.MediaD, r.MediaA) == (1.51, 4.74, 5.62)
    assert r.VencedorAposta == "H"
    assert [round(x, 2) for x in (r.PercentAbsolH, r.PercentAbsolD, r.PercentAbsolA)] == [66.23, 21.10, 17.79]
    assert round(r[MARGIN_COLUMN] + 100, 2) == 105.12
    assert [round(x, 2) for x in (r.PercentH, r.PercentD, r.PercentA)] == [63.00, 20.07, 16.93]
    assert r.PercentH + r.PercentD + r.PercentA == pytest.approx(100.0, abs=1e-4)
    assert round(r.Percentual, 2) == 16.93
    assert dict(df.dtypes)["PercentH"] == "float"
    assert dict(df.dtypes)["MediaH"] == "double"


def test_golden_max_reconciliation(spark):
    quotes = uniform(2.5, 4.0, 4.5)
    quotes.update({"PSH": 2.71, "VCD": 4.23, "WHA": 4.82})
    supplied = {"MaxH": 2.75, "MaxD": 4.33, "MaxA": 5.0}
    r = _one(max_reconcile(frame(spark, [match(1, quotes, supplied=supplied)])))
    assert (r.computed_home, r.computed_draw, r.computed_away) == (2.71, 4.23, 4.82)
    assert (r.differs_home, r.differs_draw, r.differs_away) == (True, True, True)


def test_null_quotes(spark):
    one_missing = uniform(2.0, 3.0, 4.0)
    one_missing.update({"B365H": None})
    one_missing.update({"BWH": 2.6})  # five quoting houses for H: 2.6 + 4 * 2.0
    single = {c: None for c in uniform(0, 0, 0)}
    single.update({"PSH": 1.9, "PSD": 3.3, "PSA": 4.1})
    none = {c: None for c in uniform(0, 0, 0)}
    df = enrich(frame(spark, [match(1, one_missing), match(2, single), match(3, none)]))
    rows = {r.MatchId: r for r in df.collect()}
    assert rows[1].MediaH == round((2.6 + 4 * 2.0) / 5, 2)
    assert (rows[2].MediaH, rows[2].MediaD, rows[2].MediaA) == (1.9, 3.3, 4.1)
    assert rows[2].MaiorValorH == 1.9
    assert rows[3].MediaH is None and rows[3].MaiorValorH is None
    assert rows[3].PercentAbsolH is None and rows[3].PercentH is None


def test_strict_mean_is_null_when_a_house_is_missing(spark):
    quotes = uniform(2.0, 3.0, 4.0)
    quotes["WHD"] = None
    df = frame(spark, [match(1, quotes, supplied={"AvgH": 2.0, "AvgD": 3.0, "AvgA": 4.1})])
    audit = _one(mean_reconcile(df))
    assert audit.computed_home == 2.0 and audit.differs_home is False
    assert audit.computed_draw is None and audit.differs_draw is None
    assert audit.differs_away is True
    assert _one(enrich(df)).MediaD == 3.0
    counts = _one(mismatch_counts(df))
    assert (counts.avg_differs_home, counts.avg_differs_draw, counts.avg_differs_away) == (0, 0, 1)


@pytest.mark.parametrize(
    "h,d,a,expected",
    [
        (1.5, 3.0, 5.0, "H"),
        (3.0, 1.5, 5.0, "D"),
        (5.0, 3.0, 1.5, "A"),
        (2.0, 2.0, 5.0, "A"),   # H = D lowest
        (2.0, 5.0, 2.0, "A"),   # H = A lowest
        (5.0, 2.0, 2.0, "A"),   # D = A lowest
        (2.0, 2.0, 2.0, "A"),   # all equal
        (None, None, None, "A"),
        (None, 2.0, 3.0, "A"),  # D < null is unknown, so the draw arm fails too
    ],
)
def test_pick_ties_and_nulls(spark, h, d, a, expected):
    df = spark.createDataFrame([(h, d, a)], "h double, d double, a double")
    assert _one(df.select(favourite("h", "d", "a").alias("p"))).p == expected


def test_pick_fallback_can_be_null(spark):
    df = spark.createDataFrame([(2.0, 2.0, 2.0)], "h double, d double, a double")
    assert _one(df.select(favourite("h", "d", "a", fallback=None).alias("p"))).p is None


def test_realised_probability_null_and_unknown_results(spark):
    rows = [
        match(1, uniform(2.0, 3.0, 4.0), ftr=None),
        match(2, uniform(2.0, 3.0, 4.0), ftr="X"),
        match(3, {c: None for c in uniform(0, 0, 0)}, ftr="H"),
    ]
    got = {r.MatchId: r.Percentual for r in enrich(frame(spark, rows)).collect()}
    assert got[1] == 0.0 and got[2] == 0.0
    assert got[3] is None


def test_decode_league_passthrough(spark):
    df = spark.createDataFrame([("E0",), ("SP1",), ("X9",), (None,)], "League string")
    got = [r.League for r in decode_league(df).collect()]
    assert got == ["Inglaterra", "Espanha", "X9", None]


def test_to_long_drops_missing_quotes(spark):
    quotes = uniform(2.0, 3.0, 4.0)
    quotes[quote_column("IW", "A")] = None
    long = to_long(frame(spark, [match(7, quotes)]), ["MatchId"])
    assert long.count() == len(HOUSE_CODES) * 3 - 1
    best = long.groupBy("outcome").agg(F.max("quote").alias("m")).collect()
    assert {r.outcome: r.m for r in best} == {"H": 2.0, "D": 3.0, "A": 4.0}


def test_stepwise_helpers_match_enrich(spark):
    from oddsframe.operators.enrich import (
        add_best_quotes, add_consensus, add_implied, add_normalised, add_pick, add_realised,
        silver_columns,
    )

    rows = [match(1, uniform(1.51, 4.74, 5.62), ftr="A"), match(2, uniform(2.0, 3.0, 4.0), ftr=None)]
    df = frame(spark, rows)
    steps = add_realised(add_normalised(add_implied(add_pick(add_consensus(add_best_quotes(df))))))
    cols = ["MatchId", *silver_columns()]
    assert sorted(steps.select(cols).collect()) == sorted(enrich(df).select(cols).collect())


def test_bronze_schema_carries_comments():
    from oddsframe.schema import bronze_schema

    schema = bronze_schema({"MatchId": __import__("pyspark.sql.types", fromlist=["x"]).LongType()})
    assert len(schema.fields) == 65
    assert schema["B365H"].metadata["comment"] == "Bet365 home win odds"
    assert schema["TimeMatch"].dataType.simpleString() == "timestamp_ntz"
