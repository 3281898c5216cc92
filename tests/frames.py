"""Tiny hand-written bronze frames for operator tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from oddsframe.schema import HOUSE_CODES, OUTCOMES, quote_column

QUOTE_COLS = [quote_column(h, o) for h in HOUSE_CODES for o in OUTCOMES]

SCHEMA = T.StructType(
    [
        T.StructField("MatchId", T.LongType()),
        T.StructField("League", T.StringType()),
        T.StructField("DateMatch", T.DateType()),
        T.StructField("HomeTeam", T.StringType()),
        T.StructField("AwayTeam", T.StringType()),
        T.StructField("FTHG", T.IntegerType()),
        T.StructField("FTAG", T.IntegerType()),
        T.StructField("FTR", T.StringType()),
        T.StructField("HTR", T.StringType()),
    ]
    + [T.StructField(c, T.DoubleType()) for c in QUOTE_COLS]
    + [T.StructField(f"{p}{o}", T.DoubleType()) for p in ("Max", "Avg") for o in OUTCOMES]
)


def uniform(h: float | None, d: float | None, a: float | None) -> dict[str, float | None]:
    """Every house quotes the same h / d / a."""
    return {quote_column(house, o): v for house in HOUSE_CODES for o, v in zip(OUTCOMES, (h, d, a))}


def match(
    mid: int,
    quotes: dict[str, float | None],
    ftr: str | None = "H",
    league: str = "E0",
    date: dt.date = dt.date(2023, 8, 11),
    home: str = "A",
    away: str = "B",
    htr: str | None = "D",
    supplied: dict[str, float | None] | None = None,
) -> tuple:
    supplied = supplied or {}
    row = [mid, league, date, home, away, 1, 0, ftr, htr]
    row += [quotes.get(c) for c in QUOTE_COLS]
    row += [supplied.get(f"{p}{o}") for p in ("Max", "Avg") for o in OUTCOMES]
    return tuple(row)


def frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)
