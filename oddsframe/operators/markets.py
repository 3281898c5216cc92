"""The two-way markets: Asian handicap and over/under goals.

Settlement is a row-wise expression.  Reports count or add up exactly (DECIMAL), so
their figures do not depend on the order in which tasks finish.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.goals import goal_rates_sql, outcome_probabilities_sql, over_sql
from ..functions.numbers import percent
from ..functions.quotes import ident
from ..schema import CONSENSUS_PREFIX, OUTCOMES

#: Houses that quote the two-way markets (column prefixes).
MARKET_HOUSES: tuple[str, ...] = ("B365", "P", "Max", "Avg")
LINE_COLUMN = "AHh"
RESULTS: tuple[str, ...] = ("won", "half_won", "push", "half_lost", "lost")
_MONEY = "decimal(18,4)"
_TOTAL = "decimal(38,4)"


def handicap_legs(line: Column) -> tuple[Column, Column]:
    """The two half-lines a stake is split over: a quarter line goes half on the line
    0.25 below and half on that above; other lines are both legs."""
    return F.floor(line * 2) / 2, F.ceil(line * 2) / 2


def handicap_result(line: Column, goals_for: Column, goals_against: Column) -> Column:
    """One of ``RESULTS`` for a bet at ``line`` on the side that scored ``goals_for``; null if
    line or goals are, or if the line is no multiple of 0.25."""
    legs = [F.signum((goals_for - goals_against).cast("double") + leg) for leg in handicap_legs(line)]
    points = legs[0] + legs[1]
    named = F.when(points == 2, "won").when(points == 1, "half_won").when(points == 0, "push").when(
        points == -1, "half_lost").when(points == -2, "lost")
    return F.when(line * 4 == F.floor(line * 4), named)


def handicap_profit(result: Column, quote: Column) -> Column:
    """Profit of a unit stake at decimal ``quote``."""
    return (F.when(result == "won", quote - 1).when(result == "half_won", (quote - 1) / 2).when(result == "push", 0.0)
            .when(result == "half_lost", -0.5).when(result == "lost", -1.0))


def two_way(quote: Column, other: Column) -> tuple[Column, Column]:
    """Margin-free probability of ``quote``'s side, and the margin in percent, of a
    market with two prices."""
    raw, rest = F.try_divide(F.lit(1.0), quote), F.try_divide(F.lit(1.0), other)
    return F.try_divide(raw, raw + rest), (raw + rest - 1) * 100


def settle_handicap(matches: DataFrame, house: str = "Avg", line: str | Column = LINE_COLUMN) -> DataFrame:
    """``matches`` with ``ah_line, ah_home, ah_away`` (results of either side),
    ``ah_home_profit, ah_away_profit`` (of a unit stake), ``ah_p_home`` (margin-free) and
    ``ah_margin``.  The away side plays the line with the sign turned."""
    line = F.col(line) if isinstance(line, str) else line
    home, away = F.col(f"{house}AHH"), F.col(f"{house}AHA")
    p_home, margin = two_way(home, away)
    return matches.withColumn("ah_line", line.cast("double")).withColumns({
        "ah_home": handicap_result(F.col("ah_line"), F.col("FTHG"), F.col("FTAG")),
        "ah_away": handicap_result(-F.col("ah_line"), F.col("FTAG"), F.col("FTHG")),
    }).withColumns({
        "ah_home_profit": handicap_profit(F.col("ah_home"), home),
        "ah_away_profit": handicap_profit(F.col("ah_away"), away),
        "ah_p_home": p_home, "ah_margin": margin,
    })


def handicap_report(matches: DataFrame, houses: Sequence[str] = MARKET_HOUSES, by: str | Column | None = None) -> DataFrame:
    """What backing every home, or every away side would have returned: ``house, [by,]
    side, bets`` (settled and quoted), one count for each of ``RESULTS``, ``profit`` and
    ``yield_pct``.  One scan for all houses; each match becomes one row a house and side
    inside the task and is aggregated there."""
    group = [] if by is None else [(F.col(by) if isinstance(by, str) else by).alias(by if isinstance(by, str) else "group")]
    sides = {"home": ("AHH", handicap_result(F.col(LINE_COLUMN), F.col("FTHG"), F.col("FTAG"))),
             "away": ("AHA", handicap_result(-F.col(LINE_COLUMN), F.col("FTAG"), F.col("FTHG")))}
    bets = F.array(*[F.struct(F.lit(house).alias("house"), F.lit(side).alias("side"), result.alias("result"),
                              F.col(f"{house}{code}").alias("quote"))
                     for house in houses for side, (code, result) in sides.items()])
    rows = matches.select(*group, F.explode(bets).alias("bet")).select("*", "bet.*").drop("bet")
    rows = rows.where(F.col("quote").isNotNull() & F.col("result").isNotNull())
    keys = ["house", *[c for c in rows.columns if c not in ("house", "side", "result", "quote")], "side"]
    profit = F.sum(handicap_profit(F.col("result"), F.col("quote")).cast(_MONEY)).cast(_TOTAL)
    out = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("bets"),
                                  *[F.count_if(F.col("result") == r).alias(r) for r in RESULTS], profit.alias("total"))
    return out.select(*keys, "bets", *RESULTS, F.col("total").cast("double").alias("profit"),
                      percent(F.col("total"), F.col("bets")).alias("yield_pct"))


def handicap_ladder(matches: DataFrame, low: float = -3.0, high: float = 3.0) -> DataFrame:
    """How the home side would have fared at every line from ``low`` to ``high`` in steps of
    0.25, and at no line: ``line`` (null for none), ``matches`` and a count for each of ``RESULTS``.

    Matches are counted by goal difference first; the lines meet that small table only."""
    lines = F.array(*[F.lit(low + 0.25 * k) for k in range(int(round((high - low) * 4)) + 1)], F.lit(None).cast("double"))
    counted = matches.groupBy((F.col("FTHG") - F.col("FTAG")).alias("gap")).agg(F.count(F.lit(1)).alias("n"))
    rows = counted.select("gap", "n", F.explode(lines).alias("line"))
    result = handicap_result(F.col("line"), F.col("gap"), F.lit(0))
    return rows.groupBy("line").agg(F.sum("n").alias("matches"), *[
        F.coalesce(F.sum(F.when(result == r, F.col("n"))), F.lit(0)).alias(r) for r in RESULTS])


def fit_goal_rates(silver: DataFrame, prefix: str = CONSENSUS_PREFIX) -> DataFrame:
    """``silver`` with ``goals_home`` and ``goals_away``: the Poisson rates that give its 1X2
    prices (margin removed in proportion), and ``fit_home, fit_draw, fit_away``, the probabilities
    those rates give back.  Null where a price is missing.

    Each different triple of prices is fitted once and joined back: prices come in
    steps of a cent, so at scale there are far fewer triples than matches."""
    prices = [f"{prefix}{o}" for o in OUTCOMES]
    some = silver.select(*[F.col(c).alias(f"_{c}") for c in prices]).where(
        " AND ".join(f"{ident(c)} IS NOT NULL" for c in prices)).distinct()
    inverse = [f"(1D / {ident('_' + c)})" for c in prices]
    p = some.selectExpr("*", *[f"{one} / ({' + '.join(inverse)}) AS _p{o}" for o, one in zip(OUTCOMES, inverse)])
    rates = p.selectExpr(*[ident("_" + c) for c in prices], f"{goal_rates_sql(*[f'_p{o}' for o in OUTCOMES])} AS _rates")
    rates = rates.selectExpr("*", f"{outcome_probabilities_sql('_rates.home', '_rates.away')} AS _fit")
    rates = rates.selectExpr(*[ident("_" + c) for c in prices], "_rates.home AS goals_home", "_rates.away AS goals_away",
                             "_fit.home AS fit_home", "_fit.draw AS fit_draw", "_fit.away AS fit_away")
    same = [silver[c] == rates[f"_{c}"] for c in prices]
    return silver.join(rates, same, "left").drop(*[f"_{c}" for c in prices])


def over_under(silver: DataFrame, house: str = "Avg", line: float = 2.5) -> DataFrame:
    """``fit_goal_rates`` with the over/under market beside it: ``p_over`` and ``fair_over``,
    ``fair_under`` (prices) of the fitted rates, ``market_over`` (margin-free, from the house's two
    prices) and ``over_gap``, theirs less the market's."""
    fitted = fit_goal_rates(silver)
    market, margin = two_way(F.col(f"{house}O25"), F.col(f"{house}U25"))
    out = fitted.withColumn("p_over", F.expr(over_sql("goals_home", "goals_away", line)))
    return out.withColumns({
        "fair_over": F.try_divide(F.lit(1.0), F.col("p_over")),
        "fair_under": F.try_divide(F.lit(1.0), 1 - F.col("p_over")),
        "market_over": market, "totals_margin": margin, "over_gap": F.col("p_over") - market,
    })
