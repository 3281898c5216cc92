"""Analytical reports over the silver table.

All reports are single-pass aggregates: a partial (map-side) aggregate per
input partition, one small exchange of at most (#groups x #partitions) rows,
a final aggregate.  The source's shapes -- a self-join against per-group
totals, a scalar subquery for the grand total, six ``UNION ALL`` branches
each rescanning the table -- are rewritten here as conditional aggregates
and one wide aggregate, which removes every join and all but one scan.
A group holding a third of all rows costs nothing extra: it is pre-aggregated
inside each map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import as_text, percent
from ..functions.quotes import ident, sql_string
from ..schema import (
    CONSENSUS_PREFIX,
    HOUSES,
    OUTCOME_WORDS,
    OUTCOMES,
    PICK_COLUMN,
    REALISED_COLUMN,
    present_houses,
    quote_column,
)

SEASON_START_MONTH = 7   # a season runs July to June, labelled by its start year


def season_of(date: str | Column = "DateMatch") -> Column:
    """Season start year of a match date (July-June seasons)."""
    d = F.col(date) if isinstance(date, str) else date
    return F.when(F.month(d) >= SEASON_START_MONTH, F.year(d)).otherwise(F.year(d) - 1)


GROUPINGS = {
    "league": lambda: F.col("League").alias("league"),
    "month": lambda: F.month("DateMatch").alias("month"),
    "season": lambda: season_of().alias("season"),
}


def _sorted_report(out: DataFrame, value: str, bounded: bool) -> DataFrame:
    """Order a report by ``value`` descending.

    A report holds one row per group.  For the bounded groupings (leagues,
    calendar months, seasons) those few rows are moved to one partition and sorted
    there -- a shuffle of a handful of rows -- instead of a range sort, which
    would first run a sampling job over the result.  Other groupings keep the
    distributed range sort.
    """
    order = F.col(value).desc_nulls_last()
    if bounded:
        return out.repartition(1).sortWithinPartitions(order)
    return out.orderBy(order)


def _key(by: str | Column | None) -> list[Column]:
    if by is None:
        return []
    if isinstance(by, str):
        return [GROUPINGS[by]() if by in GROUPINGS else F.col(by)]
    return [by]


def hit_rate(
    silver: DataFrame,
    by: str | Column | None = None,
    weighted: bool = False,
    formatted: bool = False,
    drop_empty: bool = False,
    share_of_total: bool = False,
    result: str = "FTR",
) -> DataFrame:
    """How often the bookmakers' favourite won.

    * absolute (``weighted=False``): ``100 * #(result = pick) / #matches`` --
      every match counts in the denominator, a null result is never a hit.
      Column ``hit_pct``.
    * weighted: mean of the probability given to the actual result, over the
      matches where that probability is known.  Column ``weighted_pct``.

    ``by``: ``None`` (overall), ``"league"``, ``"month"`` (calendar month of
    the match date, year ignored -- seasons merge), ``"season"`` (July-June
    season, the year-aware split) or any column.  Groups without a single hit
    are kept with 0 unless ``drop_empty`` (which also drops a null group key,
    as an inner join on the key would).  ``share_of_total`` adds
    ``share_pct`` = group hits as a percent of all matches.  Rows are sorted
    by the numeric rate, descending; ``formatted`` turns rates into text last.
    """
    if weighted and (drop_empty or share_of_total):
        raise ValueError("drop_empty and share_of_total count hits: they go with the absolute rate only")
    keys = _key(by)
    bounded = isinstance(by, str) and by in GROUPINGS
    if weighted:
        p = F.col(REALISED_COLUMN).cast("double")
        aggs = [F.try_divide(F.sum(p), F.count(p)).alias("weighted_pct")]
        value = "weighted_pct"
    else:
        hit = F.col(result) == F.col(PICK_COLUMN)
        aggs = [F.count(F.lit(1)).alias("_matches"), F.count_if(hit).alias("_hits")]
        value = "hit_pct"
    out = silver.groupBy(*keys).agg(*aggs) if keys else silver.agg(*aggs)
    if not weighted:
        out = out.withColumn(value, percent(F.col("_hits"), F.col("_matches")))
        if share_of_total:
            # The denominator is every match, so it is taken before any group
            # is dropped below.
            if bounded or not keys:
                # One row per league / month / season: an unpartitioned window
                # over the grouped rows is a shuffle of a handful of rows.
                everyone = F.sum("_matches").over(Window.partitionBy())
            else:
                # Arbitrary groupings may be many: the grand total comes from an
                # uncorrelated scalar subquery instead (no join, no funnel).
                everyone = silver.agg(F.count(F.lit(1))).scalar()
            out = out.withColumn("share_pct", percent(F.col("_hits"), everyone))
        if drop_empty:
            out = out.where(F.col("_hits") > 0)
            if keys:
                out = out.where(F.col(out.columns[0]).isNotNull())
    key_names = [out.columns[0]] if keys else []
    extra = ["share_pct"] if share_of_total else []
    out = out.select(*key_names, value, *extra)
    if keys:
        out = _sorted_report(out, value, bounded=bounded)
    if formatted:
        out = out.select(*key_names, *[as_text(c).alias(c) for c in [value, *extra]])
    return out


def hit_rate_levels(
    silver: DataFrame, levels: Sequence[str] = ("league", "month"), result: str = "FTR"
) -> DataFrame:
    """Overall and per-level hit rates, absolute and weighted, in ONE scan.

    The source answers each level with its own query (and table scan); here
    the table is aggregated once to the combinations of the levels, and
    ``GROUPING SETS`` roll up those few rows.  Columns: ``level``
    (``'overall'`` or the level name), one key column per level (null on
    other levels), ``matches``, ``hits``, ``hit_pct``, ``weighted_pct``.
    """
    # Keys are projected first and grouped by name: grouping sets over
    # aliased expressions would be treated as extra grouping columns.
    keyed = silver.select(*[GROUPINGS[name]() for name in levels],
                          F.col(result), F.col(PICK_COLUMN), F.col(REALISED_COLUMN))
    hit = F.col(result) == F.col(PICK_COLUMN)
    p = F.col(REALISED_COLUMN).cast("double")
    combined = keyed.groupBy(*levels).agg(
        F.count(F.lit(1)).alias("_matches"), F.count_if(hit).alias("_hits"),
        F.sum(p).alias("_sum"), F.count(p).alias("_known"))
    grouped = combined.groupingSets([[name] for name in levels] + [[]], *levels).agg(
        F.grouping_id().alias("_gid"),
        F.coalesce(F.sum("_matches"), F.lit(0)).alias("matches"),
        F.coalesce(F.sum("_hits"), F.lit(0)).alias("hits"),
        F.try_divide(F.sum("_sum"), F.sum("_known")).alias("weighted_pct"),
    )
    full = (1 << len(levels)) - 1          # grouping_id of the overall row
    level = F.when(F.col("_gid") == full, F.lit("overall"))
    for i, name in enumerate(levels):
        level = level.when(F.col("_gid") == full - (1 << (len(levels) - 1 - i)), F.lit(name))
    out = grouped.select(
        level.alias("level"), *list(levels), "matches", "hits",
        percent(F.col("hits"), F.col("matches")).alias("hit_pct"), "weighted_pct",
    )
    # A handful of rows (one per league / month plus one): sort in one partition.
    return out.repartition(1).sortWithinPartitions("level", F.col("hit_pct").desc_nulls_last())


def house_dispersion(
    silver: DataFrame, houses: Sequence[tuple[str, str]] = HOUSES, digits: int = 3
) -> DataFrame:
    """Sample standard deviation of each house's quote minus the consensus.

    One aggregate computes all ``len(houses) x 3`` deviations in a single scan
    (the source ran one full scan per house under ``UNION ALL``); the one-row
    result is then turned into one row per house with ``inline``.  Columns:
    ``house, sd_home, sd_draw, sd_away``; houses without quote columns in
    ``silver`` are left out.
    """
    have = set(present_houses(silver.columns, [code for code, _ in houses]))
    houses = [(code, name) for code, name in houses if code in have]
    # The 3 x len(houses) expressions are handed over as SQL text: one parse on
    # the JVM instead of several hundred Python -> JVM Column calls.
    aggs = [
        F.expr(f"round(stddev_samp({ident(quote_column(code, o))} - {ident(CONSENSUS_PREFIX + o)}), {int(digits)})")
        .alias(f"{code}_{o}")
        for code, _ in houses
        for o in OUTCOMES
    ]
    rows = ", ".join(
        "struct({name} AS house, {cols})".format(
            name=sql_string(name),
            cols=", ".join(f"{ident(code + '_' + o)} AS sd_{OUTCOME_WORDS[o]}" for o in OUTCOMES),
        )
        for code, name in houses
    )
    return silver.agg(*aggs).selectExpr(f"inline(array({rows}))")


def outcome_share(
    silver: DataFrame, column: str = "HTR", formatted: bool = False
) -> DataFrame:
    """Percent of matches ending H / D / A in ``column`` (``HTR`` half time,
    as in the source query, or ``FTR`` full time).  The denominator is every
    match, so null results make the shares sum below 100; an empty input
    gives nulls, not a division error.  Columns ``home_pct, draw_pct, away_pct``.
    """
    c = F.col(column)
    total = F.count(F.lit(1)).cast("double")
    aggs = [
        (F.try_divide(F.count_if(c == F.lit(o)).cast("double"), total) * F.lit(100.0))
        .alias(f"{OUTCOME_WORDS[o]}_pct")
        for o in OUTCOMES
    ]
    out = silver.agg(*aggs)
    if formatted:
        out = out.select(*[as_text(x).alias(x) for x in out.columns])
    return out


def match_lookup(
    silver: DataFrame,
    home: str,
    away: str,
    columns: Sequence[str] = ("HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR",
                              "MediaH", "MediaD", "MediaA"),
) -> DataFrame:
    """Score, result and consensus quotes of a fixture (both equality
    predicates reach the parquet scan as pushed filters)."""
    return (silver.where((F.col("HomeTeam") == F.lit(home)) & (F.col("AwayTeam") == F.lit(away)))
                  .select(*columns))


def favourite_summary(silver: DataFrame, by: str | Column | None = None) -> DataFrame:
    """Absolute and weighted hit rates side by side in one aggregate pass."""
    keys = _key(by)
    hit = F.col("FTR") == F.col(PICK_COLUMN)
    p = F.col(REALISED_COLUMN).cast("double")
    aggs = [
        F.count(F.lit(1)).alias("matches"),
        F.count_if(hit).alias("hits"),
        percent(F.count_if(hit), F.count(F.lit(1))).alias("hit_pct"),
        F.try_divide(F.sum(p), F.count(p)).alias("weighted_pct"),
    ]
    return silver.groupBy(*keys).agg(*aggs) if keys else silver.agg(*aggs)
