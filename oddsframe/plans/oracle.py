"""SQL text for the DuckDB oracle: the layers' column formulas and, per report,
the definition of the figure."""

from __future__ import annotations

from ..schema import (
    HOUSE_CODES,
    HOUSES,
    LEAGUE_NAMES,
    OUTCOMES,
    quote_column,
)
from ..sources.harness import matches_sql


def _league_case(col: str = "League") -> str:
    arms = " ".join(f"WHEN {col} = '{code}' THEN '{name}'" for code, name in LEAGUE_NAMES.items())
    return f"CASE {arms} ELSE {col} END"


def _silver_ctes() -> str:
    best = ", ".join(
        f"GREATEST({', '.join(quote_column(h, o) for h in HOUSE_CODES)}) AS MaiorValor{o}"
        for o in OUTCOMES
    )
    means = []
    for o in OUTCOMES:
        qs = [quote_column(h, o) for h in HOUSE_CODES]
        total = " + ".join(f"COALESCE({q}, 0.0)" for q in qs)
        quoting = " + ".join(f"CASE WHEN {q} IS NOT NULL THEN 1 ELSE 0 END" for q in qs)
        means.append(f"ROUND(({total}) / NULLIF({quoting}, 0), 2) AS Media{o}")
    raw = ", ".join(f"CAST((1.0 / Media{o}) * 100 AS FLOAT) AS PercentAbsol{o}" for o in OUTCOMES)
    denominator = "CAST(" + " + ".join(f"PercentAbsol{o}" for o in OUTCOMES) + " AS DOUBLE)"
    norm = ", ".join(
        f"CAST(CAST(PercentAbsol{o} AS DOUBLE) * 100 / ({denominator}) AS FLOAT) AS Percent{o}"
        for o in OUTCOMES
    )
    return f"""matches AS (
{matches_sql()}
),
bronze AS (
  SELECT * REPLACE ({_league_case()} AS League) FROM matches
),
s1 AS (SELECT *, {best}, {', '.join(means)} FROM bronze),
s2 AS (
  SELECT *,
    CASE WHEN MediaH < MediaD AND MediaH < MediaA THEN 'H'
         WHEN MediaD < MediaH AND MediaD < MediaA THEN 'D'
         ELSE 'A' END AS VencedorAposta,
    {raw}
  FROM s1
),
s3 AS (SELECT *, {norm} FROM s2),
silver AS (
  SELECT *,
    CASE WHEN FTR = 'H' THEN PercentH WHEN FTR = 'D' THEN PercentD
         WHEN FTR = 'A' THEN PercentA ELSE CAST(0 AS FLOAT) END AS Percentual
  FROM s3
)"""


def with_silver(body: str) -> str:
    """``body`` prefixed with the matches -> bronze -> silver CTE chain."""
    return f"WITH {_silver_ctes()}\n{body}"


def dispersion_sql() -> str:
    """One row per house and match, grouped by house."""
    rows = ", ".join(
        "{" + ", ".join([f"'house': '{name}'", *[f"'{o}': {code}{o} - Media{o}" for o in OUTCOMES]]) + "}"
        for code, name in HOUSES)
    spread = ", ".join(f"ROUND(STDDEV_SAMP(d.{o}), 3) AS sd_{w}" for o, w in zip(OUTCOMES, ("home", "draw", "away")))
    return f"SELECT d.house AS house, {spread} FROM (SELECT unnest([{rows}]) AS d FROM silver) GROUP BY d.house"


def fmt2(expr: str) -> str:
    """DuckDB counterpart of ``format_number(x, 2)``."""
    return f"format('{{:,.2f}}', {expr})"
