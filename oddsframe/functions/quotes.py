"""Row-wise quote expressions (JVM-side, no UDFs).

Each formula exists as a SQL-expression composer (``*_sql``, taking SQL
expression text for its inputs) and as a ``Column`` builder taking column
names.  Composing text and parsing once per output column keeps building a
wide enrichment cheap: the Column API would make several hundred Python ->
JVM calls for the same tree.  All literals are typed explicitly (``0D``,
``100D`` are DOUBLE) so the result types match the DataFrame-API spelling
exactly.  Houses are data (``houses=`` arguments), so an arbitrary number of
bookmakers works without code changes.  None of the expressions introduces
an exchange; all stay inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import HOUSE_CODES, quote_column


def ident(name: str) -> str:
    """A column name as a quoted SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def sql_string(text: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _quotes(outcome: str, houses: Sequence[str]) -> list[str]:
    return [ident(quote_column(h, outcome)) for h in houses]


# --- SQL composers ----------------------------------------------------------

def best_quote_sql(outcome: str, houses: Sequence[str] = HOUSE_CODES) -> str:
    qs = _quotes(outcome, houses)
    return qs[0] if len(qs) == 1 else f"greatest({', '.join(qs)})"


def consensus_sql(outcome: str, houses: Sequence[str] = HOUSE_CODES, digits: int = 2) -> str:
    qs = _quotes(outcome, houses)
    total = " + ".join(f"coalesce({q}, 0D)" for q in qs)
    quoting = " + ".join(f"CAST({q} IS NOT NULL AS INT)" for q in qs)
    return f"round(try_divide({total}, {quoting}), {int(digits)})"


def strict_mean_sql(outcome: str, houses: Sequence[str] = HOUSE_CODES, digits: int = 2) -> str:
    qs = _quotes(outcome, houses)
    return f"round(({' + '.join(qs)}) / {float(len(qs))}D, {int(digits)})"


def favourite_sql(home: str, draw: str, away: str, fallback: str | None = "A") -> str:
    other = sql_string(fallback) if fallback is not None else "CAST(NULL AS STRING)"
    return (f"CASE WHEN {home} < {draw} AND {home} < {away} THEN 'H' "
            f"WHEN {draw} < {home} AND {draw} < {away} THEN 'D' ELSE {other} END")


def implied_sql(quote: str) -> str:
    return f"CAST(try_divide(1D, {quote}) * 100D AS FLOAT)"


def normalised_sql(raw: str, raw_home: str, raw_draw: str, raw_away: str) -> str:
    denominator = f"CAST({raw_home} + {raw_draw} + {raw_away} AS DOUBLE)"
    return f"CAST(try_divide(CAST({raw} AS DOUBLE) * 100D, {denominator}) AS FLOAT)"


def overround_sql(raw_home: str, raw_draw: str, raw_away: str) -> str:
    return f"CAST({raw_home} AS DOUBLE) + CAST({raw_draw} AS DOUBLE) + CAST({raw_away} AS DOUBLE) - 100D"


def realised_sql(result: str, p_home: str, p_draw: str, p_away: str) -> str:
    return (f"CASE WHEN {result} = 'H' THEN {p_home} WHEN {result} = 'D' THEN {p_draw} "
            f"WHEN {result} = 'A' THEN {p_away} ELSE CAST(0 AS FLOAT) END")


def differs_sql(computed: str, supplied: str, tolerance: float = 0.005) -> str:
    return f"abs({computed} - {supplied}) > {float(tolerance)!r}D"


# --- Column builders (inputs are column names) ------------------------------

def quotes_for(outcome: str, houses: Sequence[str] = HOUSE_CODES) -> list[Column]:
    return [F.col(quote_column(h, outcome)) for h in houses]


def best_quote(outcome: str, houses: Sequence[str] = HOUSE_CODES) -> Column:
    """Highest quote any house offers for ``outcome``.

    ``GREATEST`` skips nulls; the result is null only when no house quoted.
    """
    return F.expr(best_quote_sql(outcome, houses))


def consensus_quote(outcome: str, houses: Sequence[str] = HOUSE_CODES, digits: int = 2) -> Column:
    """Mean quote over the houses that quoted, rounded (HALF_UP) to ``digits``.

    Unquoted houses neither add to the sum nor to the divisor; a match no house
    quoted has a null consensus (``try_divide`` instead of a 0/0 error).
    """
    return F.expr(consensus_sql(outcome, houses, digits))


def strict_mean_quote(outcome: str, houses: Sequence[str] = HOUSE_CODES, digits: int = 2) -> Column:
    """Plain ``(q1 + ... + qn) / n``: null as soon as one house is missing.

    This is the audit-style mean used to check the supplied market average; it
    uses the quotes of ``outcome`` for every house (one hand-written audit of
    the away mean once mixed in a home quote; that slip is not reproduced).
    """
    return F.expr(strict_mean_sql(outcome, houses, digits))


def favourite(home: str, draw: str, away: str, fallback: str | None = "A") -> Column:
    """Outcome with the strictly lowest consensus quote (columns by name).

    Home wins when strictly below draw and away, then draw likewise; every
    other case (away lowest, a tie for lowest, or missing quotes) yields
    ``fallback`` -- ``'A'`` by default, as in the source analysis.
    """
    return F.expr(favourite_sql(ident(home), ident(draw), ident(away), fallback))


def implied_probability(quote: str) -> Column:
    """Raw implied probability in percent, ``(1 / quote) * 100``, as FLOAT."""
    return F.expr(implied_sql(ident(quote)))


def normalised_probability(raw: str, raw_home: str, raw_draw: str, raw_away: str) -> Column:
    """Margin-free probability in percent: ``raw * 100 / (h + d + a)``, FLOAT.

    Inputs are the FLOAT raw probabilities.  They are added in FLOAT, as stored
    FLOAT columns are; the division is done in DOUBLE (what ANSI promotion makes
    of FLOAT times INT) and narrowed once at the end, whatever the ANSI setting.
    """
    return F.expr(normalised_sql(ident(raw), ident(raw_home), ident(raw_draw), ident(raw_away)))


def overround(raw_home: str, raw_draw: str, raw_away: str) -> Column:
    """Bookmaker margin in percentage points: ``h + d + a - 100`` (DOUBLE)."""
    return F.expr(overround_sql(ident(raw_home), ident(raw_draw), ident(raw_away)))


def realised_probability(result: str, p_home: str, p_draw: str, p_away: str) -> Column:
    """Probability the consensus gave to the result that happened (FLOAT).

    A null or unknown result maps to 0 (and therefore still counts in a
    weighted average); a known result with no probability stays null.
    """
    return F.expr(realised_sql(ident(result), ident(p_home), ident(p_draw), ident(p_away)))


def differs(computed: str, supplied: str, tolerance: float = 0.005) -> Column:
    """True when two quote columns differ by more than ``tolerance``; null if either is."""
    return F.expr(differs_sql(ident(computed), ident(supplied), tolerance))
