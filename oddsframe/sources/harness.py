"""A deterministic match table derived from the provided ``orders`` table.

The provided test data has no football table, so ``orders`` stands in: one
order is one match; its five priorities are five leagues and its three
statuses three full-time results.  Every other column follows from the order
key ``k`` by fixed arithmetic rules, so the table grows with ``orders`` and
is identical at every run.

Each rule is one SQL expression that both Spark and DuckDB accept (one
column, kick-off, needs an engine-specific spelling).  Spark evaluates them
with ``selectExpr`` -- one parse on the JVM instead of thousands of Python
Column calls -- and the oracle embeds the same text in a CTE.  The library
operators under test (enrichment, reports) are *not* written this way; they
are DataFrame-API code compared against independent SQL.

Quotes sit on a 4-cent grid with five or six quoting houses, which makes a
rounding tie in the two-decimal consensus impossible, so both engines round
identically.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import HOUSE_CODES, OUTCOMES, quote_column

# Harness-only conventions (our own choice, not source data).
PRIORITY_LEAGUE = {
    "1-URGENT": "E0",
    "2-HIGH": "I1",
    "3-MEDIUM": "SP1",
    "4-NOT SPECIFIED": "D1",
    "5-LOW": "F1",
}
STATUS_RESULT = {"F": "H", "O": "D", "P": "A"}
STAT_MODULI = {
    "HS": 25, "ASS": 25, "HST": 12, "AST": 12, "HC": 14, "AC": 14,
    "HF": 22, "AF": 22, "HY": 6, "AY": 6, "HR": 2, "AR": 2,
}
MARKET_HOUSES = ("B365", "P", "Max", "Avg")
HANDICAP_SIDES = ("AHH", "AHA")
TOTALS_SIDES = ("O25", "U25")
PUBLISHED_BUMP = "0.04"      # supplied Max/Avg exceed ours by this on even keys
UNQUOTED_EVERY = 101         # k % 101 = 0: no house quotes the match
HOUSE_GAP_EVERY = 11         # (k + i) % 11 = 0: house i skips the match
RESULT_GAP_EVERY = 97        # k % 97 = 0: full-time result missing
K = "o_orderkey"


@dataclass(frozen=True)
class _Rule:
    name: str
    sql: str                      # accepted by both engines
    spark_sql: str | None = None  # Spark spelling where the dialects differ

    def spark(self) -> str:
        return f"{self.spark_sql or self.sql} AS {self.name}"

    def duck(self) -> str:
        return f"{self.sql} AS {self.name}"


def _case_map(col: str, mapping: dict[str, str]) -> str:
    arms = " ".join(f"WHEN {col} = '{src}' THEN '{dst}'" for src, dst in mapping.items())
    return f"CASE {arms} END"


_FTR = (f"CASE WHEN {K} % {RESULT_GAP_EVERY} = 0 THEN CAST(NULL AS STRING) "
        f"ELSE {_case_map('o_orderstatus', STATUS_RESULT)} END")
_HTR = f"CASE {K} % 3 WHEN 0 THEN 'H' WHEN 1 THEN 'D' ELSE 'A' END"


def _goals(home: bool, half: bool) -> _Rule:
    """Winner scores more, a draw is level; a null result has null goals."""
    if half:
        result, win, level, lose = _HTR, f"1 + {K} % 2", f"{K} % 2", "0"
    else:
        result, win, level, lose = _FTR, f"1 + {K} % 3 + {K} % 2", f"{K} % 4", f"{K} % 2"
    h_side, a_side = ("H", "A") if home else ("A", "H")
    sql = (f"CAST(CASE WHEN ({result}) = '{h_side}' THEN {win} WHEN ({result}) = 'D' THEN {level} "
           f"WHEN ({result}) = '{a_side}' THEN {lose} END AS INTEGER)")
    return _Rule(("HT" if half else "FT") + ("HG" if home else "AG"), sql)


def _quote(i: int, j: int) -> _Rule:
    sql = (f"CASE WHEN ({K} + {i}) % {HOUSE_GAP_EVERY} = 0 OR {K} % {UNQUOTED_EVERY} = 0 "
           f"THEN CAST(NULL AS DOUBLE) ELSE CAST(112 + ({K} * {37 + 8 * j} + {13 * i + 29 * j} "
           f"+ ({K} % 7) * {i}) % 100 * 4 AS DOUBLE) / 100 END")
    return _Rule(quote_column(HOUSE_CODES[i], OUTCOMES[j]), sql)


def _market(name: str, base: int, step: int, mult: int, span: int, h: int, a: int) -> _Rule:
    sql = (f"CASE WHEN {K} % {UNQUOTED_EVERY} = 0 THEN CAST(NULL AS DOUBLE) "
           f"ELSE CAST({base} + ({K} * {mult + 2 * a} + {step * h}) % {span} AS DOUBLE) / 100 END")
    return _Rule(name, sql)


_DAY = "CAST(o_orderdate AS DATE)"
_HOUR = f"CAST(12 + {K} % 10 AS INTEGER)"
_MINUTE = f"CAST(({K} % 4) * 15 AS INTEGER)"


def _base_rules() -> list[_Rule]:
    rules = [
        _Rule("MatchId", K),
        _Rule("League", _case_map("o_orderpriority", PRIORITY_LEAGUE)),
        _Rule("DateMatch", _DAY),
        _Rule("TimeMatch",
              f"make_timestamp(year({_DAY}), month({_DAY}), day({_DAY}), {_HOUR}, {_MINUTE}, 0)",
              f"make_timestamp_ntz(year({_DAY}), month({_DAY}), day({_DAY}), {_HOUR}, {_MINUTE}, 0)"),
        _Rule("HomeTeam", "'T' || CAST(o_custkey % 20 AS STRING)"),
        _Rule("AwayTeam", "'T' || CAST((o_custkey + 7) % 20 AS STRING)"),
        _goals(home=True, half=False),
        _goals(home=False, half=False),
        _Rule("FTR", _FTR),
        _goals(home=True, half=True),
        _goals(home=False, half=True),
        _Rule("HTR", _HTR),
    ]
    rules += [_Rule(name, f"CAST(({K} * {s + 3} + {7 * s}) % {m} AS INTEGER)")
              for s, (name, m) in enumerate(STAT_MODULI.items())]
    rules += [_quote(i, j) for i in range(len(HOUSE_CODES)) for j in range(len(OUTCOMES))]
    return rules


def _market_rules() -> list[_Rule]:
    rules = [_Rule("AHh", f"CAST({K} % 9 - 4 AS DOUBLE) * 0.25")]
    rules += [_market(f"{house}{side}", 170, 5, 11, 60, h, a)
              for h, house in enumerate(MARKET_HOUSES) for a, side in enumerate(HANDICAP_SIDES)]
    rules += [_market(f"{house}{side}", 140, 3, 13, 90, h, a)
              for h, house in enumerate(MARKET_HOUSES) for a, side in enumerate(TOTALS_SIDES)]
    return rules


def _supplied() -> list[str]:
    """Published market max / average: our best / consensus, bumped on even keys."""
    bump = f"(CASE WHEN _k % 2 = 0 THEN {PUBLISHED_BUMP} ELSE 0.0 END)"
    maxes, means = [], []
    for o in OUTCOMES:
        qs = [quote_column(h, o) for h in HOUSE_CODES]
        total = " + ".join(f"COALESCE({q}, 0.0)" for q in qs)
        quoting = " + ".join(f"(CASE WHEN {q} IS NOT NULL THEN 1 ELSE 0 END)" for q in qs)
        maxes.append(f"GREATEST({', '.join(qs)}) + {bump} AS Max{o}")
        means.append(f"ROUND(({total}) / NULLIF({quoting}, 0), 2) + {bump} AS Avg{o}")
    return maxes + means


def harness_columns() -> list[str]:
    return ([r.name for r in _base_rules()] + [f"{p}{o}" for p in ("Max", "Avg") for o in OUTCOMES]
            + [r.name for r in _market_rules()])


def _outer_select() -> list[str]:
    return [r.name for r in _base_rules()] + _supplied() + [r.name for r in _market_rules()]


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-layout match table (league codes, not names) over ``orders``.

    Two projections over one parquet scan: only the four ``orders`` columns
    used are read, and the whole table stays in one codegen stage.
    """
    orders = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    rules = _base_rules() + _market_rules()
    return (orders.selectExpr(*[r.spark() for r in rules], f"{K} AS _k")
                  .selectExpr(*_outer_select()))


def matches_sql() -> str:
    """The same table as a DuckDB ``SELECT`` over ``orders``."""
    rules = _base_rules() + _market_rules()
    inner = "SELECT " + ",\n  ".join(r.duck() for r in rules) + f",\n  {K} AS _k\nFROM orders"
    return f"SELECT {', '.join(_outer_select())}\nFROM (\n{inner}\n) AS h"


def referee_sql(key: str = "MatchId") -> str:
    """Extra column carried only by the EN export file (schema drift)."""
    return f"'Ref' || CAST({key} % 13 AS STRING)"


__all__ = ["matches", "matches_sql", "harness_columns", "referee_sql", "PRIORITY_LEAGUE"]
