"""Registered queries: engine side (DataFrame API) and oracle side (SQL).

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built by the library on
the match table derived from ``sf_dir``'s ``orders``; ``ORACLE[name]`` is SQL
DuckDB runs on the same parquet tables.  Output column names and types agree
one to one (rates DOUBLE, counts BIGINT, months INT, probabilities FLOAT).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.analysis import (
    favourite_summary,
    hit_rate,
    hit_rate_levels,
    house_dispersion,
    match_lookup,
    outcome_share,
)
from ..operators.enrich import MARGIN_COLUMN, add_margin, decode_league, enrich, silver_columns
from ..operators.markets import MARKET_HOUSES, RESULTS, handicap_ladder, handicap_report, over_under, settle_handicap
from ..operators.quality import max_reconcile, mean_reconcile, mismatch_counts
from ..operators.quality import dictionary_audit, schema_difference
from ..schema import DOCUMENTED, HOUSE_CODES, LEAGUE_NAMES, OUTCOMES, PICK_COLUMN, raw_name
from ..session import scratch_dir, unique_name
from ..sources import dictionary as dictionary_io
from ..sources import leagues as league_io
from ..sources import tables
from ..sources.harness import harness_columns, matches, referee_sql
from ..streaming import live
from .layers import build_bronze, build_silver
from .oracle import dispersion_sql, fmt2, with_silver

LOOKUP_HOME, LOOKUP_AWAY = "T3", "T10"

QueryFn = Callable[[SparkSession, str], DataFrame]


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze layer: the match table with league codes decoded."""
    return decode_league(matches(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver layer: bronze plus the fourteen enrichment columns (lazy)."""
    return enrich(bronze(spark, sf_dir))


def _per_match(columns: list[str]) -> QueryFn:
    return lambda spark, sf: silver(spark, sf).select("MatchId", *columns)


def _sql_per_match(columns: list[str]) -> str:
    return with_silver(f"SELECT MatchId, {', '.join(columns)} FROM silver")


QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def _register(name: str, fn: QueryFn, sql: str | None) -> None:
    QUERIES[name] = fn
    if sql is not None:
        ORACLE[name] = sql


# --- hit rates (D16-D21, D24) -------------------------------------------------

_register(
    "hit_rate_abs_league",
    lambda spark, sf: hit_rate(silver(spark, sf), by="league"),
    with_silver("""
SELECT League AS league, CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*) AS hit_pct
FROM silver GROUP BY League"""),
)

_register(
    "hit_rate_abs",
    lambda spark, sf: hit_rate(silver(spark, sf)),
    with_silver("""
SELECT CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*) AS hit_pct FROM silver"""),
)

_register(
    "hit_rate_abs_fmt",
    lambda spark, sf: hit_rate(silver(spark, sf), formatted=True),
    with_silver(f"""
SELECT {fmt2("CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*)")} AS hit_pct FROM silver"""),
)

_register(
    "hit_rate_weighted",
    lambda spark, sf: hit_rate(silver(spark, sf), weighted=True),
    with_silver("""
SELECT SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual) AS weighted_pct
FROM silver"""),
)

_register(
    "hit_rate_weighted_fmt",
    lambda spark, sf: hit_rate(silver(spark, sf), weighted=True, formatted=True),
    with_silver(f"""
SELECT {fmt2("SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual)")} AS weighted_pct
FROM silver"""),
)

_register(
    "hit_share_league",
    lambda spark, sf: hit_rate(silver(spark, sf), by="league", share_of_total=True),
    with_silver("""
SELECT League AS league, CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*) AS hit_pct,
       CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / SUM(COUNT(*)) OVER () AS share_pct
FROM silver GROUP BY League"""),
)

_register(
    "hit_rate_weighted_league",
    lambda spark, sf: hit_rate(silver(spark, sf), by="league", weighted=True),
    with_silver("""
SELECT League AS league, SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual) AS weighted_pct
FROM silver
GROUP BY League
ORDER BY weighted_pct DESC"""),
)

_register(
    "hit_rate_abs_month",
    lambda spark, sf: hit_rate(silver(spark, sf), by="month"),
    with_silver("""
SELECT CAST(MONTH(DateMatch) AS INTEGER) AS month, CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*) AS hit_pct
FROM silver GROUP BY MONTH(DateMatch)"""),
)

_register(
    "hit_rate_weighted_month",
    lambda spark, sf: hit_rate(silver(spark, sf), by="month", weighted=True),
    with_silver("""
SELECT CAST(MONTH(DateMatch) AS INTEGER) AS month,
       SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual) AS weighted_pct
FROM silver
GROUP BY MONTH(DateMatch)
ORDER BY weighted_pct DESC"""),
)

_register(
    "hit_rate_abs_league_fmt",
    lambda spark, sf: hit_rate(silver(spark, sf), by="league", formatted=True),
    with_silver(f"""
SELECT League AS league, {fmt2("CAST(COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS DOUBLE) * 100.0 / COUNT(*)")} AS hit_pct
FROM silver GROUP BY League"""),
)

_register(
    "hit_rate_date_nonempty",
    lambda spark, sf: hit_rate(silver(spark, sf), by="DateMatch", drop_empty=True, share_of_total=True),
    with_silver("""
SELECT DateMatch, CAST(hits AS DOUBLE) * 100.0 / matches AS hit_pct,
       CAST(hits AS DOUBLE) * 100.0 / SUM(matches) OVER () AS share_pct
FROM (SELECT DateMatch, COUNT(*) AS matches, COUNT(*) FILTER (WHERE FTR = VencedorAposta) AS hits
      FROM silver GROUP BY DateMatch)
QUALIFY hits > 0 AND DateMatch IS NOT NULL"""),
)

_register(
    "favourite_summary_league",
    lambda spark, sf: favourite_summary(silver(spark, sf), by="league"),
    with_silver("""
SELECT League AS league, COUNT(*) AS matches,
       CAST(SUM(CASE WHEN FTR = VencedorAposta THEN 1 ELSE 0 END) AS BIGINT) AS hits,
       CAST(SUM(CASE WHEN FTR = VencedorAposta THEN 1 ELSE 0 END) AS DOUBLE) * 100.0 / COUNT(*)
         AS hit_pct,
       SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual) AS weighted_pct
FROM silver
GROUP BY League"""),
)

_HITS = "SUM(CASE WHEN FTR = VencedorAposta THEN 1 ELSE 0 END)"
_LEVEL_COLUMNS = (f"COUNT(*) AS matches, CAST({_HITS} AS BIGINT) AS hits, "
                  f"CAST({_HITS} AS DOUBLE) * 100.0 / COUNT(*) AS hit_pct, "
                  "SUM(CAST(Percentual AS DOUBLE)) / COUNT(Percentual) AS weighted_pct")

_register(
    "hit_rate_all_levels",
    lambda spark, sf: hit_rate_levels(silver(spark, sf)),
    with_silver(f"""
SELECT 'overall' AS level, CAST(NULL AS VARCHAR) AS league, CAST(NULL AS INTEGER) AS month,
       {_LEVEL_COLUMNS}
FROM silver
UNION ALL
SELECT 'league' AS level, League AS league, CAST(NULL AS INTEGER) AS month, {_LEVEL_COLUMNS}
FROM silver GROUP BY League
UNION ALL
SELECT 'month' AS level, CAST(NULL AS VARCHAR) AS league, CAST(MONTH(DateMatch) AS INTEGER) AS month,
       {_LEVEL_COLUMNS}
FROM silver GROUP BY MONTH(DateMatch)"""),
)

# --- dispersion and outcome shares (D22, D23) ---------------------------------

_register(
    "house_dispersion",
    lambda spark, sf: house_dispersion(silver(spark, sf)),
    with_silver(dispersion_sql()),
)


def _share_sql(column: str) -> str:
    parts = ", ".join(
        f"(CAST(SUM(CASE WHEN {column} = '{o}' THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*)) * 100.0 AS {w}_pct"
        for o, w in zip(OUTCOMES, ("home", "draw", "away"))
    )
    return with_silver(f"SELECT {parts} FROM silver")


_register("outcome_share_half", lambda spark, sf: outcome_share(silver(spark, sf), "HTR"),
          _share_sql("HTR"))
_register("outcome_share_full", lambda spark, sf: outcome_share(silver(spark, sf), "FTR"),
          _share_sql("FTR"))

# --- match lookup (D15) -------------------------------------------------------

_register(
    "match_lookup",
    lambda spark, sf: match_lookup(silver(spark, sf), LOOKUP_HOME, LOOKUP_AWAY),
    with_silver(f"""
SELECT HomeTeam, AwayTeam, FTHG, FTAG, FTR, MediaH, MediaD, MediaA
FROM silver
WHERE HomeTeam = '{LOOKUP_HOME}' AND AwayTeam = '{LOOKUP_AWAY}'"""),
)

# --- per-match enrichment columns (D5, D6, D10-D14, C6, C8) ------------------

_PER_MATCH = {
    "best_quotes": [f"MaiorValor{o}" for o in OUTCOMES],
    "consensus_quotes": [f"Media{o}" for o in OUTCOMES],
    "favourite_pick": ["VencedorAposta"],
    "implied_raw": [f"PercentAbsol{o}" for o in OUTCOMES],
    "implied_normalised": [f"Percent{o}" for o in OUTCOMES],
    "realised_probability": ["Percentual"],
    "add_update_columns": silver_columns(),
}
for _name, _cols in _PER_MATCH.items():
    _register(_name, _per_match(_cols), _sql_per_match(_cols))

_register(
    "overround",
    lambda spark, sf: add_margin(silver(spark, sf)).select("MatchId", MARGIN_COLUMN),
    with_silver(
        "SELECT MatchId, CAST(PercentAbsolH AS DOUBLE) + CAST(PercentAbsolD AS DOUBLE)"
        f" + CAST(PercentAbsolA AS DOUBLE) - 100.0 AS {MARGIN_COLUMN} FROM silver"
    ),
)

# --- reconciliation audits (D7, D8, D9) ---------------------------------------


def _audit_sql(kind: str) -> str:
    cols = []
    for o in OUTCOMES:
        qs = [f"{h}{o}" for h in HOUSE_CODES]
        if kind == "max":
            computed = f"GREATEST({', '.join(qs)})"
            supplied = f"Max{o}"
        else:
            computed = f"ROUND(({' + '.join(qs)}) / {len(qs)}.0, 2)"
            supplied = f"Avg{o}"
        w = {"H": "home", "D": "draw", "A": "away"}[o]
        cols.append(f"{computed} AS computed_{w}")
        cols.append(f"{supplied} AS supplied_{w}")
        cols.append(f"ABS({computed} - {supplied}) > 0.005 AS differs_{w}")
    return with_silver(f"SELECT MatchId, {', '.join(cols)} FROM silver")


_register("max_reconcile", lambda spark, sf: max_reconcile(bronze(spark, sf)), _audit_sql("max"))
_register("strict_mean_audit", lambda spark, sf: mean_reconcile(bronze(spark, sf)), _audit_sql("mean"))


def _fixture(df: DataFrame) -> DataFrame:
    return df.where((F.col("HomeTeam") == LOOKUP_HOME) & (F.col("AwayTeam") == LOOKUP_AWAY))


_ONE_FIXTURE = f"\nWHERE HomeTeam = '{LOOKUP_HOME}' AND AwayTeam = '{LOOKUP_AWAY}'"
_register("fixture_max_reconcile", lambda spark, sf: max_reconcile(_fixture(bronze(spark, sf))),
          _audit_sql("max") + _ONE_FIXTURE)
_register("fixture_mean_reconcile", lambda spark, sf: mean_reconcile(_fixture(bronze(spark, sf))),
          _audit_sql("mean") + _ONE_FIXTURE)


def _mismatch_sql() -> str:
    parts = ["COUNT(*) AS matches"]
    for o, w in zip(OUTCOMES, ("home", "draw", "away")):
        qs = [f"{h}{o}" for h in HOUSE_CODES]
        best = f"GREATEST({', '.join(qs)})"
        mean = f"ROUND(({' + '.join(qs)}) / {len(qs)}.0, 2)"
        parts.append(f"CAST(SUM(CASE WHEN ABS({best} - Max{o}) > 0.005 THEN 1 ELSE 0 END) AS BIGINT)"
                     f" AS max_differs_{w}")
        parts.append(f"CAST(SUM(CASE WHEN ABS({mean} - Avg{o}) > 0.005 THEN 1 ELSE 0 END) AS BIGINT)"
                     f" AS avg_differs_{w}")
    return with_silver(f"SELECT {', '.join(parts)} FROM bronze")


_register("mismatch_counts", lambda spark, sf: mismatch_counts(bronze(spark, sf)), _mismatch_sql())

# --- league decode (D4, C7, F5) ----------------------------------------------

_register(
    "league_decode",
    lambda spark, sf: bronze(spark, sf).groupBy(F.col("League").alias("league"))
    .agg(F.count(F.lit(1)).alias("matches")),
    with_silver("SELECT League AS league, COUNT(*) AS matches FROM bronze GROUP BY League"),
)

# --- full layer scan (P5, E9) -------------------------------------------------

_register("layer_scan", lambda spark, sf: silver(spark, sf), with_silver("SELECT * FROM silver"))


# --- files and tables (S1-S5, K1-K3, C1-C5, D1-D3, P1-P3, U1, E6) ---------------
# These queries write derived data under the shared checkpoint folder (a new
# uniquely named folder / database per call) and return the read-back frame.

DRIFT_LEAGUE = "E0"   # the league file that carries an extra Referee column
MATCH_ID_TYPE = {"MatchId": T.LongType()}
_SQL_TYPES = {"STRING": "string", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
              "INT": "int", "DOUBLE": "double"}


def export_leagues(spark: SparkSession, sf_dir: str) -> list[str]:
    """Write the match table as raw per-league CSV folders; return them."""
    return league_io.league_folders(spark, export_folder(spark, sf_dir))


def export_folder(spark: SparkSession, sf_dir: str) -> str:
    """One folder with the CSV files of all leagues, one of which has an extra column."""
    out = scratch_dir(spark, "leagues")
    raw = league_io.to_raw_layout(matches(spark, sf_dir))
    drift = F.when(F.col("Div") == F.lit(DRIFT_LEAGUE), F.expr(referee_sql("MatchId")))
    # The drift league is written with the extra column, the rest without:
    # two partitioned writes, each a single distributed job.
    league_io.write_league_files(
        league_io.to_raw_layout(matches(spark, sf_dir), {"Referee": drift})
        .where(F.col("Div").eqNullSafe(F.lit(DRIFT_LEAGUE))), out, mode="append")
    league_io.write_league_files(raw.where(~F.col("Div").eqNullSafe(F.lit(DRIFT_LEAGUE))), out, mode="append")
    return out


def _league_of(folder: str) -> str:
    return folder.rstrip("/").rsplit("league=", 1)[-1]


def _csv_strings(spark: SparkSession, sf: str) -> DataFrame:
    folders = export_leagues(spark, sf)
    frames = [league_io.read_strings(spark, f) for f in folders]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    return union.select("MatchId", "Div", "Date", "Time", "HomeTeam", "AwayTeam",
                        "FTHG", "FTAG", "FTR", "HTR", "Referee")


_register(
    "csv_roundtrip_string",
    _csv_strings,
    with_silver(f"""
SELECT CAST(MatchId AS VARCHAR) AS MatchId, League AS Div,
       strftime(DateMatch, '%d-%m-%Y') AS Date, strftime(TimeMatch, '%H:%M') AS Time,
       HomeTeam, AwayTeam, CAST(FTHG AS VARCHAR) AS FTHG, CAST(FTAG AS VARCHAR) AS FTAG, FTR, HTR,
       CASE WHEN League = '{DRIFT_LEAGUE}' THEN {referee_sql("MatchId")} END AS Referee
FROM matches"""),
)


def _csv_typed(spark: SparkSession, sf: str) -> DataFrame:
    """Typed scan (S2) of every league file: one read per distinct header,
    raw column names kept, aligned by name."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for folder in export_leagues(spark, sf):
        groups.setdefault(tuple(league_io.header_of(spark, folder)), []).append(folder)
    frames = [league_io.read_typed(spark, paths, header, extra_types=MATCH_ID_TYPE)
              for header, paths in groups.items()]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    return union


def _csv_typed_sql() -> str:
    cols = []
    for name in harness_columns():
        raw = raw_name(name)
        if name == "DateMatch":
            cols.append("strftime(DateMatch, '%d-%m-%Y') AS \"Date\"")
        elif name == "TimeMatch":
            cols.append("strftime(TimeMatch, '%H:%M') AS \"Time\"")
        else:
            cols.append(f'{name} AS "{raw}"')
    cols.append(f"CASE WHEN League = '{DRIFT_LEAGUE}' THEN {referee_sql('MatchId')} END AS Referee")
    return with_silver(f"SELECT {', '.join(cols)} FROM matches")


_register("csv_roundtrip_typed", _csv_typed, _csv_typed_sql())


# Inference takes team names like "T3" for times of day: they are left to the typed scan.
INFERRED = ["MatchId", "Div", "FTHG", "FTAG", "FTR", "B365H", "AvgH", "Referee"]


def _csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """Inferred-type scan (S2): one read per distinct header, aligned by name."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for folder in export_leagues(spark, sf):
        groups.setdefault(tuple(league_io.header_of(spark, folder)), []).append(folder)
    frames = [league_io.read_typed(spark, paths, infer=True) for paths in groups.values()]
    union = frames[0]
    for f in frames[1:]:
        union = union.unionByName(f, allowMissingColumns=True)
    return union.select(*INFERRED)


_register(
    "csv_inferred",
    _csv_inferred,
    with_silver(f"""
SELECT CAST(MatchId AS INTEGER) AS MatchId, League AS Div, FTHG, FTAG, FTR, B365H, AvgH,
       CASE WHEN League = '{DRIFT_LEAGUE}' THEN {referee_sql("MatchId")} END AS Referee
FROM matches"""),
)


def _flat_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return league_io.ingest(spark, export_leagues(spark, sf), extra_types=MATCH_ID_TYPE)


_register("flat_ingest_union", _flat_ingest, with_silver("SELECT * FROM bronze"))


def _mixed_folder(spark: SparkSession, sf: str) -> DataFrame:
    return league_io.ingest(spark, [export_folder(spark, sf)], extra_types=MATCH_ID_TYPE)


_register("mixed_folder_ingest", _mixed_folder, with_silver("SELECT * FROM bronze"))


def _schema_difference(spark: SparkSession, sf: str) -> DataFrame:
    headers = {_league_of(f): league_io.header_of(spark, f) for f in export_leagues(spark, sf)}
    return schema_difference(spark, headers)


_register(
    "schema_difference",
    _schema_difference,
    with_silver(f"""
SELECT DISTINCT League AS source, 'Referee' AS column_name,
       CASE WHEN League = '{DRIFT_LEAGUE}' THEN 'extra' ELSE 'missing' END AS status
FROM matches"""),
)


def _fresh_database(spark: SparkSession, prefix: str) -> str:
    name = unique_name(prefix)
    tables.create_database(spark, name, scratch_dir(spark, f"{name}.db"))
    return name


def _table_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Create database, switch to it, drop-if-exists, write, read back.

    The database switch happens in a sibling session (same catalog, own
    current database), so the caller's session state is never touched.
    """
    db = _fresh_database(spark, "bronze")
    try:
        session = spark.newSession()
    except Exception:  # e.g. Spark Connect: switch and restore instead
        session = spark
    previous = session.catalog.currentDatabase()
    tables.use_database(session, db)
    try:
        tables.drop_table(session, "europa")
        tables.write_layer(bronze(session, sf), "europa")
    finally:
        tables.use_database(session, previous)
    return tables.read_layer(spark, f"{db}.europa")


_register("table_roundtrip", _table_roundtrip, with_silver("SELECT * FROM bronze"))


def _append_layer(spark: SparkSession, sf: str) -> DataFrame:
    """A silver table with a one-character pick, appended to in two writes."""
    table = f"{_fresh_database(spark, 'silver')}.europa"
    rows = silver(spark, sf)
    tables.create_layer(spark, table, rows, {PICK_COLUMN: "VARCHAR(1)"})
    first = F.col("League").eqNullSafe(F.lit(LEAGUE_NAMES[DRIFT_LEAGUE]))
    for part in (rows.where(first), rows.where(~first)):
        tables.write_layer(part, table, mode="append", comments={})
    return tables.read_layer(spark, table)


_register("append_layer", _append_layer, with_silver("SELECT * FROM silver"))


def _ctas(spark: SparkSession, sf: str) -> DataFrame:
    src = _fresh_database(spark, "bronze")
    dst = _fresh_database(spark, "silver")
    tables.write_layer(bronze(spark, sf), f"{src}.europa")
    tables.copy_layer(spark, f"{src}.europa", f"{dst}.europa")
    return tables.read_layer(spark, f"{dst}.europa")


_register("ctas_layer", _ctas, with_silver("SELECT * FROM bronze"))


def _describe(spark: SparkSession, sf: str) -> DataFrame:
    db = _fresh_database(spark, "bronze")
    tables.write_layer(bronze(spark, sf), f"{db}.europa")
    return tables.describe(spark, f"{db}.europa")


def _values(rows: list[tuple], names: str) -> str:
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return "TRUE" if v else "FALSE"
        return "'" + str(v).replace("'", "''") + "'"
    body = ",\n  ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES\n  {body}\n) AS t({names})"


_register(
    "describe_comments",
    _describe,
    "SELECT * FROM " + _values(
        [(n, _SQL_TYPES[t], c) for n, t, c in DOCUMENTED] + [("MatchId", "bigint", None)],
        "column_name, data_type, comment"),
)


def _layered_build(spark: SparkSession, sf: str) -> DataFrame:
    suffix = unique_name("x")
    build_bronze(spark, export_leagues(spark, sf), f"bronze_{suffix}.europa",
                 scratch_dir(spark, f"bronze_{suffix}.db"), extra_types=MATCH_ID_TYPE)
    return build_silver(spark, f"bronze_{suffix}.europa", f"silver_{suffix}.europa",
                        scratch_dir(spark, f"silver_{suffix}.db"))


_register("silver_layer_table", _layered_build, with_silver("SELECT * FROM silver"))


def _column_audit(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_dir(spark, "dictionary")
    dictionary_io.write_dictionary(spark, path)
    return dictionary_audit(bronze(spark, sf), dictionary_io.read_dictionary(spark, path))


def _column_audit_sql() -> str:
    meta = [(n, _SQL_TYPES[t], c, True, True) for n, t, c in DOCUMENTED]
    meta.append(("MatchId", "bigint", None, True, False))
    counts = ", ".join(f"COUNT({n}) AS {n}" for n, _, _, _, _ in meta)
    return with_silver(f"""
, counts AS (
  UNPIVOT (SELECT {counts} FROM bronze) ON COLUMNS(*) INTO NAME column_name VALUE non_null
)
SELECT t.column_name, t.data_type, t.description, t.in_table, t.documented,
       CAST(c.non_null AS BIGINT) AS non_null
FROM {_values(meta, "column_name, data_type, description, in_table, documented")}
JOIN counts c ON t.column_name = c.column_name""")


_register("column_audit", _column_audit, _column_audit_sql())


# --- two-way markets: Asian handicap, over/under --------------------------------

#: What a home bet that ends ``x`` goals ahead, line included, comes to.
_SETTLED = """CASE WHEN {x} >= 0.5 THEN 'won' WHEN {x} = 0.25 THEN 'half_won' WHEN {x} = 0 THEN 'push'
            WHEN {x} = -0.25 THEN 'half_lost' WHEN {x} <= -0.5 THEN 'lost' END"""
_PAID = """CASE {r} WHEN 'won' THEN {q} - 1 WHEN 'half_won' THEN ({q} - 1) / 2 WHEN 'push' THEN 0.0
            WHEN 'half_lost' THEN -0.5 WHEN 'lost' THEN -1.0 END"""
_COUNTED = ", ".join(f"CAST(COUNT(*) FILTER (WHERE result = '{r}') AS BIGINT) AS {r}" for r in RESULTS)

_register(
    "handicap_settled",
    lambda spark, sf: settle_handicap(bronze(spark, sf)).select(
        "MatchId", "ah_line", "ah_home", "ah_away", "ah_home_profit", "ah_away_profit", "ah_p_home", "ah_margin"),
    with_silver(f"""
SELECT MatchId, AHh AS ah_line, ah_home, ah_away, {_PAID.format(r="ah_home", q="AvgAHH")} AS ah_home_profit,
       {_PAID.format(r="ah_away", q="AvgAHA")} AS ah_away_profit,
       (1 / AvgAHH) / (1 / AvgAHH + 1 / AvgAHA) AS ah_p_home, (1 / AvgAHH + 1 / AvgAHA - 1) * 100 AS ah_margin
FROM (SELECT *, {_SETTLED.format(x="(FTHG - FTAG + AHh)")} AS ah_home,
             {_SETTLED.format(x="(FTAG - FTHG - AHh)")} AS ah_away FROM bronze) AS settled"""),
)

_register(
    "handicap_report_league",
    lambda spark, sf: handicap_report(bronze(spark, sf), by="League"),
    with_silver(f"""
SELECT house, League, side, COUNT(*) AS bets, {_COUNTED}, CAST(SUM(CAST(paid AS DECIMAL(18, 4))) AS DOUBLE) AS profit,
       CAST(SUM(CAST(paid AS DECIMAL(18, 4))) AS DOUBLE) * 100.0 / COUNT(*) AS yield_pct
FROM (SELECT *, {_PAID.format(r="result", q="quote")} AS paid FROM (
{" UNION ALL ".join(
    f"SELECT '{house}' AS house, League, '{side}' AS side, {house}{code} AS quote, {_SETTLED.format(x=gap)} AS result FROM bronze"
    for house in MARKET_HOUSES
    for side, code, gap in (("home", "AHH", "(FTHG - FTAG + AHh)"), ("away", "AHA", "(FTAG - FTHG - AHh)")))}
) AS told) AS bets WHERE quote IS NOT NULL AND result IS NOT NULL GROUP BY house, League, side"""),
)

_register(
    "handicap_ladder",
    lambda spark, sf: handicap_ladder(bronze(spark, sf)),
    with_silver(f"""
SELECT line, COUNT(*) AS matches, {_COUNTED} FROM (
  SELECT line, {_SETTLED.format(x="(FTHG - FTAG + line)")} AS result
  FROM bronze CROSS JOIN (SELECT CAST(k AS DOUBLE) / 4 AS line FROM range(-12, 13) AS r(k) UNION ALL SELECT NULL) AS lines
) AS told GROUP BY line"""),
)

#: Six decimals: the oracle solves for the rates by its own iteration over its own sums.
_FITTED = ("goals_home", "goals_away", "fit_home", "fit_draw", "fit_away", "p_over", "fair_over", "fair_under", "over_gap")
_POISSON = "list_transform(range(0, 80), lambda i: exp(-{r} + i * ln({r}) - lgamma(i + 1)))"

_register(
    "over_under_fitted",
    lambda spark, sf: over_under(silver(spark, sf)).select(
        "MatchId", *[F.round(c, 6).alias(c) for c in _FITTED], "market_over", "totals_margin"),
    with_silver(f"""
, prices AS (
  SELECT DISTINCT MediaH, MediaD, MediaA, 1 / MediaH + 1 / MediaD + 1 / MediaA AS book FROM silver WHERE MediaH IS NOT NULL
    AND MediaD IS NOT NULL AND MediaA IS NOT NULL
),
outcomes AS (SELECT MediaH, MediaD, MediaA, 1 / MediaH / book AS ph, 1 / MediaD / book AS pd, 1 / MediaA / book AS pa FROM prices),
fit AS (
  WITH RECURSIVE steps AS (
    SELECT *, 0 AS step, 1.4::DOUBLE AS l, 1.4::DOUBLE AS m FROM outcomes
    UNION ALL
    SELECT MediaH, MediaD, MediaA, ph, pd, pa, step + 1,
           l * exp(least(greatest(-((p - z) * m * (h - ph) + p * m * (z - pd)) / (l * m * (p * q - z * z)), -0.5), 0.5)),
           m * exp(least(greatest(-((z - q) * l * (h - ph) + z * l * (z - pd)) / (l * m * (p * q - z * z)), -0.5), 0.5))
    FROM (
      SELECT *, list_sum(list_transform(range(1, 81), lambda i: a[i] * b[i])) AS z,
             list_sum(list_transform(range(2, 81), lambda i: a[i] * b[i - 1])) AS p,
             list_sum(list_transform(range(2, 81), lambda i: a[i - 1] * b[i])) AS q,
             list_sum(list_transform(range(2, 81), lambda i: a[i] * list_sum(b[1:i - 1]))) AS h
      FROM (SELECT *, {_POISSON.format(r="l")} AS a, {_POISSON.format(r="m")} AS b FROM steps WHERE step < 24) AS goals
    ) AS gaps
  )
  SELECT MediaH, MediaD, MediaA, ph, pd, pa, l, m, 1 - exp(-l - m) * (1 + (l + m) + (l + m) * (l + m) / 2) AS over_p
  FROM steps WHERE step = 24
)
SELECT MatchId, round(l, 6) AS goals_home, round(m, 6) AS goals_away, round(ph, 6) AS fit_home, round(pd, 6) AS fit_draw,
       round(pa, 6) AS fit_away, round(over_p, 6) AS p_over, round(1 / over_p, 6) AS fair_over,
       round(1 / (1 - over_p), 6) AS fair_under, round(over_p - (1 / AvgO25) / (1 / AvgO25 + 1 / AvgU25), 6) AS over_gap,
       (1 / AvgO25) / (1 / AvgO25 + 1 / AvgU25) AS market_over, (1 / AvgO25 + 1 / AvgU25 - 1) * 100 AS totals_margin
FROM silver LEFT JOIN fit USING (MediaH, MediaD, MediaA)"""),
)


# --- streaming form (incremental silver, running reports) --------------------


def _landing(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """Match files landing in date order, each a range of dates; as many as the
    session's shuffle makes of the table's size."""
    landing = scratch_dir(spark, "landing")
    batch = matches(spark, sf)
    batch.repartitionByRange("DateMatch", "MatchId").write.parquet(landing)
    return landing, batch


def _streaming_hit_rates(spark: SparkSession, sf: str) -> DataFrame:
    landing, batch = _landing(spark, sf)
    streams = live.stream_session(spark)
    stream = live.match_stream(streams, landing, batch.schema, max_files_per_trigger=1)
    view = unique_name("live_hit_rates")
    live.running_view(live.running_hit_rates(live.silver_stream(stream)), view).awaitTermination()
    return streams.table(view).select("league", "hit_pct")


_register("streaming_hit_rate_league", _streaming_hit_rates, ORACLE["hit_rate_abs_league"])


def _streaming_silver(spark: SparkSession, sf: str) -> DataFrame:
    landing, batch = _landing(spark, sf)
    stream = live.match_stream(spark, landing, batch.schema, max_files_per_trigger=2)
    out = scratch_dir(spark, "live-silver")
    live.append_silver(live.silver_stream(stream), out).awaitTermination()
    return spark.read.parquet(out)


_register("streaming_silver_append", _streaming_silver, with_silver("SELECT * FROM silver"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Favourite hit rate by league -- the headline report."""
    return QUERIES["hit_rate_abs_league"](spark, sf_dir)
