"""Column vocabulary of the match table.

Everything in the "fixed values" blocks below must equal the source data's
conventions (column codes, house codes, comments, league codes); it is data,
not logic.  All cross-house expressions elsewhere are generated from
``HOUSES`` x ``OUTCOMES`` so adding a bookmaker changes no code.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: 1X2 bookmakers present in the files (code, display name),
# --- in the order the per-house dispersion report lists them.
HOUSES: tuple[tuple[str, str], ...] = (
    ("B365", "Bet365"),
    ("BW", "Bet&Win"),
    ("IW", "Interwetten"),
    ("PS", "Pinnacle"),
    ("VC", "VC Bet"),
    ("WH", "William Hill"),
)
HOUSE_CODES: tuple[str, ...] = tuple(code for code, _ in HOUSES)

# --- fixed values: the three 1X2 outcomes (home win, draw, away win).
OUTCOMES: tuple[str, ...] = ("H", "D", "A")
OUTCOME_WORDS: dict[str, str] = {"H": "home", "D": "draw", "A": "away"}

# --- fixed values: league code -> display name used by the league reports.
LEAGUE_NAMES: dict[str, str] = {
    "E0": "Inglaterra",
    "I1": "Itália",
    "SP1": "Espanha",
    "D1": "Alemanha",
    "F1": "França",
}

# --- fixed values: raw CSV header -> table column.  The three "... and ..."
# --- entries name columns that do not occur in the files; renaming a missing
# --- column is a silent no-op, exactly as with withColumnRenamed.
RENAMES: dict[str, str] = {
    "Div": "League",
    "Date": "DateMatch",
    "Time": "TimeMatch",
    "AS": "ASS",
    "FTHG and HG": "FTHGandHG",
    "FTAG and AG": "FTAGandAG",
    "FTR and Res": "FTRandRes",
    "B365>2.5": "B365O25",
    "B365<2.5": "B365U25",
    "P>2.5": "PO25",
    "P<2.5": "PU25",
    "Max>2.5": "MaxO25",
    "Max<2.5": "MaxU25",
    "Avg>2.5": "AvgO25",
    "Avg<2.5": "AvgU25",
}

# --- fixed values: raw date text patterns accepted on ingest, tried in order.
DATE_PATTERNS: tuple[str, ...] = ("dd-MM-yyyy", "dd/MM/yyyy")
TIME_PATTERN = "HH:mm"

# --- fixed values: the 64 documented bronze columns (name, SQL type, comment).
DOCUMENTED: tuple[tuple[str, str, str], ...] = (
    ("League", "STRING", "League Division"),
    ("DateMatch", "DATE", "Match Date (dd/mm/yy)"),
    ("TimeMatch", "TIMESTAMP", "Time of match kick off"),
    ("HomeTeam", "STRING", "Home Team"),
    ("AwayTeam", "STRING", "Away Team"),
    ("FTHG", "INT", "Full Time Home Team Goals"),
    ("FTAG", "INT", "Full Time Away Team Goals"),
    ("FTR", "STRING", "Full Time Result (H Home Win, D Draw, A Away Win)"),
    ("HTHG", "INT", "Half Time Home Team Goals"),
    ("HTAG", "INT", "Half Time Away Team Goals"),
    ("HTR", "STRING", "Half Time Result (H Home Win, D Draw, A Away Win)"),
    ("HS", "INT", "Home Team Shots"),
    ("ASS", "INT", "Away Team Shots"),
    ("HST", "INT", "Home Team Shots on Target"),
    ("AST", "INT", "Away Team Shots on Target"),
    ("HC", "INT", "Home Team Corners"),
    ("AC", "INT", "Away Team Corners"),
    ("HF", "INT", "Home Team Fouls Committed"),
    ("AF", "INT", "Away Team Fouls Committed"),
    ("HY", "INT", "Home Team Yellow Cards"),
    ("AY", "INT", "Away Team Yellow Cards"),
    ("HR", "INT", "Home Team Red Cards"),
    ("AR", "INT", "Away Team Red Cards"),
    ("B365H", "DOUBLE", "Bet365 home win odds"),
    ("B365D", "DOUBLE", "Bet365 draw odds"),
    ("B365A", "DOUBLE", "Bet365 away win odds"),
    ("BWH", "DOUBLE", "Bet&Win home win odds"),
    ("BWD", "DOUBLE", "Bet&Win draw odds"),
    ("BWA", "DOUBLE", "Bet&Win away win odds"),
    ("IWH", "DOUBLE", "Interwetten home win odds"),
    ("IWD", "DOUBLE", "Interwetten draw odds"),
    ("IWA", "DOUBLE", "Interwetten away win odds"),
    ("PSH", "DOUBLE", "Pinnacle home win odds"),
    ("PSD", "DOUBLE", "Pinnacle draw odds"),
    ("PSA", "DOUBLE", "Pinnacle away win odds"),
    ("VCH", "DOUBLE", "VC Bet home win odds"),
    ("VCD", "DOUBLE", "VC Bet draw odds"),
    ("VCA", "DOUBLE", "VC Bet away win odds"),
    ("WHH", "DOUBLE", "William Hill home win odds"),
    ("WHD", "DOUBLE", "William Hill draw odds"),
    ("WHA", "DOUBLE", "William Hill away win odds"),
    ("MaxH", "DOUBLE", "Market maximum home win odds"),
    ("MaxD", "DOUBLE", "Market maximum draw win odds"),
    ("MaxA", "DOUBLE", "Market maximum away win odds"),
    ("AvgH", "DOUBLE", "Market average home win odds"),
    ("AvgD", "DOUBLE", "Market average draw win odds"),
    ("AvgA", "DOUBLE", "Market average away win odds"),
    ("AHh", "DOUBLE", "Market size of handicap (home team) (since 2019/2020)"),
    ("B365AHH", "DOUBLE", "Bet365 Asian handicap home team odds"),
    ("B365AHA", "DOUBLE", "Bet365 Asian handicap away team odds"),
    ("PAHH", "DOUBLE", "Pinnacle Asian handicap home team odds"),
    ("PAHA", "DOUBLE", "Pinnacle Asian handicap away team odds"),
    ("MaxAHH", "DOUBLE", "Market maximum Asian handicap home team odds"),
    ("MaxAHA", "DOUBLE", "Market maximum Asian handicap away team odds"),
    ("AvgAHH", "DOUBLE", "Market average Asian handicap home team odds"),
    ("AvgAHA", "DOUBLE", "Market average Asian handicap away team odds"),
    ("B365O25", "DOUBLE", "Bet365 over 2.5 goals"),
    ("B365U25", "DOUBLE", "Bet365 under 2.5 goals"),
    ("PO25", "DOUBLE", "Pinnacle over 2.5 goals"),
    ("PU25", "DOUBLE", "Pinnacle under 2.5 goals"),
    ("MaxO25", "DOUBLE", "Market maximum over 2.5 goals"),
    ("MaxU25", "DOUBLE", "Market maximum under 2.5 goals"),
    ("AvgO25", "DOUBLE", "Market average over 2.5 goals"),
    ("AvgU25", "DOUBLE", "Market average under 2.5 goals"),
)

# --- fixed values: silver column names added by the enrichment, per outcome.
BEST_PREFIX = "MaiorValor"        # best (highest) quote across houses
CONSENSUS_PREFIX = "Media"        # null-aware mean quote across houses
PICK_COLUMN = "VencedorAposta"    # predicted outcome, one of H / D / A
IMPLIED_PREFIX = "PercentAbsol"   # raw implied probability in percent
NORMALISED_PREFIX = "Percent"     # margin-free probability in percent
REALISED_COLUMN = "Percentual"    # probability given to the actual result

# --- fixed values: supplied market summary columns.
SUPPLIED_MAX_PREFIX = "Max"
SUPPLIED_AVG_PREFIX = "Avg"

# Kick-off is a wall-clock time without zone, so it is stored as TIMESTAMP_NTZ:
# the value then never shifts with the session time zone.
_SPARK_TYPES = {
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampNTZType(),
    "INT": T.IntegerType(),
    "DOUBLE": T.DoubleType(),
    "FLOAT": T.FloatType(),
    "BIGINT": T.LongType(),
}


def spark_type(sql_type: str) -> T.DataType:
    return _SPARK_TYPES[sql_type.upper()]


def quote_column(house: str, outcome: str) -> str:
    """Column holding ``house``'s quote for ``outcome`` (e.g. ``B365H``)."""
    return f"{house}{outcome}"


def present_houses(columns: list[str], houses=HOUSE_CODES) -> tuple[str, ...]:
    """The houses among ``houses`` with 1X2 quote columns.

    A house with some of its three columns only is an error, and so is a house
    without any that the caller named; of the default houses, those that the files
    do not carry are left out.
    """
    have = set(columns)
    quoted = {h: [quote_column(h, o) in have for o in OUTCOMES] for h in houses}
    partial = [h for h, q in quoted.items() if any(q) and not all(q)]
    if partial:
        raise ValueError(f"1X2 quote columns are incomplete for {partial}")
    found = tuple(h for h, q in quoted.items() if all(q))
    absent = [h for h in houses if h not in found]
    if absent and tuple(houses) != tuple(HOUSE_CODES):
        raise ValueError(f"no 1X2 quote columns for {absent}")
    if not found:
        raise ValueError(f"no 1X2 quote columns for any of {list(houses)}")
    return found


def documented_types() -> dict[str, T.DataType]:
    return {name: spark_type(t) for name, t, _ in DOCUMENTED}


def documented_comments() -> dict[str, str]:
    return {name: comment for name, _, comment in DOCUMENTED}


def bronze_schema(extra: dict[str, T.DataType] | None = None) -> T.StructType:
    """Typed schema of the documented columns (plus ``extra`` ones), with the
    column comments carried as field metadata so a table write keeps them."""
    fields = [
        T.StructField(name, spark_type(t), True, {"comment": comment})
        for name, t, comment in DOCUMENTED
    ]
    for name, dtype in (extra or {}).items():
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def raw_name(column: str) -> str:
    """Inverse of ``RENAMES`` for the columns that are actually renamed."""
    inverse = {v: k for k, v in RENAMES.items()}
    return inverse.get(column, column)
