"""oddsframe -- bookmaker-odds analytics as PySpark DataFrame functions.

Layers: league CSV files -> bronze table (typed, documented) -> silver
table (best / consensus quotes, favourite, implied / margin-free / realised
probabilities) -> reports (hit rates, house dispersion, outcome shares).
Everything is built from Spark's own expressions; see README.md.
"""

from .operators.analysis import (
    favourite_summary,
    hit_rate,
    hit_rate_levels,
    house_dispersion,
    match_lookup,
    outcome_share,
)
from .operators.enrich import decode_league, enrich, to_long
from .operators.quality import (
    column_profile,
    dictionary_audit,
    max_reconcile,
    mean_reconcile,
    mismatch_counts,
    schema_difference,
)
from .plans.layers import build_bronze, build_silver
from .session import checkpoint_root, get_session, scratch_dir
from .sources.leagues import ingest, normalise, read_strings, read_typed

__all__ = [
    "build_bronze",
    "build_silver",
    "checkpoint_root",
    "column_profile",
    "decode_league",
    "dictionary_audit",
    "enrich",
    "favourite_summary",
    "get_session",
    "hit_rate",
    "hit_rate_levels",
    "house_dispersion",
    "ingest",
    "match_lookup",
    "max_reconcile",
    "mean_reconcile",
    "mismatch_counts",
    "normalise",
    "outcome_share",
    "read_strings",
    "read_typed",
    "schema_difference",
    "scratch_dir",
    "to_long",
]
