"""Column-expression building blocks (all built-in Spark functions)."""

from .dates import format_date, format_time, kickoff, parse_date
from .numbers import as_text, percent
from .quotes import (
    best_quote,
    best_quote_sql,
    consensus_quote,
    consensus_sql,
    differs,
    differs_sql,
    favourite,
    favourite_sql,
    ident,
    implied_probability,
    implied_sql,
    normalised_probability,
    normalised_sql,
    overround,
    overround_sql,
    quotes_for,
    realised_probability,
    realised_sql,
    sql_string,
    strict_mean_quote,
    strict_mean_sql,
)

__all__ = [
    "best_quote_sql",
    "consensus_sql",
    "differs_sql",
    "favourite_sql",
    "ident",
    "implied_sql",
    "normalised_sql",
    "overround_sql",
    "realised_sql",
    "sql_string",
    "strict_mean_sql",
    "as_text",
    "best_quote",
    "consensus_quote",
    "differs",
    "favourite",
    "format_date",
    "format_time",
    "implied_probability",
    "kickoff",
    "normalised_probability",
    "overround",
    "parse_date",
    "percent",
    "quotes_for",
    "realised_probability",
    "strict_mean_quote",
]
