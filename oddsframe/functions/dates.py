"""Date and kick-off parsing.

Parsing never raises under ANSI mode: each pattern is tried with
``try_to_date`` and the first hit wins, so a malformed cell becomes null
(and can be counted) instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import DATE_PATTERNS, TIME_PATTERN


def parse_date(text: str | Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """First successful parse of ``text`` over ``patterns``; null if none."""
    c = F.col(text) if isinstance(text, str) else text
    return F.coalesce(*[F.try_to_date(c, p) for p in patterns])


_CLOCK = r"^\s*(\d{1,2}):(\d{2})\s*$"


def kickoff(
    date: str | Column, time_text: str | Column, time_pattern: str = TIME_PATTERN
) -> Column:
    """Kick-off as TIMESTAMP_NTZ from a parsed DATE and an ``HH:mm`` text.

    The value is assembled from the date's parts and the clock text's hour and
    minute (``try_make_timestamp_ntz``), so it never passes through the
    session time zone -- a wall-clock time inside a daylight-saving gap stays
    as written -- and malformed text (``25:00``, ``x``) gives null.  Building
    from the match date keeps it deterministic (a bare time parsed alone would
    be attached to the current day).  Only ``HH:mm`` clocks are accepted.
    """
    if time_pattern != TIME_PATTERN:
        raise ValueError(f"only {TIME_PATTERN!r} kick-off text is supported")
    d = F.col(date) if isinstance(date, str) else date
    t = F.col(time_text) if isinstance(time_text, str) else time_text
    hour = F.regexp_extract(t, _CLOCK, 1)
    minute = F.regexp_extract(t, _CLOCK, 2)
    return F.try_make_timestamp_ntz(
        F.year(d), F.month(d), F.dayofmonth(d),
        F.when(hour != "", hour.cast("int")), F.when(minute != "", minute.cast("int")), F.lit(0),
    )


def format_date(date: str | Column, pattern: str = DATE_PATTERNS[0]) -> Column:
    d = F.col(date) if isinstance(date, str) else date
    return F.date_format(d, pattern)


def format_time(ts: str | Column, pattern: str = TIME_PATTERN) -> Column:
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.date_format(t, pattern)
