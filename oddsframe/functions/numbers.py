"""Ratios and display formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(numerator: Column, denominator: Column) -> Column:
    """``100 * numerator / denominator`` as DOUBLE; null on a zero denominator.

    Both sides are cast to DOUBLE first so ``count * 100.0`` never turns into a
    DECIMAL(38, x) column.
    """
    return F.try_divide(numerator.cast("double") * F.lit(100.0), denominator.cast("double"))


def as_text(value: str | Column, decimals: int = 2) -> Column:
    """Display text with thousands separators (``FORMAT_NUMBER``, HALF_EVEN).

    Apply it last: sorting the text would order ``'9.50'`` above ``'55.05'``.
    """
    c = F.col(value) if isinstance(value, str) else value
    return F.format_number(c, decimals)
