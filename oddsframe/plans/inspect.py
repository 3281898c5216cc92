"""Plan inspection helpers built on ``DataFrame.explain`` output."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def physical_operators(df: DataFrame) -> list[str]:
    """Operator names of the physical plan, in the formatted plan's order
    (e.g. ``['AdaptiveSparkPlan', 'HashAggregate', 'Exchange', ...]``)."""
    text = plan_text(df, "formatted")
    header = text.split("\n\n")[0]
    names = []
    for line in header.splitlines()[1:]:          # skip "== Physical Plan =="
        if re.search(r"\(\d+\)\s*$", line):
            # tree prefix ("+- ", ":- ", "* " codegen marker), then the name
            m = re.match(r"^[\s:+\-|*]*([A-Za-z][A-Za-z0-9]*)", line)
            if m:
                names.append(m.group(1))
    return names


def count(df: DataFrame, operator: str) -> int:
    return sum(1 for op in physical_operators(df) if op == operator)


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", plan_text(df, "formatted"))


def read_schema(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^\n]*>)", plan_text(df, "formatted"))
