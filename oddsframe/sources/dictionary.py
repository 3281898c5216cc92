"""The data dictionary: a notes-style text file, one ``Name = description``
line per column (raw header names), read with Spark's text source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import DOCUMENTED, RENAMES, raw_name

_LINE = r"^\s*(\S(?:.*?\S)?)\s+=\s+(.*\S)\s*$"


def dictionary_lines(entries: Sequence[tuple[str, str, str]] = DOCUMENTED) -> list[str]:
    """Notes-file lines for ``(table_column, type, comment)`` entries, using
    the raw header names the files carry."""
    return [f"{raw_name(name)} = {comment}" for name, _, comment in entries]


def write_dictionary(
    spark: SparkSession, path: str, entries: Sequence[tuple[str, str, str]] = DOCUMENTED
) -> None:
    """Write the notes file as one text file under ``path``."""
    (spark.createDataFrame([(line,) for line in dictionary_lines(entries)], "value string")
          .coalesce(1).write.mode("overwrite").text(path))


def head(spark: SparkSession, path: str) -> DataFrame:
    """The raw lines, as the file is (``value``)."""
    return spark.read.text(path)


def _renamed(col: Column) -> Column:
    expr = None
    for src, dst in RENAMES.items():
        expr = F.when(col == F.lit(src), F.lit(dst)) if expr is None else expr.when(col == F.lit(src), F.lit(dst))
    return expr.otherwise(col) if expr is not None else col


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Parse ``Name = description`` lines into ``(column_name, raw_column,
    description)``; ``column_name`` is the table name after the rename map.  Lines
    that do not match (titles, blanks) are skipped."""
    lines = spark.read.text(path)
    raw = F.regexp_extract("value", _LINE, 1)
    return (lines.where(F.col("value").rlike(_LINE))
                 .select(_renamed(raw).alias("column_name"), raw.alias("raw_column"),
                         F.regexp_extract("value", _LINE, 2).alias("description")))
