"""Data-quality checks: supplied summaries vs quotes, schema drift, dictionary.

All checks are projections or one aggregate over the table; metadata checks
(schema differences, dictionary coverage) produce small DataFrames whose
size is bounded by the number of columns, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quotes import best_quote_sql, differs_sql, ident, sql_string, strict_mean_sql
from ..schema import (
    HOUSE_CODES,
    OUTCOME_WORDS,
    OUTCOMES,
    SUPPLIED_AVG_PREFIX,
    SUPPLIED_MAX_PREFIX,
    present_houses,
)

MATCH_KEYS = ("League", "DateMatch", "HomeTeam", "AwayTeam")


def _reconcile(
    df: DataFrame, kind: str, keys: Sequence[str], houses: Sequence[str], tolerance: float
) -> DataFrame:
    houses = present_houses(df.columns, houses)
    cols = []
    for o in OUTCOMES:
        w = OUTCOME_WORDS[o]
        if kind == "max":
            computed, supplied = best_quote_sql(o, houses), ident(f"{SUPPLIED_MAX_PREFIX}{o}")
        else:
            computed, supplied = strict_mean_sql(o, houses), ident(f"{SUPPLIED_AVG_PREFIX}{o}")
        cols += [
            F.expr(computed).alias(f"computed_{w}"),
            F.col(supplied).alias(f"supplied_{w}"),
            F.expr(differs_sql(computed, supplied, tolerance)).alias(f"differs_{w}"),
        ]
    return df.select(*keys, *cols)


def max_reconcile(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    houses: Sequence[str] = HOUSE_CODES,
    tolerance: float = 0.005,
) -> DataFrame:
    """Best quote over the houses in the file beside the supplied ``Max*``
    column, with a ``differs_*`` flag (``|computed - supplied| > tolerance``)."""
    keys = list(keys) if keys is not None else _default_keys(df)
    return _reconcile(df, "max", keys, houses, tolerance)


def mean_reconcile(
    df: DataFrame,
    keys: Sequence[str] | None = None,
    houses: Sequence[str] = HOUSE_CODES,
    tolerance: float = 0.005,
) -> DataFrame:
    """Strict (null-intolerant) mean of the houses beside the supplied
    ``Avg*`` column; a match with any house missing has a null mean and a
    null flag."""
    keys = list(keys) if keys is not None else _default_keys(df)
    return _reconcile(df, "mean", keys, houses, tolerance)


def _default_keys(df: DataFrame) -> list[str]:
    return ["MatchId"] if "MatchId" in df.columns else [k for k in MATCH_KEYS if k in df.columns]


def mismatch_counts(df: DataFrame, houses: Sequence[str] = HOUSE_CODES,
                    tolerance: float = 0.005) -> DataFrame:
    """How many matches disagree with the supplied Max / Avg, per outcome --
    one aggregate pass (``count_if`` ignores null flags)."""
    houses = present_houses(df.columns, houses)
    aggs = [F.count(F.lit(1)).alias("matches")]
    for o in OUTCOMES:
        w = OUTCOME_WORDS[o]
        max_off = differs_sql(best_quote_sql(o, houses), ident(f"{SUPPLIED_MAX_PREFIX}{o}"), tolerance)
        avg_off = differs_sql(strict_mean_sql(o, houses), ident(f"{SUPPLIED_AVG_PREFIX}{o}"), tolerance)
        aggs.append(F.expr(f"count_if({max_off})").alias(f"max_differs_{w}"))
        aggs.append(F.expr(f"count_if({avg_off})").alias(f"avg_differs_{w}"))
    return df.agg(*aggs)


_DIFF_SCHEMA = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("column_name", T.StringType(), False),
    T.StructField("status", T.StringType(), False),
])


def schema_difference(spark: SparkSession, columns_by_source: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns that some sources have and others lack.

    ``columns_by_source`` maps a source name (file, table, dictionary) to its
    column list.  Output rows ``(source, column, status)`` with status
    ``'extra'`` (only in some sources, listed where present) or ``'missing'``
    (listed where absent).  The input is metadata -- one entry per column --
    so building the small frame on the driver is bounded by the schema width.
    """
    sets = {src: set(cols) for src, cols in columns_by_source.items()}
    everywhere = set.intersection(*sets.values()) if sets else set()
    anywhere = set.union(*sets.values()) if sets else set()
    rows = []
    for src, cols in sets.items():
        for c in sorted(cols - everywhere):
            rows.append((src, c, "extra"))
        for c in sorted(anywhere - cols):
            rows.append((src, c, "missing"))
    return spark.createDataFrame(rows, _DIFF_SCHEMA)


def column_profile(df: DataFrame) -> DataFrame:
    """Non-null count per column, in one aggregate pass, as long rows
    ``(column_name, non_null)``."""
    counted = [f"_n{i}" for i in range(len(df.columns))]
    counts = df.agg(*[F.expr(f"count({ident(c)})").alias(n) for c, n in zip(df.columns, counted)])
    rows = ", ".join(f"struct({sql_string(c)} AS column_name, CAST({n} AS BIGINT) AS non_null)"
                     for c, n in zip(df.columns, counted))
    return counts.selectExpr(f"inline(array({rows}))")


def dictionary_audit(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Attach dictionary descriptions to the table's columns.

    ``dictionary`` has ``(column_name, description)`` rows.  Output, one row
    per column of ``df`` or of the dictionary: ``column_name, data_type, description,
    in_table, documented, non_null``.
    """
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "column_name string, data_type string",
    )
    described = dictionary.select("column_name", "description").dropDuplicates(["column_name"])
    present = column_profile(df).join(types, "column_name").join(described, "column_name", "left")
    absent = (described.join(types, "column_name", "left_anti")
              .withColumn("data_type", F.lit(None).cast("string"))
              .withColumn("non_null", F.lit(0).cast("long")))
    return present.unionByName(absent).select(
        "column_name",
        "data_type",
        "description",
        F.col("data_type").isNotNull().alias("in_table"),
        F.col("description").isNotNull().alias("documented"),
        "non_null",
    )
