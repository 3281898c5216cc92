"""Layer tables: databases, writes, copies, comments, describe.

Layers are managed parquet tables.  Writes default to ``overwrite`` so a
rerun replaces a layer instead of appending duplicates (the source cleared
the table folder by hand before an append); ``append`` remains available.
A table is never overwritten from a read of itself -- silver is its own
table built from bronze.  Column comments travel as field metadata on the
write, so a layer is documented in the same job that writes it; ``CREATE
TABLE ... AS SELECT`` keeps them.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quotes import sql_string
from ..schema import documented_comments
from ..session import unique_name


def _quote_ident(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS`` (optionally at a shared location)."""
    where = f" LOCATION {sql_string(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote_ident(name)}{where}")


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quote_ident(table)}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def with_comments(df: DataFrame, comments: Mapping[str, str] | None = None) -> DataFrame:
    """Attach column comments as field metadata (one projection, no data
    touched); columns without a comment keep their metadata."""
    comments = documented_comments() if comments is None else comments
    return df.select(*[
        F.col(f"`{c}`").alias(c, metadata={"comment": comments[c]}) if c in comments else F.col(f"`{c}`")
        for c in df.columns
    ])


def write_layer(
    df: DataFrame,
    table: str,
    mode: str = "overwrite",
    comments: Mapping[str, str] | None = None,
    partition_by: Sequence[str] | None = None,
    fmt: str = "parquet",
    sort_within: Sequence[str] | None = None,
) -> None:
    """Write ``df`` as managed table ``table`` with column comments.

    ``partition_by`` (e.g. league, season) enables partition pruning for
    multi-season data; the default writes an unpartitioned table.
    ``sort_within`` sorts each task's rows before writing (no shuffle), so the
    parquet min/max statistics let lookups on those columns (e.g. home and
    away team) skip most row groups.

    An overwritten table is first written under another name and takes the old
    one's place only when that has succeeded: a job that fails leaves the old
    table as it was.
    """
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = with_comments(df, comments).write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    spark = df.sparkSession
    if mode != "overwrite" or not spark.catalog.tableExists(table):
        writer.saveAsTable(table)
        return
    fresh = unique_name(table)
    writer.saveAsTable(fresh)
    drop_table(spark, table)
    spark.sql(f"ALTER TABLE {_quote_ident(fresh)} RENAME TO {_quote_ident(table)}")


def create_layer(spark: SparkSession, table: str, like: DataFrame, types: Mapping[str, str] | None = None) -> None:
    """An empty managed table with the columns of ``like``, some of them of
    another declared type, e.g. ``{"VencedorAposta": "VARCHAR(1)"}``.  Appending a
    value that is too long for its ``VARCHAR(n)`` raises."""
    types = types or {}
    columns = ", ".join(f"`{f.name}` {types.get(f.name, f.dataType.simpleString())}" for f in like.schema.fields)
    spark.sql(f"CREATE TABLE {_quote_ident(table)} ({columns}) USING parquet")


def copy_layer(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> None:
    """``CREATE TABLE target USING fmt AS SELECT * FROM source`` (comments kept)."""
    spark.sql(
        f"CREATE TABLE {_quote_ident(target)} USING {fmt} AS SELECT * FROM {_quote_ident(source)}"
    )


def read_layer(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def display(df: DataFrame, n: int | None = None) -> None:
    """Print a report untruncated: all its rows (one for each group), or the
    first ``n`` of a table, of which only ``n`` reach the driver."""
    df.show(df.count() if n is None else n, truncate=False)


def comment_column(spark: SparkSession, table: str, column: str, comment: str) -> None:
    """Set one column comment in the catalog (type unchanged)."""
    spark.sql(f"ALTER TABLE {_quote_ident(table)} ALTER COLUMN `{column}` COMMENT {sql_string(comment)}")


def describe(spark: SparkSession, table: str) -> DataFrame:
    """Column name, type and comment of ``table`` (``DESCRIBE TABLE``),
    without the partition-information block."""
    rows = spark.sql(f"DESCRIBE TABLE {_quote_ident(table)}")
    return (rows.where(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
                .dropDuplicates(["col_name"])
                .select(F.col("col_name").alias("column_name"), F.col("data_type"), F.col("comment")))


def describe_extended(spark: SparkSession, table: str) -> DataFrame:
    """``DESCRIBE TABLE EXTENDED``: columns plus table detail rows."""
    return spark.sql(f"DESCRIBE TABLE EXTENDED {_quote_ident(table)}")
