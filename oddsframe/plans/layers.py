"""The layered build: league files -> bronze table -> silver table.

Each layer is written as a table, which also cuts the lineage: silver is
computed from the *stored* bronze, so a lost executor during the silver job
recomputes from bronze files, never from the raw CSVs.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.enrich import enrich
from ..sources.leagues import ingest
from ..sources.tables import create_database, read_layer, write_layer


def build_bronze(
    spark: SparkSession,
    sources: Iterable[str],
    table: str = "bronze.europa",
    location: str | None = None,
    extra_types: Mapping[str, T.DataType] | None = None,
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Ingest league files into the bronze table (replaced, not appended)."""
    db = table.rpartition(".")[0]
    if db:
        create_database(spark, db, location)
    write_layer(ingest(spark, sources, extra_types=extra_types), table, partition_by=partition_by)
    return read_layer(spark, table)


def build_silver(
    spark: SparkSession,
    bronze_table: str = "bronze.europa",
    table: str = "silver.europa",
    location: str | None = None,
    partition_by: list[str] | None = None,
    sort_within: list[str] | None = None,
) -> DataFrame:
    """Enrich the stored bronze table into the silver table in one job.

    ``sort_within`` clusters each output file (e.g. by home and away team for
    fixture lookups) without a shuffle.

    Silver is always its own table: a table cannot be overwritten by a job
    that reads it, so the source's in-place updates become a new table.
    """
    if table.lower() == bronze_table.lower():
        raise ValueError("silver must be a different table from bronze")
    db = table.rpartition(".")[0]
    if db:
        create_database(spark, db, location)
    write_layer(enrich(read_layer(spark, bronze_table)), table, partition_by=partition_by,
                sort_within=sort_within)
    return read_layer(spark, table)
