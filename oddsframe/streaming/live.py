"""Incremental form of the pipeline with Structured Streaming.

New match files (bronze layout, e.g. one file per matchday) land in a
folder; the same enrichment as the batch path runs on each micro-batch (it
is a pure projection, so it is stateless), and the hit-rate reports are
kept up to date as streaming aggregations.  Their state is one row per group
(league or calendar month) -- bounded by the number of groups, never by the
number of matches -- and lives in the checkpoint folder, so a restarted or
relocated query resumes exactly where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.numbers import percent
from ..operators.analysis import GROUPINGS
from ..operators.enrich import decode_league, enrich
from ..schema import PICK_COLUMN, REALISED_COLUMN
from ..session import scratch_dir

def stream_session(spark: SparkSession, state_partitions: int = 8) -> SparkSession:
    """A sibling session (same context and catalog, own SQL settings) whose
    streaming aggregations keep their state in ``state_partitions``
    partitions.

    The running reports hold one state row per group, and each micro-batch
    shuffles only partial aggregates (a few rows per input task), so a
    handful of state partitions is right at any input size.  The count is
    fixed into the checkpoint when a query first starts; the caller's own
    session settings are left alone.
    """
    try:
        sibling = spark.newSession()
    except Exception:  # e.g. Spark Connect: keep the caller's session as is
        return spark
    sibling.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    return sibling


def match_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Streaming frame over files arriving in ``landing`` (fixed schema; file
    sources never infer).  ``max_files_per_trigger`` bounds each batch.

    For raw league CSV files pass ``fmt="csv"`` and the typed raw schema of
    their header (``sources.leagues.raw_schema``); header lines are skipped
    and ``sources.leagues.normalise`` turns the stream into bronze rows.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        # A file whose header differs from the schema fails the batch.
        reader = reader.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(landing)


def silver_stream(bronze_stream: DataFrame, decode: bool = True) -> DataFrame:
    """The batch enrichment applied to a stream (stateless projections)."""
    return enrich(decode_league(bronze_stream) if decode else bronze_stream)


def running_hit_rates(silver: DataFrame, by: str = "league") -> DataFrame:
    """Absolute and weighted hit rates per group, maintained incrementally.

    Same semantics as the batch ``hit_rate``: every match counts in the
    absolute denominator, null probabilities are skipped by the weighted one.
    ``by`` is ``"league"``, ``"month"``, ``"season"`` or a column name.  Output: key,
    ``matches``, ``hits``, ``hit_pct``, ``weighted_pct``.
    """
    key = GROUPINGS[by]() if by in GROUPINGS else F.col(by)
    hit = F.col("FTR") == F.col(PICK_COLUMN)
    p = F.col(REALISED_COLUMN).cast("double")
    return (silver.groupBy(key)
            .agg(F.count(F.lit(1)).alias("matches"), F.count_if(hit).alias("hits"),
                 F.sum(p).alias("_p_sum"), F.count(p).alias("_p_n"))
            .select(by, "matches", "hits",
                    percent(F.col("hits"), F.col("matches")).alias("hit_pct"),
                    F.try_divide(F.col("_p_sum"), F.col("_p_n")).alias("weighted_pct")))


def running_view(
    aggregate: DataFrame,
    name: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Expose the latest complete result of a streaming aggregate as the
    in-memory view ``name`` (``spark.table(name)``).

    The view holds the aggregate's output only -- one row per group -- so it
    stays small however many matches stream through; the aggregation state
    itself is checkpointed under the shared folder.
    """
    checkpoint = checkpoint or scratch_dir(aggregate.sparkSession, "stream-ckpt")
    writer = (aggregate.writeStream.outputMode("complete").format("memory").queryName(name)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()


def append_silver(
    silver: DataFrame,
    path: str,
    checkpoint: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Append enriched rows to a parquet silver folder (exactly-once through
    the file sink's commit log in ``checkpoint``)."""
    checkpoint = checkpoint or scratch_dir(silver.sparkSession, "silver-ckpt")
    writer = (silver.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
