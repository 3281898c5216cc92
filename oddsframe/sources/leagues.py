"""League CSV files: raw scan, typed scan, flat ingest, and export.

Raw files are one CSV per league (and season) with a header row.  Headers
drift between files, also inside one folder (one league carries an extra
``Referee`` column in the middle), so each file's own header is read (one
line), files with an identical header are read by *one*
distributed ``spark.read.csv`` call with an explicit schema built from that
header (a file that does not carry it is an error), and the per-header frames are aligned by name with
``unionByName(allowMissingColumns=True)``.  The number of reads is the
number of distinct headers, not the number of files; no type inference pass
runs over the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import format_date, format_time, kickoff, parse_date
from ..operators.enrich import decode_league
from ..schema import DATE_PATTERNS, DOCUMENTED, RENAMES, documented_types, raw_name

RAW_DATE, RAW_TIME = "Date", "Time"


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line of ``path`` (file or folder).

    No schema inference: Spark reads just the first line to name the columns.
    """
    return spark.read.option("header", True).option("inferSchema", False).csv(path).columns


def headers_of(spark: SparkSession, paths: Sequence[str], workers: int = 16) -> list[list[str]]:
    """Headers of many sources; the one-line reads run as concurrent jobs."""
    if len(paths) <= 1:
        return [header_of(spark, p) for p in paths]
    with ThreadPoolExecutor(max_workers=min(workers, len(paths))) as pool:
        return list(pool.map(lambda p: header_of(spark, p), paths))


def source_files(spark: SparkSession, sources: Sequence[str]) -> list[str]:
    """The files in ``sources`` (files or folders): a listing, no file is read."""
    if not sources:
        return []
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
               .load(list(sources)).select("path").distinct())
    return sorted(r.path for r in listing.collect())


def read_strings(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All columns as STRING, named by the header (no inference pass).

    Give several paths only when they share one header: Spark names the
    columns from the first file and maps the rest by position.  Mixed
    headers go through ``ingest`` (grouped by header, aligned by name).
    """
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def raw_schema(
    header: Sequence[str],
    extra_types: Mapping[str, T.DataType] | None = None,
    unknown_type: T.DataType = T.StringType(),
) -> T.StructType:
    """Typed schema for a raw header: documented columns get their declared
    type (looked up through the rename map), date and time stay text for
    pattern parsing, anything else gets ``extra_types`` or ``unknown_type``."""
    types = documented_types()
    fields = []
    for name in header:
        target = RENAMES.get(name, name)
        if name in (RAW_DATE, RAW_TIME):
            dtype: T.DataType = T.StringType()
        elif extra_types and name in extra_types:
            dtype = extra_types[name]
        else:
            dtype = types.get(target, unknown_type)
        fields.append(T.StructField(name, dtype, True))
    return T.StructType(fields)


def read_typed(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: Sequence[str] | None = None,
    extra_types: Mapping[str, T.DataType] | None = None,
    unknown_type: T.DataType = T.StringType(),
    infer: bool = False,
) -> DataFrame:
    """One distributed read of files that share ``header`` (read from the
    first path when not given); a file with another header raises.  Malformed numeric cells become null
    (PERMISSIVE mode) instead of failing the job.

    ``infer=True`` lets Spark infer the types instead (an extra full pass
    over the files before the read; kept for parity with ad-hoc loading, not
    for production -- inferred types may change from file to file, and text
    such as ``T3`` is taken for a time of day).
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if infer:
        return (spark.read.option("header", True).option("inferSchema", True)
                .option("mode", "PERMISSIVE").csv(paths))
    header = list(header) if header is not None else header_of(spark, paths[0])
    schema = raw_schema(header, extra_types, unknown_type)
    return (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
            .option("enforceSchema", False).csv(paths))


def normalise(
    raw: DataFrame,
    drop: Sequence[str] = ("Referee",),
    date_patterns: Sequence[str] = DATE_PATTERNS,
    keep_raw_date: bool = False,
) -> DataFrame:
    """Raw typed frame -> bronze column names and types.

    Drops ``drop`` (absent columns are ignored), parses ``Date`` over
    ``date_patterns`` (null when none fits), builds the kick-off timestamp
    from date + ``Time``, and applies the rename map (missing names are a
    no-op).  With ``keep_raw_date`` the original text stays as ``_date_text``
    so failures can be counted.
    """
    df = raw.drop(*[c for c in drop if c in raw.columns])
    parsed: dict[str, Column] = {}
    if RAW_DATE in df.columns:
        parsed["DateMatch"] = parse_date(RAW_DATE, date_patterns)
        if keep_raw_date:
            parsed["_date_text"] = F.col(RAW_DATE)
    if RAW_TIME in df.columns:
        date = parsed.get("DateMatch", F.lit(None).cast("date"))
        parsed["TimeMatch"] = kickoff(date, RAW_TIME)
    df = df.withColumns(parsed).drop(*[c for c in (RAW_DATE, RAW_TIME) if c in df.columns])
    df = df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})
    ordered = [n for n, _, _ in DOCUMENTED if n in df.columns]
    return df.select(*ordered, *[c for c in df.columns if c not in ordered])


def ingest(
    spark: SparkSession,
    sources: Iterable[str],
    drop: Sequence[str] = ("Referee",),
    decode: bool = True,
    extra_types: Mapping[str, T.DataType] | None = None,
    unknown_type: T.DataType = T.StringType(),
    date_patterns: Sequence[str] = DATE_PATTERNS,
) -> DataFrame:
    """Flat ingest: many league files -> one typed bronze frame.

    Sources are files or folders (searched recursively).  Files are grouped by
    their own header; each group is one typed read; groups are
    aligned by column name (a column missing from a group is null there).
    League codes are decoded to display names when ``decode``.

    Each file costs one small header-read job (run concurrently), so at scale
    land few large files rather than thousands of small ones.
    """
    sources = source_files(spark, list(sources))
    groups: dict[tuple[str, ...], list[str]] = {}
    for src, header in zip(sources, headers_of(spark, sources)):
        groups.setdefault(tuple(header), []).append(src)
    frames = [
        normalise(read_typed(spark, paths, header, extra_types, unknown_type), drop, date_patterns)
        for header, paths in groups.items()
    ]
    if not frames:
        raise ValueError("no source files given")
    bronze = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return decode_league(bronze) if decode else bronze


def date_failures(raw: DataFrame, date_patterns: Sequence[str] = DATE_PATTERNS) -> DataFrame:
    """Rows whose date text is present but fits none of the patterns:
    one aggregate, columns ``rows, bad_dates``."""
    bad = F.col(RAW_DATE).isNotNull() & parse_date(RAW_DATE, date_patterns).isNull()
    return raw.agg(F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad_dates"))


def to_raw_layout(
    bronze: DataFrame, extra: Mapping[str, Column] | None = None, after: str = "HTR"
) -> DataFrame:
    """Bronze -> the raw file layout: raw header names, ``dd-MM-yyyy`` date
    text, ``HH:mm`` time text.  ``extra`` columns are inserted after
    ``after`` (schema drift as found in real files)."""
    cols: list[Column] = []
    for c in bronze.columns:
        if c == "DateMatch":
            cols.append(format_date(c).alias(RAW_DATE))
        elif c == "TimeMatch":
            cols.append(format_time(c).alias(RAW_TIME))
        else:
            cols.append(F.col(c).alias(raw_name(c)))
        if c == after and extra:
            cols += [e.alias(n) for n, e in extra.items()]
    return bronze.select(*cols)


def write_league_files(
    raw: DataFrame,
    out_dir: str,
    league_column: str = "Div",
    mode: str = "overwrite",
    files_per_league: int | None = None,
) -> None:
    """One CSV folder per league under ``out_dir`` (``league=<code>``), in a
    single distributed write partitioned by league; the league code also
    stays a column inside the files.

    By default every task writes its own rows (no shuffle).  With
    ``files_per_league`` the rows are first spread over ``(league, bucket)``
    with a hash bucket of the whole row, so each league -- including one
    holding a third of all matches -- is written as about that many files
    by as many tasks, instead of one small file per task and league.
    """
    df = raw.withColumn("league", F.col(league_column))
    if files_per_league:
        bucket = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in raw.columns]), F.lit(files_per_league))
        df = df.repartition(F.col("league"), bucket)
    (df.write.mode(mode).option("header", True)
       .partitionBy("league").csv(out_dir))


def league_folders(spark: SparkSession, out_dir: str) -> list[str]:
    """Folders under ``out_dir`` that hold CSV files.

    The listing is a ``binaryFile`` scan that selects only the path (file
    contents are pruned away); the result has one row per folder.
    """
    files = (spark.read.format("binaryFile")
             .option("pathGlobFilter", "*.csv").option("recursiveFileLookup", True)
             .load(out_dir).select("path"))
    folders = files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("folder")).distinct()
    return sorted(r.folder for r in folders.collect())
