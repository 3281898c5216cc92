"""What several operators share: lineage cuts, fixed-size folds, membership
filters of fixed size, and connected components."""

from __future__ import annotations

import ctypes
import functools
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

#: Bits of a membership filter: one megabyte, whatever the input holds.
FILTER_BITS = 1 << 23


#: Spark's own setting: the shuffle files of a query go when the query has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to a table in the shared checkpoint folder and go on from
    there, so that a lost executor costs no more than the stage it was in.  The
    shuffle files of the write are dropped with its end: nobody reads them again."""
    spark = df.sparkSession
    path = scratch_dir(spark, "cut")
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*frames: DataFrame) -> None:
    """Remove the tables of frames that ``cut`` made and that no later frame reads."""
    for df in frames:
        path = getattr(df, "_cut_path", None)
        if path:
            context = df.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


#: What forgets each thing that Python workers keep for later tasks, by the operator that keeps it.
_forgets: dict[str, Callable[[], None]] = {}


def kept_between_tasks(operator: str, forget: Callable[[], None]) -> None:
    """``forget`` is called when a worker begins a task of another operator."""
    _forgets[operator] = forget


def return_memory() -> None:
    """Give freed memory of this Python worker back to the system: a worker may be idle for
    long, and what its allocators hold counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def lean(operator: str):
    """A decorator of the kernels of ``operator``: a worker forgets first what it keeps for tasks
    of other operators, and returns the memory that is free when the task ends."""

    def decorated(kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
        @functools.wraps(kernel)
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for other, forget in _forgets.items():
                if other != operator:
                    forget()
            return_memory()
            try:
                yield from kernel(batches)
            finally:
                return_memory()

        return run

    return decorated


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, or a longer name that no column of ``df`` has (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def row_key(id_column: str, text_column: str) -> Column:
    """A 64-bit hash of a row's id and text, to find the row again."""
    return F.xxhash64(F.col(f"`{id_column}`").cast("string"), F.col(f"`{text_column}`").cast("string"))


def fold(df: DataFrame, kernel: Callable[[Iterator[pa.RecordBatch]], np.ndarray],
         merge: Callable[[np.ndarray, np.ndarray], np.ndarray], zero: np.ndarray, depth: int = 2) -> np.ndarray:
    """One array of fixed size from all of ``df``: ``kernel`` makes an array of
    each partition, ``merge`` joins two in a tree of tasks.  The driver gets
    a few arrays of ``zero``'s size, however many rows there are: fewer if ``depth`` is more."""
    dtype = zero.dtype

    @lean("fold")
    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = zlib.compress(np.ascontiguousarray(kernel(batches), dtype), 1)
        yield pa.RecordBatch.from_pydict({"part": pa.array([packed], pa.binary())})

    def unpack(rows: Iterator) -> Iterator[np.ndarray]:
        for row in rows:
            yield np.frombuffer(zlib.decompress(row.part), dtype)
        return_memory()

    parts = df.mapInArrow(part, "part binary").rdd.mapPartitions(unpack)
    return parts.treeAggregate(zero, merge, merge, depth)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every output bit depends on every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _slots(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


def filter_bits(count: int, most: int = 1 << 27) -> int:
    """Bits of a filter for ``count`` keys: sixteen each, one megabyte at least, 16 at most."""
    return min(max(FILTER_BITS, 1 << (16 * count).bit_length()), most)


def key_filter(keys: DataFrame, bits: int = FILTER_BITS, depth: int = 2) -> np.ndarray:
    """A bit per slot of the long values of ``keys``' only column.  The filter
    has a fixed size; when it fills up it lets more rows through, so it may
    only stand before an exact join."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        packed = np.zeros(bits // 8, np.uint8)  # an eighth of a flag for each
        for batch in batches:
            for slot in _slots(batch.column(0).drop_null().to_numpy(zero_copy_only=False), bits):
                np.bitwise_or.at(packed, slot >> 3, (128 >> (slot & 7)).astype(np.uint8))
        return packed

    return fold(keys, kernel, np.bitwise_or, np.zeros(bits // 8, np.uint8), depth)


def in_filter(packed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` may be in the filter (no key that is in it is missed)."""
    if not len(keys):
        return np.zeros(0, bool)
    found = np.ones(len(keys), bool)
    for slot in _slots(keys, len(packed) * 8):
        found &= (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 > 0
    return found


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected ``links``: rows ``(node, label)`` for
    every linked node, ``label`` the smallest node reachable.

    Each round hooks every node to its smallest neighbour, follows the hooks to
    their ends by doubling, and contracts the links to links between those ends;
    a long path is halved at each doubling.  Frames are cut between rounds.  A
    hub is pre-aggregated on the map side and its links are spread by the skew
    join.
    """
    edges = cut(links.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
                .where("u < v").distinct())
    labels = cut(edges.select(F.explode(F.array("u", "v")).alias("node")).distinct()
                 .withColumn("label", F.col("node")))
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        written = cut(both.groupBy("u").agg(F.min("v").alias("r"))
                      .select("u", F.least("u", "r").alias("r")))
        while True:
            ends = written.select("u", "r")
            beyond = ends.select(F.col("u").alias("r"), F.col("r").alias("next"))
            further = cut(ends.join(beyond, "r").select("u", F.col("next").alias("r"),
                                                        (F.col("next") != F.col("r")).alias("moved")))
            moved = not further.where("moved").isEmpty()
            release(written)
            written = further
            if not moved:
                break
        ends = written.select("u", "r")
        named = cut(labels.join(ends.select(F.col("u").alias("label"), "r"), "label", "left")
                    .select("node", F.coalesce("r", "label").alias("label")))
        left = cut(edges.join(ends.select("u", F.col("r").alias("ru")), "u")
                   .join(ends.select(F.col("u").alias("v"), F.col("r").alias("rv")), "v")
                   .select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v"))
                   .where("u < v").distinct())
        release(labels, edges, written)
        labels, edges = named, left
    release(edges)
    return labels


def connect(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (as of ``components``) after more ``links``: only the links
    between the labels held are worked on.  No links leave the labels as they are."""
    if links.isEmpty():
        return labels
    for end in ("a", "b"):
        held = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_label"))
        links = links.join(held, end, "left").withColumn(end, F.coalesce(f"{end}_label", end)).select("a", "b")
    found = components(links)
    moved = labels.join(found.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left")
    out = cut(moved.select("node", F.coalesce("to", "label").alias("label"))
              .unionByName(found.join(labels.select("node"), "node", "left_anti")))
    release(found)
    return out


def runs(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows of sorted ``batches`` in whole groups of equal ``keys``: one table
    of many groups at a time, the last group of a batch carried on."""
    held: list[pa.RecordBatch] = []

    def ident(batch: pa.RecordBatch, i: int) -> tuple:
        return tuple(batch.column(k)[i].as_py() for k in keys)

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and ident(held[-1], held[-1].num_rows - 1) != ident(batch, 0):
            yield pa.Table.from_batches(held)
            held = []
        starts = group_starts([batch.column(k).to_numpy(zero_copy_only=False) for k in keys])
        last = int(starts[-1])
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def group_starts(columns: list[np.ndarray]) -> np.ndarray:
    """Where a new group begins in columns sorted by all of them."""
    change = np.zeros(len(columns[0]), bool)
    change[:1] = True
    for c in columns:
        change[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(change)


def partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
