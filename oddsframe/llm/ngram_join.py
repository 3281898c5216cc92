"""N-gram Jaccard join: size-banded tiles with hashed bitmap signatures.

Every text becomes its set of distinct word shingles; equal sets are one
class.  The join goes through *tiles*: two sets that link must share one of
the first ``n - ceil(t * n) + 1`` shingles in any common order, so each class
enters the tiles of those shingles only.  In the order, shingles that many
documents hold come last (a fixed-size count sketch over the whole table tells
which), so a line or passage that a third of the documents share makes no
tile.  Tiles with one class, or whose classes are connected already, are
dropped by an aggregate before any set is moved.

In a tile each class has a bitmap whose width goes by its size band and whose
bits are the parities of its hashed shingles.  The count of differing bits
bounds the overlap from above; size and bound discard most pairs, and the rest
are decided by intersecting the sorted shingle arrays.

Large groups of near copies are joined in three passes.  (1) Each class is
placed in one tile and proposes its best partner.  (2) In all tiles each class
proposes its best partner outside its component.  (3) Every remaining pair
between different components is decided.  No link between components is missed,
and the pairs inside a component are never listed.  Tiles over ``block``
classes are dealt out in blocks; the members outside the tile's largest
component visit every block.

Defined results: null and blank texts have an empty set and link with nothing
(``component_id`` is their own id).  Rows with a null id keep their row; they
connect others, but the component takes its name from non-null ids (null if it
has none).  Repeated rows and repeated ids are rows of their own.  Extra columns
are ignored; an empty table gives no rows.  Sets are named by a 64-bit hash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (components, connect, cut, filter_bits, fold, free_name, group_starts, in_filter, key_filter,
                     lean, partitions, release, row_key, runs)
from .words import chunks, shingle_sets

#: Counters of the sketch that tells which shingles many documents hold.
SKETCH_BITS = 18
#: A counter this many standard deviations over the mean marks its shingles frequent.
FREQUENT_SIGMAS = 8
#: Classes of a tile that one task compares at once.
BLOCK = 1024
_CELLS = 1 << 21  # 64-bit words compared at a time
_SMALL = 12  # tiles under this many classes are compared with plain integers


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63)


def prefix_length(n: int, percent: int) -> int:
    """Shingles of a set of ``n`` of which a linked set holds at least one."""
    return n + (-percent * n) // 100 + 1


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles' hashed positions; as many bits as the next
    power of two at the set's size, 64 at least."""
    bits = max(64, 1 << (len(shingles) - 1).bit_length())
    where = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(where, minlength=bits) & 1).astype(np.uint8)).tobytes()


def narrowed(maps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) folded down to ``words`` words."""
    while maps.shape[1] > words:
        half = maps.shape[1] // 2
        maps = maps[:, :half] ^ maps[:, half:]
    return maps


def may_link(na: np.ndarray, nb: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """The largest possible overlap over the smallest possible union, where sizes
    and differing bits allow ``percent``; else 0."""
    most = np.minimum((na + nb - differing) >> 1, np.minimum(na, nb))
    fits = 100 * most >= percent * (na + nb - most)
    return np.where(fits, most / (na + nb - most), 0.0)


def small_tile_pairs(names: list[int], groups: list[int], sizes: list[int], maps: list[bytes],
                     percent: int, every: bool) -> list[tuple[int, int]]:
    """``tile_pairs`` for a few classes, with plain integers."""
    best: dict[int, tuple[float, int]] = {}
    found = []
    for i in range(len(names)):
        for j in range(i + 1, len(names)):
            na, nb = sizes[i], sizes[j]
            if groups[i] == groups[j] or 100 * min(na, nb) < percent * max(na, nb):
                continue
            x, y = int.from_bytes(maps[i]), int.from_bytes(maps[j])
            wide, narrow = max(len(maps[i]), len(maps[j])) * 8, min(len(maps[i]), len(maps[j])) * 8
            if wide > narrow:  # sizes of linked sets are at most one band apart
                if wide > 2 * narrow:
                    continue
                x, y = (x, y) if len(maps[i]) > len(maps[j]) else (y, x)
                x = (x >> narrow) ^ (x & ((1 << narrow) - 1))
            most = min((na + nb - (x ^ y).bit_count()) >> 1, na, nb)
            if 100 * most >= percent * (na + nb - most):
                score = most / (na + nb - most)
                found.append((i, j))
                for a, b in ((i, j), (j, i)):
                    if a not in best or score > best[a][0]:
                        best[a] = score, b
    if not every:
        found = [(a, b) for a, (_, b) in best.items()]
    return [(min(names[a], names[b]), max(names[a], names[b])) for a, b in found]


def tile_pairs(names: np.ndarray, groups: np.ndarray, sizes: np.ndarray, maps: list[bytes],
               percent: int, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a tile's classes in different groups that may link: all of
    them, or each class with its most promising partner."""
    width = np.array([len(m) // 8 for m in maps])
    best, partner = np.zeros(len(names)), np.full(len(names), -1)
    found: list[np.ndarray] = []
    for w in np.unique(width):
        low = np.flatnonzero(width == w)
        near = np.flatnonzero((width == w) | (width == 2 * w))
        if len(near) < 2:
            continue
        right = np.concatenate([narrowed(np.frombuffer(maps[i], np.uint64)[None], w) for i in near])
        left = right[width[near] == w]
        step = max(1, _CELLS // (len(near) * int(w)))
        for k in range(0, len(low), step):
            rows = low[k:k + step]
            differ = np.bitwise_count(left[k:k + step, None, :] ^ right[None]).sum(2, dtype=np.int64)
            score = may_link(sizes[rows][:, None], sizes[near][None], differ, percent)
            score[groups[rows][:, None] == groups[near][None]] = 0
            if every:
                i, j = np.nonzero(score)
                found.append(np.stack([rows[i], near[j]]))
                continue
            for at, of, by in ((rows, near, score), (near, rows, score.T)):
                top = by.argmax(1)
                value = by[np.arange(len(at)), top]
                better = value > best[at]
                best[at[better]], partner[at[better]] = value[better], of[top[better]]
    if not every:
        rows = np.flatnonzero(partner >= 0)
        found = [np.stack([rows, partner[rows]])]
    if not found:
        return names[:0], names[:0]
    i, j = np.concatenate(found, axis=1)
    a, b = np.minimum(names[i], names[j]), np.maximum(names[i], names[j])
    return a, b


def ngram_jaccard_join(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       words: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """One row per document: ``id_column``, ``n_shingles``, ``component_id``
    (smallest id reachable by links), ``class_id`` (equal sets; null for an
    empty set), ``group_id`` (the component, also where it has no id) and
    ``row_key`` (a hash of id and text).  Links need ``100 * overlap >= percent * union``."""
    docs = docs.select(row_key(id_column, text_column).alias("row_key"),
                       F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.col(f"`{text_column}`").cast("string").alias("text"))
    told = cut(docs.mapInArrow(_describe(words), "row_key long, id long, cls long, n int, sketch binary"))
    sets = told.where("sketch is null").drop("sketch")
    frequent = _frequent(told.where("sketch is not null").select("sketch"))

    kind = "shingle long, cls long"
    shared = cut(docs.select("text").mapInArrow(_prefixes(words, percent, frequent), kind)
                 .groupBy("shingle").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi"))
                 .where("lo < hi").select("shingle"))
    # Most shingles are of one class; the filter holds them back before the exact join.
    held = key_filter(shared, filter_bits(shared.count()))
    live = cut(docs.select("text").mapInArrow(_prefixes(words, percent, frequent, held), kind)
               .join(shared, "shingle").distinct())
    release(shared)
    classes = cut(live.groupBy("cls").agg(F.min("shingle").alias("shingle")))
    wanted = key_filter(classes.select("cls"), filter_bits(classes.count()))
    maps = cut(docs.select("text").mapInArrow(_bitmaps(words, wanted), "cls long, n int, map binary")
               .dropDuplicates(["cls"]))

    def decide(pairs: DataFrame) -> DataFrame:
        pairs = cut(pairs.distinct())
        if pairs.isEmpty():
            return pairs
        ends = pairs.select(F.explode(F.array("a", "b")).alias("cls"))
        needed = key_filter(ends, filter_bits(2 * pairs.count()))
        arrays = cut(docs.select("text").mapInArrow(_arrays(words, needed), "cls long, n int, items binary")
                     .dropDuplicates(["cls"]).drop("n"))
        both = (pairs.join(arrays.select(F.col("cls").alias("a"), F.col("items").alias("left")), "a")
                .join(arrays.select(F.col("cls").alias("b"), F.col("items").alias("right")), "b"))
        links = cut(both.mapInArrow(_intersect(percent), "a long, b long"))
        release(pairs, arrays)
        return links

    def propose(tiles: DataFrame, every: bool) -> DataFrame:
        tiles = tiles.join(maps, "cls").repartition(partitions(docs), "shingle", "block")
        return (tiles.sortWithinPartitions("shingle", "block")
                .mapInArrow(_tiles(percent, every), "a long, b long"))

    # 1: one tile for each class.
    # Counts are written, so that a join with them can split a hot tile.
    count = cut(classes.groupBy("shingle").agg(F.count("*").alias("m")).where("m > 1"))
    dealt = (classes.join(count, "shingle")
             .select("shingle", "cls", F.col("cls").alias("label"),
                     F.expr(f"pmod(xxhash64(cls), ceil(m / {block}))").cast("int").alias("block")))
    labels = components(decide(propose(dealt, False)))
    release(classes, count)
    # 2: best partners outside the component; 3: all that is left.
    for every in (False, True):
        labels = connect(labels, decide(propose(_mixed_tiles(live, labels, block), every)))
    release(live, maps)

    named = sets.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn(
        "label", F.coalesce("label", "cls"))
    smallest = cut(named.where("label is not null").groupBy("label")
                   .agg(F.min("id").alias("component")))
    return (named.join(smallest, "label", "left")
            .select(F.col("id").alias(id_column), F.col("n").cast("long").alias("n_shingles"),
                    F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("component"))
                    .alias("component_id"), F.col("cls").alias("class_id"),
                    F.coalesce("label", F.xxhash64("row_key")).alias("group_id"), "row_key"))


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id (then of the
    smallest row hash; rows equal in id and text count once).  Rows without
    words are in no group and all stay."""
    key = free_name(docs, "row_key")
    found = ngram_jaccard_join(docs, id_column, text_column, **options)
    order = F.struct(F.col(id_column).isNull().alias("unnamed"), F.col(id_column).alias("id"), "row_key")
    chosen = (found.where("n_shingles > 0").groupBy("group_id").agg(F.min(order).alias("best"))
              .select(F.col("best.row_key").alias(key)))
    keyed = docs.withColumn(key, row_key(id_column, text_column))
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    worded = text.rlike("[^ \\t\\n\\x0B\\f\\r]")
    kept = keyed.where(worded).join(cut(chosen), key, "left_semi").dropDuplicates([key])
    return kept.unionByName(keyed.where(~worded)).select(*[F.col(f"`{c}`") for c in docs.columns])


def _mixed_tiles(live: DataFrame, labels: DataFrame, block: int) -> DataFrame:
    """Rows of the tiles that hold more than one component.  In a tile of more
    than ``block`` classes the members of its largest component stay in their own
    block; the others go to every block."""
    rows = (live.join(labels.withColumnRenamed("node", "cls"), "cls", "left")
            .withColumn("label", F.coalesce("label", "cls")))
    tiles = cut(rows.groupBy("shingle", "label").agg(F.count("*").alias("m"))
                .groupBy("shingle").agg(F.sum("m").alias("m"), F.count("*").alias("labels"),
                                        F.max(F.struct("m", "label")).alias("top"))
                .where("labels > 1")
                .select("shingle", F.col("top.label").alias("main"),
                        F.expr(f"cast(ceil(m / {block}) as int)").alias("blocks")))
    own = F.expr("cast(pmod(xxhash64(cls), blocks) as int)")
    where = F.when((F.col("blocks") == 1) | (F.col("label") == F.col("main")), F.array(own)).otherwise(
        F.sequence(F.lit(0), F.col("blocks") - 1))
    return rows.join(tiles, "shingle").select("shingle", "cls", "label", F.explode(where).alias("block"))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[Iterator[np.ndarray]]:
    """The sets of each chunk of texts."""
    text = batch.column("text")
    for first, last in chunks(text):
        yield shingle_sets(text.slice(first, last - first), words)


def _describe(words: int):
    """A row for each document, and one with the counts of a task's shingles."""
    size = 1 << SKETCH_BITS

    @lean("ngram_join")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        names = ["row_key", "id", "cls", "n", "sketch"]
        for batch in batches:
            rows, held = [], [np.zeros(0, np.int64)]
            for s in chain.from_iterable(_sets(batch, words)):
                rows.append((class_of(s) if len(s) else None, len(s)))
                held.append((s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64))
                if len(held) > 1000:
                    counts += np.bincount(np.concatenate(held), minlength=size)
                    held = held[:1]
            counts += np.bincount(np.concatenate(held), minlength=size)
            yield pa.RecordBatch.from_arrays([
                batch.column("row_key"), batch.column("id"), pa.array([c for c, _ in rows], pa.int64()),
                pa.array([n for _, n in rows], pa.int32()), pa.nulls(len(rows), pa.binary())], names=names)
        packed = zlib.compress(counts.tobytes(), 1)
        yield pa.RecordBatch.from_arrays([pa.array([None], t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.int32())]
                                         + [pa.array([packed], pa.binary())], names=names)

    return kernel


def _frequent(sketches: DataFrame) -> np.ndarray:
    """A flag for each sketch counter: far more documents than the mean."""
    size = 1 << SKETCH_BITS

    def kernel(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0):
                counts += np.frombuffer(zlib.decompress(packed.as_buffer()), np.int64)
        return counts

    counts = fold(sketches, kernel, np.add, np.zeros(size, np.int64))
    return counts > counts.mean() + FREQUENT_SIGMAS * np.sqrt(counts.mean() + 1)


def _prefixes(words: int, percent: int, frequent: np.ndarray, held: np.ndarray | None = None):
    """The shingles by which a class enters tiles, all or those that ``held`` may hold."""

    @lean("ngram_join")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # classes of this task: copies add nothing
        for batch in batches:
            for sets in _sets(batch, words):
                names, parts = [], []
                for s in sets:
                    if not len(s) or (name := class_of(s)) in seen:
                        continue
                    seen.add(name)
                    late = frequent[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    names.append(name)
                    parts.append(np.concatenate([s[~late], s[late]])[:prefix_length(len(s), percent)])
                    if held is not None:
                        parts[-1] = parts[-1][in_filter(held, parts[-1].view(np.int64))]
                if names:
                    yield pa.RecordBatch.from_pydict({
                        "shingle": pa.array(np.concatenate(parts).view(np.int64)),
                        "cls": pa.array(np.repeat(np.array(names, np.int64), [len(p) for p in parts]))})

    return kernel


def _of_classes(words: int, wanted: np.ndarray, column: str, made):
    @lean("ngram_join")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            text = batch.column("text")
            for first, last in chunks(text):  # only a chunk's sets are held at once
                sets = [s for s in shingle_sets(text.slice(first, last - first), words) if len(s)]
                names = np.array([class_of(s) for s in sets], np.int64)
                rows = []
                for name, s, keep in zip(names.tolist(), sets, in_filter(wanted, names)):
                    if keep and name not in seen:
                        seen.add(name)
                        rows.append((name, s))
                yield pa.RecordBatch.from_pydict({
                    "cls": pa.array([n for n, _ in rows], pa.int64()),
                    "n": pa.array([len(s) for _, s in rows], pa.int32()),
                    column: pa.array([made(s) for _, s in rows], pa.binary())})

    return kernel


def _bitmaps(words: int, wanted: np.ndarray):
    return _of_classes(words, wanted, "map", parity_bitmap)


def _arrays(words: int, wanted: np.ndarray):
    return _of_classes(words, wanted, "items", np.ndarray.tobytes)


def _tiles(percent: int, every: bool):
    @lean("ngram_join")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, ["shingle", "block"]):
            col = {k: table.column(k).to_numpy() for k in ("shingle", "block", "cls", "label", "n")}
            maps = table.column("map").to_pylist()
            starts = group_starts([col["shingle"], col["block"]])
            pairs = []
            plain = {k: col[k].tolist() for k in ("cls", "label", "n")}
            small: list[tuple[int, int]] = []
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(maps)]):
                if b - a in range(2, _SMALL):
                    small += small_tile_pairs(plain["cls"][a:b], plain["label"][a:b], plain["n"][a:b], maps[a:b],
                                              percent, every)
                elif b - a > 1:
                    pairs.append(tile_pairs(col["cls"][a:b], col["label"][a:b],
                                            col["n"][a:b].astype(np.int64), maps[a:b], percent, every))
            if small:
                pairs.append(tuple(np.array(small, np.int64).T))
            if pairs:
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(np.concatenate([p[0] for p in pairs])),
                    "b": pa.array(np.concatenate([p[1] for p in pairs]))})

    return kernel


def _intersect(percent: int):
    @lean("ngram_join")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x = np.frombuffer(left.as_buffer(), np.uint64)
                y = np.frombuffer(right.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return kernel


#: DuckDB: all pairs that share a shingle.
NGRAM_SQL = """
WITH RECURSIVE doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5
                               THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                               WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
    FROM doc_words)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared_counts AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
),
links AS (
  SELECT x, y FROM shared_counts JOIN sizes AS a ON a.doc_id = x JOIN sizes AS b ON b.doc_id = y
  WHERE 100 * shared >= 80 * (a.n + b.n - shared)
),
reached AS (
  SELECT doc_id AS node, doc_id AS label FROM documents
  UNION
  SELECT y, label FROM reached JOIN links ON node = x
),
smallest AS (SELECT node AS doc_id, min(label) AS component_id FROM reached GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM doc_words LEFT JOIN sizes USING (doc_id) JOIN smallest USING (doc_id)
"""
