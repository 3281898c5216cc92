"""Source divergence audit: which sources of a language use words alike, and the
terms by which each departs from its language.

The count matrix of a language has a row for each of its sources and a column
for each kept term; most of it is zero.  It is cut into tiles of ``ROWS`` x ``ROWS``
rows (two blocks of sources) by about ``COLS`` columns.  In a task a tile
becomes a quadtree with a fan-out of two by two: a quadrant without a count has no node.
Pairs of sources are priced by walking two rows of quadrants of the tree jointly: where both are
zero, the quadrant costs its width times the difference of the two probabilities
of a zero count, whatever its size; only leaves that hold a count in one of the two are
compared cell by cell.  The tiles' sums add up to the distance.

Texts are counted in one pass; a task keeps at most ``HELD`` terms before it hands partial
counts on, so the shuffle sees a term of a source once a task, not once an
occurrence.  All arithmetic is on integers; counts may go up to 9e18 / 1e3.

Defined results: null text, language or source count as ''.  Every group that has a row is
reported, also one without any term; a language with one source has no ``pair`` rows.
Repeated rows count as often as they occur.  Ties go by the item's UTF-8 order.  Extra
columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, group_starts, partitions, release, runs

MIN_DOCS = 30
TOP_TERMS = 50
#: Added to every count, and what a probability of one is worth.
PRIOR = 5
SCALE = 1_000_000_000
#: Sources and terms of a tile; cells of a leaf's side.
ROWS = 256
COLS = 1024
LEAF = 16
#: Parts that a language's terms are dealt in when they meet its totals.
PARTS = 64
#: Terms that a task holds before it hands its counts on; bytes of text taken at a time.
HELD = 1 << 18
SLICE = 1 << 20

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
#: A-Z to a-z, all other letters (and every byte of a wider character) as they are, the rest space.
_FOLD = bytes(ord(chr(b).lower()) if b < 128 and b in _LETTERS else b if b in _LETTERS else 32 for b in range(256))


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, slice by slice."""
    at = 0
    while at < len(text):
        end = min(at + SLICE, len(text))
        part = text[at:end].translate(_FOLD)
        while end < len(text) and part.rfind(b" ") < 1:  # a term longer than a slice
            more = text[end:end + SLICE].translate(_FOLD)
            part += more
            end += len(more)
        if end < len(text):
            stop = part.rfind(b" ")
            end -= len(part) - stop
            part = part[:stop]
        yield part.split()
        at = end


_COUNTS = "lang string, source string, term string, n long, docs long"


def _count(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each group's terms, handed on whenever more than ``most``
    terms are held; a row without a term for each group."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(n) + 1)), pa.array([source] * (len(n) + 1)),
                 pa.array([None, *(t.decode() for t in n)], pa.string()),
                 pa.array([0, *n.values()], pa.int64()), pa.array([0, *(docs[t] for t in n)], pa.int64())],
                names=["lang", "source", "term", "n", "docs"])
        held.clear()

    size = 0
    for batch in batches:
        text = batch.column("text")
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
        for i, group in enumerate(groups):
            n, docs = held.setdefault(group, (Counter(), Counter()))
            before, seen = len(n), set()
            for found in terms(text[i].as_buffer().to_pybytes()):
                n.update(found)
                seen.update(found)
            docs.update(seen)
            size += len(n) - before
            if size > most:
                yield from counted()
                size = 0
    yield from counted()


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / total), exactly; 0 where nothing is kept."""
    wide = (count + PRIOR).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = F.call_function("div", wide, total.cast("decimal(19,0)"))
    return F.when(total > 0, whole + 1).otherwise(0).cast("long")


class Quadtree:
    """The quadrants of a tile that hold a count.  ``rows``, ``cols`` and ``p`` are
    its entries, ``floor`` each row's probability of a zero count, ``width`` the columns."""

    def __init__(self, rows: np.ndarray, cols: np.ndarray, p: np.ndarray, floor: np.ndarray, width: int):
        self.floor, self.width = floor, width
        self.side = LEAF
        while self.side < max(len(floor), width):
            self.side *= 2
        self.levels = {}
        size = self.side
        while size >= LEAF:
            self.levels[size] = np.unique((rows // size) * (self.side // size) + cols // size)
            size //= 2
        padded = np.zeros(self.side, np.int64)
        padded[:len(floor)] = floor
        self.zero = np.repeat(padded[:, None], LEAF, 1).reshape(-1, LEAF, LEAF)
        codes = self.levels[LEAF]
        self.leaves = self.zero[codes // (self.side // LEAF)].copy()
        where = np.searchsorted(codes, (rows // LEAF) * (self.side // LEAF) + cols // LEAF)
        self.leaves[where, rows % LEAF, cols % LEAF] = p

    def holds(self, size: int, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        codes = self.levels[size]
        wanted = row * (self.side // size) + col
        at = np.minimum(np.searchsorted(codes, wanted), max(len(codes) - 1, 0))
        return codes[at] == wanted if len(codes) else np.zeros(len(row), bool)

    def leaf(self, row: np.ndarray, col: np.ndarray) -> np.ndarray:
        out = self.zero[row]
        held = self.holds(LEAF, row, col)
        codes = row * (self.side // LEAF) + col
        out[held] = self.leaves[np.searchsorted(self.levels[LEAF], codes[held])]
        out[np.broadcast_to((col[:, None] * LEAF + np.arange(LEAF) >= self.width)[:, None, :], out.shape)] = 0
        return out

    def distances(self, split: int = 0) -> np.ndarray:
        """Sums over the columns of |p_a - p_b| for rows a < b; with ``split`` only
        those with a before it and b from it on are worked out."""
        n = len(self.floor)
        blocks = self.side // LEAF
        total = np.zeros((blocks, blocks, LEAF, LEAF), np.int64)
        empty = np.zeros((self.side, self.side), np.int64)  # columns where both rows are in an empty quadrant
        a = b = c = np.zeros(1, np.int64)
        size = self.side
        while True:
            inside = (a <= b) & (a * size < n) & (b * size < n) & (c * size < self.width)
            if split:
                inside &= (a * size < split) & ((b + 1) * size > split)
            a, b, c = a[inside], b[inside], c[inside]
            live = self.holds(size, a, c) | self.holds(size, b, c)
            wide = np.minimum((c + 1) * size, self.width) - c * size
            price = np.zeros((self.side // size, self.side // size), np.int64)
            np.add.at(price, (a[~live], b[~live]), wide[~live])
            empty += np.repeat(np.repeat(price, size, 0), size, 1)
            a, b, c = a[live], b[live], c[live]
            if size == LEAF or not len(a):
                break
            size //= 2
            a, b, c = (np.concatenate([2 * x + (k >> shift & 1) for k in range(8)])
                       for shift, x in ((0, a), (1, b), (2, c)))
        for k in range(0, len(a) if size == LEAF else 0, 256):
            x, y, z = a[k:k + 256], b[k:k + 256], c[k:k + 256]
            apart = np.abs(self.leaf(x, z)[:, :, None, :] - self.leaf(y, z)[:, None, :, :]).sum(3)
            np.add.at(total, (x, y), apart)
        total = total.transpose(0, 2, 1, 3).reshape(self.side, self.side)[:n, :n]
        return total + empty[:n, :n] * np.abs(self.floor[:, None] - self.floor[None])


_TILE = ["lang", "block", "low", "high"]


def _tile_distances(batches: Iterator[pa.RecordBatch], side: int) -> Iterator[pa.RecordBatch]:
    """Sums of a tile of blocks of ``side`` sources, for each pair of its sources."""
    for table in runs(batches, _TILE):
        col = {k: table.column(k).to_numpy() for k in (*_TILE, "row", "col", "p", "width")}
        starts = group_starts([col[k] for k in _TILE])
        for s, e in zip(starts, [*starts[1:], len(col["row"])]):
            low, high = int(col["low"][s]), int(col["high"][s])
            row = col["row"][s:e] - low * side  # the second block of sources follows the first
            row = np.where(row < side, row, row - (high - low - 1) * side) if high > low else row
            mark = col["col"][s:e] < 0
            floor = np.zeros(int(row.max()) + 1, np.int64)
            floor[row[mark]] = col["p"][s:e][mark]
            tree = Quadtree(row[~mark], col["col"][s:e][~mark].astype(np.int64), col["p"][s:e][~mark], floor,
                            int(col["width"][s:e].max()))
            apart = tree.distances(side if high > low else 0)
            if high > low:
                x, y = (v.ravel() for v in np.mgrid[0:side, side:len(floor)])
            else:
                x, y = np.triu_indices(len(floor), 1)
            if not len(x):
                continue
            yield pa.RecordBatch.from_arrays(
                [pa.array([col["lang"][s]] * len(x), pa.string()), pa.array((x + low * side).astype(np.int32)),
                 pa.array(np.where(y < side, y + low * side, y + (high - 1) * side).astype(np.int32)),
                 pa.array(apart[x, y])], names=["lang", "a", "b", "value"])


def source_divergence(docs: DataFrame, group_column: str = "lang", member_column: str = "source",
                      text_column: str = "text", min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``.  Part ``pair``: for each two members of a
    group (sources of a language) the sum over the group's kept terms of the difference
    of their probabilities, farthest first.  Part ``term``: the ``top`` terms that a member
    has oftener than its group."""

    def plain(name: str) -> Column:
        return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))

    docs = docs.select(plain(group_column).alias("lang"), plain(member_column).alias("source"),
                       plain(text_column).alias("text"))
    counts = cut(docs.mapInArrow(partial(_count, most=HELD), _COUNTS).groupBy("lang", "source", "term")
                 .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    kept = (counts.where("term is not null").groupBy("lang", "term")
            .agg(F.sum("docs").alias("docs"), F.sum("n").alias("total")).where(F.col("docs") >= min_docs))
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
    # Dealt by language and a part of its terms, so one language's terms are not one task's.
    part = F.expr(f"cast(pmod(xxhash64(term), {PARTS}) as int)")
    blocks = langs.select("lang", F.expr(f"cast(ceil(v / {COLS}) as int)").alias("blocks"),
                          F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"))
    kept = (kept.withColumn("part", part).join(blocks, ["lang", "part"]).drop("part")
            .withColumn("block", F.expr("cast(pmod(xxhash64(term), blocks) as int)"))
            .withColumn("col", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1))
    entries = cut(counts.where("term is not null").drop("docs")
                  .join(kept.select("lang", "term", "total", "block", "col"), ["lang", "term"]))
    groups = (counts.where("term is null").select("lang", "source")
              .join(entries.groupBy("lang", "source").agg(F.sum("n").alias("own_n")), ["lang", "source"], "left")
              .join(langs, "lang", "left").na.fill(0, ["own_n", "v", "lang_n"])
              .withColumn("row", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
              .withColumn("members", F.count("*").over(Window.partitionBy("lang")).cast("int"))
              .withColumn("own_m", F.col("own_n") + PRIOR * F.col("v"))
              .withColumn("lang_m", F.col("lang_n") + PRIOR * F.col("v")))
    groups = cut(groups)

    placed = (entries.join(groups.select("lang", "source", "row", "members", "own_m", "lang_m"), ["lang", "source"])
              .withColumn("p", _share(F.col("n"), F.col("own_m"))))
    pairs = _pairs(placed, groups, entries)

    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = (placed.withColumn("q", _share(F.col("total"), F.col("lang_m"))).where("n > 0 and p > q")
              .select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
              .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= top))
    told = [part.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
            for name, part in (("pair", pairs.withColumn("rank", F.row_number().over(own))), ("term", ranked))]
    release(counts)
    return told[0].unionByName(told[1])


def _pairs(placed: DataFrame, groups: DataFrame, entries: DataFrame) -> DataFrame:
    """``lang, source, item, value`` for both orders of each pair."""
    size = F.expr(f"cast(floor(row / {ROWS}) as int)")
    others = F.expr(f"sequence(0, cast(floor((members - 1) / {ROWS}) as int))")

    def dealt(rows: DataFrame) -> DataFrame:
        both = rows.withColumn("own", size).withColumn("other", F.explode(others))
        return both.select("lang", "block", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                           "row", "col", "p", "width")

    widths = entries.groupBy("lang", "block").agg(F.countDistinct("col").cast("int").alias("width"))
    marks = (groups.withColumn("block", F.explode(F.expr(f"sequence(0, greatest(cast(ceil(v / {COLS}) as int), 1) - 1)")))
             .join(widths, ["lang", "block"], "left").na.fill(0, ["width"])
             .withColumn("col", F.lit(-1)).withColumn("p", _share(F.lit(0), F.col("own_m"))))
    tiles = (dealt(placed.withColumn("width", F.lit(0))).unionByName(dealt(marks))
             .repartition(partitions(groups), *_TILE).sortWithinPartitions(*_TILE))
    sums = (tiles.mapInArrow(partial(_tile_distances, side=ROWS), "lang string, a int, b int, value long")
            .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    both = sums.select("lang", F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
                       .alias("two"), "value").select("lang", "two.a", "two.b", "value")
    names = groups.select("lang", F.col("row").alias("a"), "source")
    return (both.join(names, ["lang", "a"])
            .join(names.withColumnRenamed("a", "b").withColumnRenamed("source", "item"), ["lang", "b"])
            .select("lang", "source", "item", "value"))


#: DuckDB: every kept term of every group, and every two groups of a language.
DIVERGENCE_SQL = """
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS doc,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words
  FROM documents
),
words AS (SELECT lang, source, doc, unnest(words) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words GROUP BY ALL),
kept AS (SELECT lang, term FROM words GROUP BY ALL HAVING count(DISTINCT doc) >= 30),
totals AS (SELECT lang, term, sum(n) AS n FROM counts SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM totals GROUP BY ALL),
members AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (
  SELECT lang, source, sum(n) AS n FROM counts SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
cells AS (
  SELECT m.lang, m.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (t.n + 5)) // (l.n + 5 * l.v) AS q
  FROM members AS m JOIN kept AS k USING (lang) JOIN langs AS l USING (lang)
  JOIN totals AS t ON t.lang = m.lang AND t.term = k.term
  LEFT JOIN counts AS c ON c.lang = m.lang AND c.source = m.source AND c.term = k.term
  LEFT JOIN sizes AS s ON s.lang = m.lang AND s.source = m.source
),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM cells AS a JOIN cells AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
told AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0)::BIGINT AS value
  FROM members AS a JOIN members AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart AS x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM cells WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM told QUALIFY part = 'pair' OR rank <= 50
"""
