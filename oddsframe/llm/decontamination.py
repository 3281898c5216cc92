"""Benchmark decontamination: SimHash fingerprints of item-sized windows.

Words are runs of letters and digits, lower-cased.  For each benchmark item of
``m`` words, windows of ``m`` words of the documents are fingerprinted (64-bit
SimHash of their words) and matched with the items' fingerprints by multi-index
Hamming blocks: with ``radius + 1`` blocks, two fingerprints within the radius
agree on one block at least, so an equi-join on the blocks misses none of them.
Survivors are verified by the weighted Jaccard similarity of their five-word
shingles (each counted as often as it occurs): ``threshold`` or more.

Every window that can reach the threshold is fingerprinted.  A window of similarity ``threshold``
holds at least ``need = ceil(threshold * n)`` places whose shingle is one of the item's ``n``, so the
windows looked at are those around ``need`` such places within ``n`` of each other: whole
ranges of starts, not only those that put a shared shingle at its own place.  The places come from a join of
all documents with the items' shingles, which are broadcast when few (``BROADCAST_SHINGLES``,
counted before) and shuffled otherwise; document and item with fewer than ``need``
places go no further.  DataFrame functions only.

Defined results: null and wordless texts and items match nothing.  Items of fewer
than five words count as one shingle.  Null ids are compared like any
other; repeated rows get equal results; repeated item ids are judged each by its
own text.  Extra columns are ignored; an empty table gives no rows.  Rows are told
apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, filter_bits, free_name, release, row_key

SHINGLE = 5
THRESHOLD = 0.8
#: Differing fingerprint bits that are let through to the exact check.
RADIUS = 15
#: Distinct item shingles up to which they are sent to every task (24 bytes each).
BROADCAST_SHINGLES = 500_000
_BITS = 64


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)),
                      F.array().cast("array<string>"))


def shingles_of(words: str, n: int) -> Column:
    """Hashes of all runs of ``n`` words of the array column ``words``."""
    place = F.sequence(F.lit(0), F.size(words) - n)
    run = F.transform(place, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(n)]))
    return F.when(F.size(words) >= n, run).otherwise(F.array().cast("array<bigint>"))


def _short_or_five(words: str, sizes: Sequence[int]) -> Column:
    """Shingles of an array of words: of ``SHINGLE`` words, or all as one."""
    out = F.array().cast("array<bigint>")
    for n in sizes:
        out = F.when(F.least(F.size(words), F.lit(SHINGLE)) == n, shingles_of(words, n)).otherwise(out)
    return out


def simhash(rows: DataFrame, keys: Sequence[str], words: str) -> DataFrame:
    """``keys`` with the 64-bit SimHash ``print`` of the words in ``words``."""
    h = F.xxhash64("word")
    votes = [F.sum(F.when(F.getbit("h", F.lit(b)) == 1, 1).otherwise(-1)).alias(f"b{b}") for b in range(_BITS)]
    bits = F.lit(0).cast("long")
    for b in range(_BITS):
        bits = bits.bitwiseOR(F.when(F.col(f"b{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63)).cast("long"))
                              .otherwise(F.lit(0).cast("long")))
    return (rows.select(*keys, F.explode(words).alias("word")).withColumn("h", h)
            .groupBy(*keys).agg(*votes).select(*keys, bits.alias("print")))


def hamming_blocks(radius: int) -> list[tuple[int, int]]:
    """Offset and width of ``radius + 1`` blocks that cover the fingerprint."""
    edges = [_BITS * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _blocks(radius: int) -> Column:
    return F.array(*[F.struct(F.lit(i).alias("no"),
                              F.shiftrightunsigned("print", a).bitwiseAND(F.lit((1 << w) - 1)).alias("bits"))
                     for i, (a, w) in enumerate(hamming_blocks(radius))])


def with_flag(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with the boolean ``flag``: whether the long ``key`` may be one of ``keys`` (of its only
    column; none that is gets false).  The bitmaps that tell are sent to every task: one megabyte,
    16 at most, whatever ``keys`` holds.  What may be is for an exact join to decide; the rest need not move."""
    size = F.lit(filter_bits(keys.count()))
    slot = F.pmod(F.col(f"`{keys.columns[0]}`"), size) + 1
    maps = (keys.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
            .groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map")))
    bucket, bits = free_name(rows, "bucket"), free_name(rows, "map")
    maps = maps.withColumnsRenamed({"bucket": bucket, "map": bits})
    slot = F.pmod(F.col(f"`{key}`"), size) + 1
    bit = F.bitmap_bit_position(slot).cast("int")
    byte = F.conv(F.hex(F.substring(F.col(bits), F.shiftright(bit, 3) + 1, 1)), 16, 10).cast("int")
    told = F.coalesce(F.getbit(byte, bit.bitwiseAND(7)) == 1, F.lit(False))
    return (rows.withColumn(bucket, F.bitmap_bucket_number(slot)).join(F.broadcast(maps), bucket, "left")
            .withColumn(flag, told).drop(bucket, bits))


def contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 item_column: str = "item_id", item_text: str = "text", radius: int = RADIUS,
                 threshold: float = THRESHOLD) -> DataFrame:
    """``row_key, id, item, start, differing, similarity``: each document with
    each item it holds, at its best window (``start`` counts words from 0)."""
    items = (benchmark.select(F.col(f"`{item_column}`").alias("item"),
                              words_of(F.col(f"`{item_text}`").cast("string")).alias("words"))
             .withColumn("m", F.size("words")).where("m > 0"))
    items = cut(items.withColumn("ikey", F.xxhash64("item", "words")).distinct())
    sizes = [r[0] for r in items.select(F.least("m", F.lit(SHINGLE))).distinct().collect()]
    items = (items.withColumn("shingles", _short_or_five("words", sizes)).withColumn("n", F.size("shingles"))
             .withColumn("need", F.ceil(F.lit(threshold) * F.col("n") - 1e-9).cast("int")))
    wanted = items.select("ikey", "m", "n", "need", F.explode(F.array_distinct("shingles")).alias("h"))
    few = wanted.count() <= BROADCAST_SHINGLES
    wanted = F.broadcast(wanted) if few else wanted

    rows = docs.select(row_key(id_column, text_column).alias("key"), F.col(f"`{id_column}`").alias("id"),
                       F.col(f"`{text_column}`").cast("string").alias("text"))
    runs = F.array(*[F.struct(shingles_of("words", n).alias("hashes")) for n in sizes or [SHINGLE]])
    found = (rows.select("key", words_of(F.col("text")).alias("words"))
             .select("key", F.explode(runs).alias("run"))
             .select("key", F.posexplode("run.hashes").alias("at", "h")))
    places = (found.join(wanted, "h").groupBy("key", "ikey", "m", "n", "need")
              .agg(F.sort_array(F.collect_set("at")).alias("at")).where(F.size("at") >= F.col("need")))
    # ``need`` places within n shingles: every start from which a window holds them all.
    ranges = F.expr("""flatten(transform(sequence(0, size(at) - need), i ->
        if(at[i + need - 1] - at[i] < n, sequence(greatest(at[i + need - 1] - n + 1, 0), at[i]), array())))""")
    starts = cut(places.select("key", "m", F.explode(ranges).alias("start")).distinct())
    named = starts.select("key").distinct()
    held = cut(with_flag(rows, named, "key", "maybe").where("maybe").drop("maybe")
               .join(named, "key", "left_semi").dropDuplicates(["key"])
               .select("key", "id", words_of(F.col("text")).alias("words")))
    windows = cut(starts.join(held, "key").select(
        "key", "id", "start", "m", F.slice("words", F.col("start") + 1, F.col("m")).alias("window")))

    sign = simhash(windows, ["key", "start", "m"], "window")
    item_sign = simhash(items, ["ikey", "m"], "words")
    item_blocks = item_sign.select("ikey", "m", F.col("print").alias("iprint"),
                                   F.inline(_blocks(radius)).alias("no", "bits"))
    differing = F.bit_count(F.col("print").bitwiseXOR(F.col("iprint")))
    near = (sign.select("key", "start", "m", "print", F.inline(_blocks(radius)).alias("no", "bits"))
            .join(F.broadcast(item_blocks) if few else item_blocks, ["m", "no", "bits"])
            .withColumn("differing", differing).where(F.col("differing") <= radius)
            .select("key", "start", "m", "ikey", "differing").distinct())
    windows = windows.withColumn("wsh", _short_or_five("window", [*range(1, SHINGLE + 1)]))
    own = items.select("ikey", "item", "shingles")
    pairs = cut(near.join(windows.select("key", "id", "start", "m", "wsh"), ["key", "start", "m"])
                .join(F.broadcast(own) if few else own, "ikey"))
    release(starts, held, windows)
    name = ["key", "id", "item", "start", "differing"]
    once = ((F.size(F.array_distinct("wsh")) == F.size("wsh"))
            & (F.size(F.array_distinct("shingles")) == F.size("shingles")))
    shared = F.size(F.array_intersect("wsh", "shingles"))
    plain = pairs.where(once).select(*name, (shared / (F.size("wsh") + F.size("shingles") - shared)).alias("similarity"))
    # Repeated shingles count as often as they occur.
    both = F.concat(F.transform("wsh", lambda h: F.struct(h.alias("h"), F.lit(1).alias("w"), F.lit(0).alias("i"))),
                    F.transform("shingles", lambda h: F.struct(h.alias("h"), F.lit(0).alias("w"), F.lit(1).alias("i"))))
    weighed = (pairs.where(~once).select(*name, "ikey", F.inline(both)).groupBy(*name, "ikey", "h")
               .agg(F.sum("w").alias("w"), F.sum("i").alias("i")).groupBy(*name, "ikey")
               .agg((F.sum(F.least("w", "i")) / F.sum(F.greatest("w", "i"))).alias("similarity")).drop("ikey"))
    best = F.min_by(F.struct("start", "differing", "similarity"), F.struct(-F.col("similarity"), "start"))
    return (plain.unionByName(weighed).where(F.col("similarity") >= threshold)
            .groupBy("key", "id", "item").agg(best.alias("best"))
            .select(F.col("key").alias("row_key"), "id", "item", "best.*"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  **options) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item."""
    bad = cut(contaminated(docs, benchmark, id_column, text_column, **options).select("row_key").distinct())
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, row_key(id_column, text_column))
    flag = free_name(keyed, "maybe")
    told = with_flag(keyed, bad, key, flag)
    kept = told.where(f"`{flag}`").join(bad.withColumnRenamed("row_key", key), key, "left_anti")
    return told.where(f"not `{flag}`").unionByName(kept).select(*[F.col(f"`{c}`") for c in docs.columns])


#: DuckDB: for each document and item with a shared shingle every window.
DECONTAMINATION_SQL = """
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents WHERE text IS NOT NULL
),
item_words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark WHERE text IS NOT NULL
),
doc_shingles AS (
  SELECT doc_id, p, array_to_string(w[p + 1:p + 5], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(0, len(w) - 4)) AS p FROM doc_words WHERE len(w) >= 5)
),
item_shingles AS (
  SELECT item_id, m, q, array_to_string(w[q + 1:q + 5], ' ') AS s
  FROM (SELECT item_id, w, len(w) AS m, unnest(range(0, len(w) - 4)) AS q FROM item_words WHERE len(w) >= 5)
),
windows AS (
  SELECT doc_id, item_id, m, unnest(range(greatest(low - m, 0), high + 1)) AS start
  FROM (SELECT doc_id, item_id, m, min(p) AS low, max(p) AS high
        FROM doc_shingles JOIN (SELECT DISTINCT item_id, m, s FROM item_shingles) USING (s) GROUP BY ALL)
),
counted AS (
  SELECT w.doc_id, w.item_id, w.start, d.s, count(*) AS n
  FROM windows AS w JOIN doc_shingles AS d ON d.doc_id = w.doc_id AND d.p BETWEEN w.start AND w.start + w.m - 5
  GROUP BY ALL
),
item_counts AS (SELECT item_id, s, count(*) AS n FROM item_shingles GROUP BY ALL),
totals AS (SELECT item_id, sum(n) AS n FROM item_counts GROUP BY item_id),
shared_counts AS (
  SELECT c.doc_id, c.item_id, c.start, sum(least(c.n, coalesce(i.n, 0))) AS shared, sum(c.n) AS mine
  FROM counted AS c LEFT JOIN item_counts AS i USING (item_id, s)
  GROUP BY ALL
)
SELECT doc_id, item_id, max(CAST(shared AS DOUBLE) / CAST(mine + n - shared AS DOUBLE)) AS similarity
FROM shared_counts JOIN totals USING (item_id)
WHERE shared >= 0.8 * (mine + n - shared)
GROUP BY doc_id, item_id
"""
