"""Embedding near-dedup with randomised-rotation binary codes.

Unit vectors go through random rotations; the signs of the rotated components
are a vector's code, and the inner product of the vector with its own code is
stored as the correction factor.  For a code ``c`` with factor ``f`` and any
other vector ``q``, ``<c, q> / f`` estimates the inner product without bias, and
its error stays within ``z * sqrt((1 - f * f) / (f * f * (bits - 1)))`` but for a
chance that ``z`` sets.  Only pairs whose upper bound reaches the threshold are
recomputed, from the original components in double precision; links depend on
that value alone.

Candidates are vectors that agree on one band of their code.  The width of a
band grows with the logarithm of the number of vectors, so a bucket holds a few
chance members at any size, and the number of bands follows from the wanted
``recall`` at the threshold.  A pair is taken up in the first band that it
agrees on.  Equal vectors are one class beforehand.  Buckets over ``block``
vectors are dealt out in pairs of blocks: each pair of blocks is a task's work,
and no bucket meets in one task.  A task works on ``PAIRS`` pairs at a time and gives for
each vector how many it links with and one that its links there lead to, not the links.

Defined results: vectors that are null, empty, zero or hold null, NaN or infinite
components link with nothing (``n_links`` 0, ``component_id`` their own id).
Vectors of another length than the most common one are compared with their own
length only.  Rows with a null id keep their row and count as others' links, but
name no component.  Repeated rows are rows of their own, linked to each other.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, cut, group_starts, partitions, runs

#: Chance that a pair at the threshold meets in no band.
MISS = 0.01
#: Standard deviations of the estimate that the bound allows for.
Z = 5.0
#: Vectors of a bucket that one task compares with as many others.
BLOCK = 2048
#: Pairs whose codes and components are compared at once.
PAIRS = 1 << 15
#: Components of vectors that are turned at once.
_TURNED = 1 << 21


def code_shape(count: int, threshold: float, miss: float = MISS) -> tuple[int, int]:
    """Width and number of the bands for ``count`` vectors."""
    width = min(62, max(12, math.ceil(math.log2(max(2, count)))))
    agree = (1 - math.acos(threshold) / math.pi) ** width
    return width, math.ceil(math.log(miss) / math.log(1 - agree))


def rotations(dims: int, bits: int, seed: int) -> np.ndarray:
    """``bits`` rows of stacked random rotations of ``dims`` dimensions, scaled
    so that lengths stay."""
    rng = np.random.Generator(np.random.PCG64([seed, dims]))
    stack = []
    for _ in range(-(-bits // dims)):
        q, r = np.linalg.qr(rng.standard_normal((dims, dims)))
        stack.append(q * np.sign(np.diag(r)))
    return np.concatenate(stack)[:bits] / math.sqrt(bits / dims)


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                 threshold: float = 0.95, block: int = BLOCK, seed: int = 7) -> DataFrame:
    """One row per vector: ``id_column``, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                          F.col(f"`{vector_column}`").cast("array<double>").alias("v"))
    zero = F.lit(0.0)
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < F.lit(math.inf)))
    sound = F.coalesce(finite & F.exists("v", lambda x: x != zero), F.lit(False))
    # -0.0 and 0.0 are the same component.
    rows = cut(rows.select("id", F.when(sound, F.transform("v", lambda x: x + zero)).alias("v"))
               .withColumn("cls", F.when(F.col("v").isNotNull(), F.xxhash64("v"))))
    classes = cut(rows.where("cls is not null").groupBy("cls")
                  .agg(F.first("v").alias("v"), F.min("id").alias("id"), F.count("*").alias("size")))
    width, bands = code_shape(classes.count(), threshold)

    codes = cut(classes.select("cls", "v").mapInArrow(
        _encode(width, bands, seed), "cls long, code binary, factor double, v array<double>, keys array<long>"))
    entries = codes.select("cls", F.posexplode("keys").alias("band", "bucket"))
    sizes = entries.groupBy("band", "bucket").agg(F.count("*").alias("m")).where("m > 1")
    dealt = (entries.join(sizes, ["band", "bucket"])
             .withColumn("blocks", F.expr(f"cast(ceil(m / {block}) as int)"))
             .withColumn("own", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
             .select("cls", "band", "bucket", "own",
                     F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("cls", "band", "bucket", "own", F.least("own", "other").alias("lo"),
                     F.greatest("own", "other").alias("hi")))
    sizes = classes.select("cls", "size")
    tiles = (dealt.join(codes.drop("keys"), "cls").join(sizes, "cls")
             .repartition(partitions(vectors), "band", "bucket", "lo", "hi")
             .sortWithinPartitions("band", "bucket", "lo", "hi"))
    links = cut(tiles.mapInArrow(_compare(threshold, width, bands, seed), "a long, b long, others long"))

    degree = links.groupBy(F.col("a").alias("cls")).agg(F.sum("others").alias("others"))
    labels = components(links)
    named = (classes.select("cls", "id", "size").join(degree, "cls", "left")
             .join(labels.withColumnRenamed("node", "cls"), "cls", "left")
             .withColumn("label", F.coalesce("label", "cls")))
    smallest = named.groupBy("label").agg(F.min("id").alias("component"))
    facts = named.join(smallest, "label").select(
        "cls", "component", (F.coalesce("others", F.lit(0)) + F.col("size") - 1).alias("links"))
    own = F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("component"))
    return (rows.select("id", "cls").join(facts, "cls", "left")
            .select(F.col("id").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    own.alias("component_id"), F.coalesce(F.col("id") == own, F.lit(False)).alias("kept")))


def _unit(column: pa.Array) -> np.ndarray:
    """Unit rows of vectors of one length; scaled first, so that squares of
    very large or small components stay finite."""
    flat = np.stack([np.asarray(v, np.float64) for v in column.to_numpy(zero_copy_only=False)])
    flat = flat / np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def _encode(width: int, bands: int, seed: int):
    bits = width * bands
    weights = 1 << np.arange(width, dtype=np.int64)

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("v").value_lengths().to_numpy()
            for d in np.unique(dims):
                whole = batch.filter(pa.array(dims == d))
                if d not in turns:
                    turns = {**turns, d: rotations(int(d), bits, seed)}
                rows = max(1, _TURNED // max(bits, int(d)))
                for s in range(0, len(whole), rows):
                    part = whole.slice(s, rows)
                    turned = _unit(part.column("v")) @ turns[d].T
                    positive = turned >= 0
                    factor = np.abs(turned).sum(1) / math.sqrt(bits)
                    keys = positive.reshape(len(turned), bands, width) @ weights * 64 + d % 64
                    yield pa.RecordBatch.from_pydict({
                        "cls": part.column("cls"),
                        "code": pa.array([row.tobytes() for row in np.packbits(positive, axis=1)], pa.binary()),
                        "factor": pa.array(factor), "v": part.column("v"),
                        "keys": pa.array(list(keys), pa.list_(pa.int64()))})

    return kernel


def _roots(linked: np.ndarray) -> np.ndarray:
    """Of each row of a symmetric matrix of flags the first that it is connected with."""
    root = np.full(len(linked), -1)
    for first in range(len(linked)):
        if root[first] >= 0:
            continue
        root[first], todo = first, [first]
        while todo:
            new = np.flatnonzero(linked[todo.pop()] & (root < 0))
            root[new] = first
            todo += new.tolist()
    return root


def _compare(threshold: float, width: int, bands: int, seed: int):
    bits = width * bands

    def linked(a, b, band, keys, units) -> np.ndarray:
        """Which pairs link and share no earlier band."""
        out = np.zeros(len(a), bool)
        for s in range(0, len(a), PAIRS):
            i, j = a[s:s + PAIRS], b[s:s + PAIRS]
            near = np.flatnonzero(~(keys[i, :band] == keys[j, :band]).any(1))
            near = near[np.einsum("ij,ij->i", units[i[near]], units[j[near]]) >= threshold]
            out[s + near] = True
        return out

    def tile(own, lo, hi, band, codes, keys, factors, units, turned) -> np.ndarray:
        """A flag for each two vectors of a tile that link: of its two blocks, or inside its one block."""
        flags = np.zeros((len(own), len(own)), bool)
        left, right = np.flatnonzero(own == lo), np.flatnonzero(own == hi)
        f2 = np.minimum(factors ** 2, 1)
        slack = Z * np.sqrt((1 - f2) / (f2 * max(1, bits - 1))) + 1e-9
        rows = max(1, 8 * PAIRS // max(1, len(right)))
        for s in range(0, len(left), rows):
            part = left[s:s + rows]
            estimate = (codes[part] * 2.0 - 1) @ turned[right].T / math.sqrt(bits) / factors[part][:, None]
            i, j = np.nonzero(estimate + slack[part][:, None] >= threshold)
            a, b = part[i], right[j]
            if lo == hi:
                a, b = a[a < b], b[a < b]
            some = linked(a, b, band, keys, units)
            flags[a[some], b[some]] = flags[b[some], a[some]] = True
        return flags

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        keys = ["band", "bucket", "lo", "hi"]
        weights = 1 << np.arange(width, dtype=np.int64)
        for table in runs(batches, keys):
            table = table.combine_chunks()
            col = {k: table.column(k).to_numpy() for k in [*keys, "own", "cls", "factor", "size"]}
            vectors, codes = table.column("v").combine_chunks(), table.column("code").to_pylist()
            dims = vectors.value_lengths().to_numpy()
            starts = group_starts([col[k] for k in keys])
            for a, b in zip(starts, [*starts[1:], len(dims)]):
                for d in np.unique(dims[a:b]):
                    at = a + np.flatnonzero(dims[a:b] == d)
                    if len(at) < 2:
                        continue
                    if d not in turns:
                        turns = {**turns, d: rotations(int(d), bits, seed)}
                    units = _unit(vectors.take(pa.array(at)))
                    bit = np.stack([np.unpackbits(np.frombuffer(codes[i], np.uint8), count=bits)
                                    for i in at])
                    found = tile(col["own"][at], col["lo"][a], col["hi"][a], int(col["band"][a]), bit,
                                 bit.reshape(len(at), bands, width) @ weights, col["factor"][at], units, units @ turns[d].T)
                    some = np.flatnonzero(found.any(1))
                    if len(some):
                        names = col["cls"][at]
                        others = [found[some[s:s + 64]] @ col["size"][at] for s in range(0, len(some), 64)]
                        yield pa.RecordBatch.from_pydict({
                            "a": pa.array(names[some]), "b": pa.array(names[_roots(found)[some]]),
                            "others": pa.array(np.concatenate(others))})

    return kernel


#: DuckDB: all pairs.
EMBEDDING_SQL = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
sound AS (
  SELECT * FROM vectors
  WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y
  FROM sound AS a JOIN sound AS b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reached AS (
  SELECT vec_id AS node, vec_id AS label FROM vectors
  UNION
  SELECT y, label FROM reached JOIN links ON node = x
),
degrees AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x),
smallest AS (SELECT node AS vec_id, min(label) AS component_id FROM reached GROUP BY node)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM vectors JOIN smallest USING (vec_id) LEFT JOIN degrees USING (vec_id)
"""
