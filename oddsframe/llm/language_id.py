"""Language identification by nearest centroid.

A text becomes a vector of hashed character n-grams (one to three bytes of its
letters, lower-cased, runs of other characters as one space) with sublinear term
frequencies and inverse document frequencies, scaled to unit length.  Each
language has several centroids, found by spherical k-means; a text gets the
language of the centroid nearest by cosine, and is rejected when even that is
farther than the language's own texts are.

Document frequencies count all training rows.  The centroids are fitted on at
most ``sample`` training rows of each language, those with the smallest hash of
their id: one task fits one language.  Prediction reads every whole text; long
texts are counted by slices.

Defined results: null texts and texts without a letter give ``und``, score 0,
rejected.  Rows with a null id are predicted but never learned from (they can
have no fold).  Ties go to the alphabetically first language.  Repeated rows
count as often as they occur.  Without any training row every text is ``und``.
Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, fold, lean, return_memory
from .words import chunks, utf8

DIMS = 4096
GRAMS = (1, 2, 3)
CENTROIDS = 4
#: Training rows of a language that its centroids are fitted on, at most.
SAMPLE = 400
#: A text is rejected under this share of the language's least own cosine.
REJECT_SHARE = 0.5
UNKNOWN = "und"
_ROWS, _BYTES = 128, 1 << 20
#: Bytes whose n-grams are counted at once.
_SEGMENT = 1 << 18


def _letters(data: np.ndarray) -> np.ndarray:
    """Lower-case letters (and all bytes over 127) as they are, all else space."""
    low = data | np.uint8(32)
    out = np.where((low >= 97) & (low <= 122), low, np.uint8(32))
    wide = data >= 128
    out[wide] = data[wide]
    after = np.zeros(len(data), bool)
    after[1:] = data[:-1] == 0xC3  # upper-case letters of Latin-1
    upper = after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)
    out[upper] += np.uint8(32)
    return out


def gram_counts(column: pa.Array) -> np.ndarray:
    """Counts of the hashed n-grams, a row for each text."""
    data, at = utf8(column)
    counts = np.zeros(len(column) * DIMS)
    letters = _letters(data)
    keep = np.ones(len(letters), bool)
    keep[1:] = (letters[1:] != 32) | (letters[:-1] != 32)
    at = np.concatenate([[0], np.cumsum(keep)])[at]
    letters = letters[keep]
    for start in range(0, len(letters), _SEGMENT):
        stop = min(start + _SEGMENT, len(letters))
        first = int(np.searchsorted(at, start, "right")) - 1
        last = int(np.searchsorted(at, stop, "left"))
        rows = np.repeat(np.arange(first, last), np.diff(np.clip(at[first:last + 1], start, stop)))
        seg = letters[start:stop + max(GRAMS)].astype(np.uint32)
        code = np.zeros(stop - start, np.uint32)
        place = np.arange(start, stop)
        for n in GRAMS:
            m = min(stop - start, len(seg) - n + 1)
            if m <= 0:
                break
            code = code[:m] * np.uint32(257) + seg[n - 1:n - 1 + m]
            whole = place[:m] + n <= at[rows[:m] + 1]
            if n == 1:
                whole &= seg[:m] != 32
            slot = ((code * np.uint32(2654435761) + np.uint32(n * 40503)) >> np.uint32(20)).astype(np.int64)
            counts[first * DIMS:last * DIMS] += np.bincount((rows[:m][whole] - first) * DIMS + slot[whole],
                                                            minlength=(last - first) * DIMS)
    return counts.reshape(len(column), DIMS)


def _vectors(column: pa.Array, idf: np.ndarray) -> np.ndarray:
    weights = np.log1p(gram_counts(column)) * idf
    return weights / np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)


def _pieces(column: pa.Array) -> Iterator[pa.Array]:
    for a, b in chunks(column, _BYTES):
        for c in range(a, b, _ROWS):
            yield column.slice(c, min(_ROWS, b - c))


def document_frequencies(docs: DataFrame) -> np.ndarray:
    """Inverse document frequencies of the n-gram slots over all of ``docs``."""

    def kernel(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(DIMS + 1, np.int64)
        for batch in batches:
            for part in _pieces(batch.column("text")):
                total[:DIMS] += (gram_counts(part) > 0).sum(0)
                total[DIMS] += len(part)
        return total

    total = fold(docs.select("text"), kernel, np.add, np.zeros(DIMS + 1, np.int64))
    return np.log((1 + total[DIMS]) / (1 + total[:DIMS])) + 1


def spherical_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """``k`` unit centroids: farthest-first starts, then cosine k-means."""
    centres = [x.mean(0)]
    while len(centres) <= k:
        centres.append(x[int(np.argmin((x @ np.stack(centres).T).max(1)))])
    centres = np.stack(centres[1:])
    for _ in range(rounds):
        mine = (x @ centres.T).argmax(1)
        for j in range(k):
            if (mine == j).any():
                mean = x[mine == j].mean(0)
                centres[j] = mean / max(np.linalg.norm(mean), 1e-12)
    return centres


def fit_centroids(training: DataFrame, idf: np.ndarray, sample: int = SAMPLE) -> pd.DataFrame:
    """``lang, floor, centre``: a few rows for each language."""
    ids = training.select("id", "lang").withColumn("h", F.xxhash64("id"))
    share = ids.groupBy("lang").agg(F.count("*").alias("n")).select(
        "lang", F.least(F.lit(1.0), F.lit(3.0 * sample) / F.col("n")).alias("share"))
    # Hashes under the share leave few rows to rank, however many there are.
    few = (ids.join(F.broadcast(share), "lang").where(F.expr("pmod(h, 1073741824) < share * 1073741824"))
           .withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("h", "id")))
           .where(F.col("rank") <= sample).select("id").distinct())
    rows = training.join(F.broadcast(cut(few)), "id", "left_semi")
    rows = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id", F.xxhash64("text"))))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        text = pa.array(frame.sort_values("rank").text, pa.string())
        x = np.concatenate([_vectors(part, idf) for part in _pieces(text)])
        x = x[np.linalg.norm(x, axis=1) > 0.5]
        if not len(x):
            return pd.DataFrame({"lang": [], "floor": [], "centre": []})
        centres = spherical_means(x, min(CENTROIDS, len(x)))
        floor = float((x @ centres.T).max(1).min()) * REJECT_SHARE
        del x
        return_memory()
        return pd.DataFrame({"lang": frame.lang.iloc[0], "floor": floor,
                             "centre": [c.astype(np.float32).tobytes() for c in centres]})

    return (rows.where(F.col("rank") <= sample).select("lang", "text", "rank").groupBy("lang")
            .applyInPandas(fit, "lang string, floor double, centre binary").toPandas()
            .sort_values(["lang", "centre"]).reset_index(drop=True))


def held_out(id_column: Column) -> Column:
    """The test fold: ``crc32`` of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify_languages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                       lang_column: str = "lang", sample: int = SAMPLE, keep: bool = False) -> DataFrame:
    """``id_column, held_out, lang_pred, score, rejected`` for every row; with
    ``keep`` all columns of ``docs``, without the rows that are rejected."""
    text = F.col(f"`{text_column}`").cast("string")
    training = docs.select(F.col(f"`{id_column}`").cast("string").alias("id"), text.alias("text"),
                           F.col(f"`{lang_column}`").cast("string").alias("lang"))
    training = training.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
                              & ~held_out(F.col("id")))
    idf = document_frequencies(training)
    model = fit_centroids(training, idf, sample)
    if keep:
        judged = docs.mapInArrow(_predict(model, idf, text_column, list(docs.columns), True), docs.schema)
        return judged
    rows = docs.select(F.col(f"`{id_column}`").alias(id_column), held_out(F.col(f"`{id_column}`")).alias("held_out"),
                       text.alias("text"))
    id_type = rows.schema[id_column].dataType.simpleString()
    return rows.mapInArrow(_predict(model, idf, "text", [id_column, "held_out"], False),
                           f"`{id_column}` {id_type}, held_out boolean, lang_pred string, score double, "
                           "rejected boolean")


def _has_letter(column: pa.Array) -> np.ndarray:
    data, at = utf8(column)
    ascii_letter = np.concatenate([[0], np.cumsum(((data | np.uint8(32)) >= 97) & ((data | np.uint8(32)) <= 122))])
    found = ascii_letter[at[1:]] > ascii_letter[at[:-1]]
    for i in np.flatnonzero(~found & (np.diff(at) > 0)):
        found[i] = any(map(str.isalpha, column[int(i)].as_py() or ""))
    return found


def _predict(model: pd.DataFrame, idf: np.ndarray, text_column: str, kept: list[str], keep: bool):
    names = np.array([*model.lang, UNKNOWN], object)
    floors = np.array(model.floor, float)
    centres = np.array([np.frombuffer(c, np.float32) for c in model.centre]).reshape(-1, DIMS)

    @lean("language_id")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(text_column)
            nearest, score = [np.zeros(0, int)], [np.zeros(0)]
            for part in _pieces(text):
                if not len(centres):
                    nearest.append(np.full(len(part), len(names) - 1))
                    score.append(np.zeros(len(part)))
                    continue
                cosine = _vectors(part, idf) @ centres.T
                best = cosine.argmax(1)
                value = np.clip(cosine[np.arange(len(part)), best], 0, 1)
                lettered = _has_letter(part)
                nearest.append(np.where(lettered, best, len(names) - 1))
                score.append(np.where(lettered, value, 0))
            best, value = np.concatenate(nearest), np.concatenate(score)
            far = (best == len(names) - 1) | (value < np.append(floors, 2)[best])
            if keep:
                yield batch.filter(pa.array(~far))
            else:
                yield pa.RecordBatch.from_pydict({
                    **{c: batch.column(c) for c in kept}, "lang_pred": pa.array(names[best], pa.string()),
                    "score": pa.array(value), "rejected": pa.array(far)})

    return kernel
