"""Words of whole texts as 64-bit hashes, many texts at a time.

A word is a run of bytes other than space, tab, line feed, vertical tab, form
feed and carriage return; A-Z count as a-z.  Hashes come from prefix sums over
the batch's own UTF-8 buffer: no Python string is made.  Work goes by slices of
a quarter of a megabyte, so memory does not follow the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

from .common import mix

SLICE = 1 << 18
#: Bytes of text taken at a time.
CHUNK = 1 << 19

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 64, 256, np.uint64, endpoint=False) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_BASE = 0xD6E8FEB86659FD93
_POWER = np.full(SLICE, _BASE, np.uint64)
_POWER[0] = 1
_POWER = np.cumprod(_POWER)
_BACK = np.full(SLICE, pow(_BASE, -1, 1 << 64), np.uint64)
_BACK[0] = 1
_BACK = np.cumprod(_BACK)
_PLACE = _rng.integers(0, 1 << 64, 64, np.uint64, endpoint=False) | np.uint64(1)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row's begin (nulls are empty)."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32, len(column) + 1,
                       column.offset * (8 if wide else 4)).astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (one row may be more)."""
    _, at = utf8(column)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = max(first + 1, min(last, len(column)))
        yield first, last
        first = last


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and the index of each text's first
    word (one more at the end).  A word never reaches over two texts."""
    inside = (data != 32) & (data - np.uint8(9) > 4)
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, at)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        origin = starts[first]
        last = int(np.searchsorted(ends, origin + SLICE, "right"))
        if last == first:  # one word longer than a slice
            word = data[origin:ends[first]].tobytes().lower()
            out[first] = xxhash.xxh3_64_intdigest(word)
            first += 1
            continue
        seg = data[origin:ends[last - 1]]
        value = np.take(_BYTE, seg) * _POWER[:len(seg)]
        total = np.cumsum(value)
        s, e = starts[first:last] - origin, ends[first:last] - origin
        out[first:last] = mix((total[e - 1] - total[s] + value[s]) * _BACK[s])
        first = last
    return out


def text_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string column, and each row's first word."""
    data, at = utf8(column)
    starts, ends, first = word_bounds(data, at)
    return word_hashes(data, starts, ends), first


def sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for j in range(n):
        total += words[j:j + count] * _PLACE[j]
    return mix(total + np.uint64(n))


def long_sequence_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of ``n`` words (under 2 ** 32): runs of 1, 2, 4 and so on words are
    put together from halves, and the run from those that ``n`` is the sum of."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    part, out, done = words, np.zeros(count, np.uint64), 0
    for level in range(n.bit_length()):
        if level:
            half = 1 << level - 1
            part = part[:-half] * _PLACE[level] + part[half:]
        if n >> level & 1:
            out = out * _PLACE[32 + level] + part[done:done + count]
            done += 1 << level
    return mix(out + np.uint64(n))


def distinct(values: np.ndarray) -> np.ndarray:
    """The sorted distinct values of a non-empty array."""
    ordered = np.sort(values)
    new = np.ones(len(ordered), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    return ordered[new]


def shingle_sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    """For each row its sorted distinct ``n``-word shingles; with fewer words
    the whole sequence as one; without words none."""
    words, first = text_words(column)
    every = sequence_hashes(words, n)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= n:
            yield distinct(every[a:b - n + 1])
        elif b > a:
            yield sequence_hashes(words[a:b], int(b - a))
        else:
            yield np.zeros(0, np.uint64)
