"""SentencePiece encoding and decoding as a weighted finite-state transducer.

A model file is compiled once per Python worker into one transducer:

* the normaliser maps a space to the space mark, puts a mark before the text and,
  if the model says so, drops surplus spaces;
* the piece transducer reads the characters of a piece and writes its id; a
  character that is no piece is read by the byte fallback, which writes its
  UTF-8 bytes' ids (or the unknown id);
* weights live in the tropical semiring.  In a unigram model an arc costs minus
  the piece's score.  In a BPE model arcs cost nothing, and a bigram constraint
  gives infinite cost to two neighbouring pieces that the merge rules would not
  leave side by side.  A sequence all of whose neighbours pass is *the* BPE
  segmentation, so the shortest path is the model's own encoding.

Paths never cross a boundary between a space mark and the character before it (no
piece does; this is checked when the model is compiled), so a text falls into chunks
whose paths are remembered in a memo of bounded size.  The pieces of a BPE model are
compiled into flat arrays of states and arcs.  The new chunks of a batch are composed
with them at once: every place of every chunk steps through the states, and each final
state gives an arc of the composition; then the arcs into the first places of all
chunks are relaxed, those into the second, and so on.  Long chunks and unigram models
go one by one.  Decoding runs the transducer backwards.

Defined results: null and empty texts encode to no ids; null ids decode to null.
Texts of any length are read whole.  Repeated rows and clashing extra columns are
kept as they are.  A model with a compiled character map is refused.  Decoding
gives the text back but for a space mark written in it, which returns as a space.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept_between_tasks, lean

MARK = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNK, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
#: Chunks and neighbours that a worker remembers.
MEMO = 200_000
#: Characters that are composed with the states at once, and the longest chunk that takes part.
BATCH, SHORT = 1 << 17, 64
#: Neighbours of pieces that are looked up without Python (a power of two).
_SEEN = 1 << 20
#: A unigram path pays this over the worst piece for an unknown character.
UNKNOWN_PENALTY = 10.0


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(key & 7) or varint()
        yield key >> 3, data[at:at + size]
        at += size


class PieceTransducer:
    """The compiled transducer of one model file's bytes."""

    def __init__(self, model: bytes):
        self.text: list[str] = []
        self.score: list[float] = []
        self.kind: list[int] = []
        options: dict[int, int | bytes] = {}
        rules: dict[int, int | bytes] = {}
        for field, value in _fields(model):
            if field == 1:
                part = dict(_fields(value))
                self.text.append(part.get(1, b"").decode())
                self.score.append(struct.unpack("<f", part[2])[0] if 2 in part else 0.0)
                self.kind.append(part.get(3, NORMAL))
            elif field == 2:
                options = dict(_fields(value))
            elif field == 3:
                rules = dict(_fields(value))
        if rules.get(2):
            raise ValueError("the model has a compiled character map, which is not supported")
        self.bpe = options.get(3, UNIGRAM) == BPE
        self.prefix, self.squeeze = bool(rules.get(3, 1)), bool(rules.get(4, 1))
        usable = [i for i, k in enumerate(self.kind) if k in (NORMAL, USER)]
        self.ids = {self.text[i]: i for i in usable}
        if any(MARK in self.text[i].lstrip(MARK) for i in usable):
            raise ValueError("a piece has a space mark after another character")
        self.longest = max((len(self.text[i]) for i in usable), default=1)
        self.bytes = {int(self.text[i][1:-1], 16): i for i, k in enumerate(self.kind) if k == BYTE}
        self.unknown = next((i for i, k in enumerate(self.kind) if k == UNK), 0)
        self.floor = min((self.score[i] for i in usable), default=0.0) - UNKNOWN_PENALTY
        self.rank = {t: (-self.score[i]) for t, i in self.ids.items()}
        # Neighbouring characters of some piece; no path joins any others.
        self._pairs = {t[i:i + 2] for t in self.ids for i in range(len(t) - 1)}
        self._chunks = _Memo(self._path)
        self._known: dict[str, bytes] = {}
        self._beside: dict[int, bool] = {}
        self._sides: dict[tuple[str, bool], list[tuple[str, float]] | None] = {}
        # The longest piece of 8 characters or more that starts with these 8, and the
        # longest one of 4 to 7 that starts with these 4.
        self._far: dict[str, int] = {}
        self._near: dict[str, int] = {}
        for t in self.ids:
            reach, key = (self._far, t[:8]) if len(t) >= 8 else (self._near, t[:4])
            if len(t) >= 4:
                reach[key] = max(reach.get(key, 0), len(t))
        self._split_of: dict[str, tuple[str, str] | None] = {}
        # What a character that is no piece is written as, where that is one id.
        alone = [self._written(chr(c)) for c in range(128)]
        self._arcs = _Arcs(self.ids, self._pairs, [-3 - ids[0] if len(ids) == 1 else -1 for ids in alone]
                           ) if self.bpe else None
        self._listed = [t.replace(MARK, " ") for t in self.text]
        self._plain = np.array([k in (NORMAL, USER, UNUSED) for k in self.kind])
        for byte, i in self.bytes.items():
            if byte < 128:  # never a part of a longer sequence
                self._listed[i], self._plain[i] = chr(byte), True
        # A chunk: space marks and what follows up to the next mark.
        self._split = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+").findall

    def rest(self) -> None:
        """Give up the older memo between tasks; the worker may be idle for long."""
        self._chunks.before = {}

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.prefix else "") + text.replace(" ", MARK)

    def encode_bytes(self, text: str) -> bytes:
        """The ids as 32-bit numbers."""
        return b"".join(map(self._chunks.__getitem__, self._split(self.normalise(text))))

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """The ids of several texts, whose new chunks share one composition."""
        split = [self._split(self.normalise(t)) for t in texts]
        if not self._arcs:
            return [b"".join(map(self._chunks.__getitem__, chunks)) for chunks in split]
        known, paths = self._known.get, {chunk: b"" for chunk in set().union(*split)}
        todo, size = [], 0
        for chunk in paths:
            path = known(chunk)
            if path is not None:
                paths[chunk] = path
            elif len(chunk) > SHORT:
                paths[chunk] = self._path(chunk)
            else:
                todo.append(chunk)
                size += len(chunk)
                if size >= BATCH:
                    paths.update(zip(todo, self._shortest(todo)))
                    todo, size = [], 0
        if todo:
            paths.update(zip(todo, self._shortest(todo)))
        if len(self._known) + len(paths) > MEMO:
            self._known.clear()
        if len(paths) <= MEMO:
            self._known.update((c, p) for c, p in paths.items() if len(c) <= SHORT)
        return [b"".join(map(paths.__getitem__, chunks)) for chunks in split]

    def _shortest(self, chunks: list[str]) -> list[bytes]:
        """The shortest paths of many chunks: costs are 0 or infinite, and all chunks
        are relaxed together, one place after the other."""
        arcs = self._arcs
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        # A node before each character and one after the last; chunks lie one after the other.
        first = np.concatenate([[0], np.cumsum(sizes + 1)])
        start, end, piece, apart = arcs.compose("\0".join(chunks) + "\0")
        local = end - np.repeat(first[:-1], sizes + 1)[end]
        order = np.lexsort((end - start, local))
        start, end, piece = start[order], end[order], piece[order]
        steps = np.searchsorted(local[order], np.arange(1, sizes.max() + 2))
        last = np.full(first[-1], -2, np.int64)  # the piece that leads to a node, -2: cost infinite
        last[first[:-1]] = -1
        back = np.zeros(first[-1], np.int64)
        for a, b in zip(steps, steps[1:]):
            left, right = last[start[a:b]], piece[a:b]
            fine = left != -2
            asked = np.flatnonzero(fine & (left >= 0) & (right >= 0) & ~apart[start[a:b]])
            fine[asked] = arcs.may_follow(left[asked], right[asked], self._may_follow)
            at = np.flatnonzero(fine) + a
            last[end[at]], back[end[at]] = piece[at], start[at]
        on_path = np.zeros(first[-1], bool)
        node = first[1:] - 1
        bad = last[node] == -2
        begins = np.zeros(first[-1] + 1, bool)
        begins[first] = True
        node = node[~bad]
        while len(node):
            on_path[node] = True
            node = back[node]
            node = node[~begins[node]]
        ids = np.where(last < -2, -3 - last, last)[on_path]
        ends = np.concatenate([[0], np.cumsum(on_path)])[first]
        spelt = np.add.reduceat(on_path & (last == -1), first[:-1]) > 0
        data, ends = ids.astype(np.int32).tobytes(), (ends * 4).tolist()
        return [self._path(chunk) if slow else data[a:b]
                for chunk, slow, a, b in zip(chunks, (spelt | bad).tolist(), ends, ends[1:])]

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()

    def _path(self, chunk: str) -> bytes:
        """The shortest path through the composition with ``chunk``."""
        pairs = self._pairs
        cuts = [i for i in range(1, len(chunk)) if chunk[i - 1:i + 1] not in pairs]
        if cuts:
            return b"".join([self._chunks[chunk[a:b]] for a, b in zip([0, *cuts], [*cuts, len(chunk)])])
        if self.bpe:
            return self._constrained(chunk)
        ids: list[int] = []
        for piece in self._cheapest(chunk):
            ids += self._written(piece)
        return struct.pack(f"={len(ids)}i", *ids)

    def _cheapest(self, chunk: str) -> list[str]:
        back, cost = [""] * (len(chunk) + 1), [0.0] + [float("inf")] * len(chunk)
        for start in range(len(chunk)):
            for end in range(start + 1, min(start + self.longest, len(chunk)) + 1):
                piece = chunk[start:end]
                if piece in self.rank:
                    total = cost[start] + self.rank[piece]
                elif end == start + 1:
                    total = cost[start] - self.floor
                else:
                    continue
                if total < cost[end]:
                    back[end], cost[end] = piece, total
        path, end = [], len(chunk)
        while end:
            path.append(back[end])
            end -= len(back[end])
        return path[::-1]

    def _constrained(self, chunk: str) -> bytes:
        """The one path of finite cost, longest arcs first.  A prefix has one
        segmentation only, so a place from which no arc leads on is dead for all."""
        get, beside, size = self.ids.get, self._beside, len(chunk)
        far, near = self._far.get, self._near.get
        path: list[int] = []  # piece ids, -1 for a character that is no piece
        ends = [0]
        dead: set[int] = set()
        at, last = 0, -1
        length = min(far(chunk[:8]) or near(chunk[:4], 3), size)
        while at < size:
            while length:
                piece = get(chunk[at:at + length], -1)
                if (piece >= 0 or length == 1) and at + length not in dead:
                    if last < 0 or piece < 0:  # only pieces merge
                        break
                    may = beside.get(last << 20 | piece)
                    if may is None:
                        may = self._may_follow(last, piece)
                    if may:
                        break
                length -= 1
            if length:
                path.append(piece)
                at += length
                ends.append(at)
                last = piece
                length = far(chunk[at:at + 8]) or near(chunk[at:at + 4], 3)
                if length > size - at:
                    length = size - at
            else:
                dead.add(at)
                path.pop()
                length = ends.pop() - ends[-1] - 1
                at = ends[-1]
                last = path[-1] if path else -1
        if -1 in path:
            spelt = [self._written(chunk[a:b]) if i < 0 else [i] for i, a, b in zip(path, ends, ends[1:])]
            path = [i for ids in spelt for i in ids]
        return struct.pack(f"={len(path)}i", *path)

    def _written(self, piece: str) -> list[int]:
        if piece in self.ids:
            return [self.ids[piece]]
        if self.bytes:
            return [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown]

    def _merged(self, parts: list[str]) -> tuple[list[str], tuple[str, str] | None]:
        """The merge rules applied to ``parts``; the last merge made."""
        last = None
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = self.rank.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                return parts, last
            last = parts[at], parts[at + 1]
            parts = [*parts[:at], parts[at] + parts[at + 1], *parts[at + 2:]]

    def _halves(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``."""
        if piece not in self._split_of:
            self._split_of[piece] = self._merged(list(piece))[1]
        return self._split_of[piece]

    def _side(self, piece: str, right: bool) -> list[tuple[str, float]] | None:
        """What stands at an end of ``piece`` as it grows, and when each is
        merged away; None where the merges are not in the order of their ranks."""
        out, until = [], float("inf")
        while True:
            out.append((piece, until))
            if len(piece) == 1:
                return out[::-1]
            halves = self._halves(piece)
            if halves is None or not self.rank[piece] < until or halves[0] + halves[1] != piece:
                return None
            until = self.rank[piece]
            piece = halves[1] if right else halves[0]

    def _may_follow(self, left: int, right: int) -> bool:
        """Would the merges leave these two pieces side by side?"""
        if len(self._beside) >= MEMO:
            self._beside.clear()
        found = self._beside[left << 20 | right] = self._stay_apart(self.text[left], self.text[right])
        return found

    def _stay_apart(self, left: str, right: str) -> bool:
        for key in ((left, True), (right, False)):
            if key not in self._sides:
                self._sides[key] = self._side(*key)
        x, y = self._sides[left, True], self._sides[right, False]
        if x is None or y is None or MARK * 2 in left + right:
            return self._merged(list(left + right))[0] == [left, right]
        i = j = 0
        while True:
            (a, a_until), (b, b_until) = x[i], y[j]
            across = self.rank.get(a + b)
            # Of equal ranks the leftmost merge comes first.
            if across is not None and across < a_until and across <= b_until:
                return False
            if i + 1 == len(x) and j + 1 == len(y):
                return True
            if a_until <= b_until:
                i += 1
            else:
                j += 1

    def decode(self, ids: list[int] | np.ndarray) -> str:
        if self._plain[ids].all() if len(ids) else True:
            text = "".join(map(self._listed.__getitem__, np.asarray(ids).tolist()))
        else:
            text = self._with_bytes(ids)
        return text[1:] if self.prefix and text.startswith(" ") else text

    def _with_bytes(self, ids: list[int]) -> str:
        out, pending = [], bytearray()
        for i in ids:
            if self.kind[i] == BYTE and not self._plain[i]:
                pending.append(int(self.text[i][1:-1], 16))
                continue
            if pending:
                out.append(_utf8(pending))
                pending = bytearray()
            if self.kind[i] == UNK:
                out.append(" ⁇ ")
            elif self.kind[i] != CONTROL:
                out.append(self._listed[i])
        if pending:
            out.append(_utf8(pending))
        return "".join(out)


class _Arcs:
    """The pieces of a model as states and arcs in flat arrays, and what is known of
    neighbouring pieces."""

    def __init__(self, ids: dict[str, int], pairs: set[str], alone: list[int]):
        states, arcs = {"": 0}, []
        final = [-1]
        for text in sorted(ids):
            for n in range(1, len(text) + 1):
                if text[:n] not in states:
                    states[text[:n]] = len(states)
                    arcs.append((states[text[:n - 1]] << 21 | ord(text[n - 1]), len(states) - 1))
                    final.append(-1)
            final[states[text]] = ids[text]
        arcs.sort()
        self.arcs = np.array([a for a, _ in arcs], np.int64)
        self.to = np.array([b for _, b in arcs], np.int64)
        self.final = np.array(final, np.int64)
        self.pairs = np.array(sorted(ord(p[0]) << 21 | ord(p[1]) for p in pairs), np.int64)
        self.alone = np.array([*alone, -1], np.int64)
        self.seen = np.full(_SEEN, -1, np.int64)
        self.told = np.zeros(_SEEN, bool)

    def compose(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Arcs of the composition with a text: first and last node, piece (of a character
        that is no piece -3 less the id of its byte, -1 if it takes several), and of each node whether no piece joins the characters at it."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        apart = np.ones(len(codes), bool)
        apart[1:] = ~_found(self.pairs, codes[:-1] << 21 | codes[1:])[1]
        node = np.flatnonzero(codes)
        state = np.zeros(len(node), np.int64)
        out, length = [], 0
        while len(node):
            at, known = _found(self.arcs, state << 21 | codes[node + length])
            if not length:
                lone = node[~known | (self.final[np.where(known, self.to[at], 0)] < 0)]
                out.append((lone, lone + 1, self.alone[np.minimum(codes[lone], 128)]))
            node, state, length = node[known], self.to[at[known]], length + 1
            piece = self.final[state]
            ends = piece >= 0
            out.append((node[ends], node[ends] + length, piece[ends]))
        start, end, piece = (np.concatenate(c) for c in zip(*out))
        return start, end, piece, apart

    def may_follow(self, left: np.ndarray, right: np.ndarray, ask: Callable[[int, int], bool]) -> np.ndarray:
        """Which of these neighbours the merges leave side by side; ``ask`` tells new ones."""
        key = left << 20 | right
        at = (key * 0x9E3779B97F4A7C1 >> 17) & (_SEEN - 1)
        out = self.told[at]
        new = np.flatnonzero(self.seen[at] != key)
        if len(new):
            keys, which = np.unique(key[new], return_inverse=True)
            told = np.array([ask(k >> 20, k & 0xFFFFF) for k in keys.tolist()], bool)
            out[new] = told[which]
            # Of two neighbours with one place, one stays; both arrays take the same one.
            place, one = np.unique((keys * 0x9E3779B97F4A7C1 >> 17) & (_SEEN - 1), return_index=True)
            self.seen[place], self.told[place] = keys[one], told[one]
        return out


def _found(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in sorted ``keys``, and whether each is there."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return at, keys[at] == wanted


class _Memo(dict):
    """Paths of short chunks: the ``MEMO`` latest new ones, and those of the time
    before that are still in use."""

    def __init__(self, make):
        self.make, self.before = make, {}

    def __missing__(self, chunk: str) -> bytes:
        path = self.before.get(chunk)
        if path is None:
            path = self.make(chunk)
        if len(chunk) <= 64:
            if len(self) >= MEMO:
                self.before = dict(self)
                self.clear()
            self[chunk] = path
        return path


def _utf8(data: bytearray) -> str:
    return data.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _compiled(name: str) -> PieceTransducer:
    with open(SparkFiles.get(name), "rb") as f:
        return PieceTransducer(f.read())


kept_between_tasks("sentencepiece", _compiled.cache_clear)


def share_model(docs: DataFrame, path: str) -> str:
    """Have Spark send the model file to every executor; its name there."""
    docs.sparkSession.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encode_pieces(docs: DataFrame, model_path: str, text_column: str = "text",
                  ids_column: str = "piece_ids", decoded_column: str | None = None) -> DataFrame:
    """``docs`` with the piece ids of ``text_column`` (an array of ints), and with
    what they decode to if ``decoded_column`` names a column for it."""
    name = share_model(docs, model_path)
    columns = [c for c in docs.columns if c not in (ids_column, decoded_column)]

    @lean("sentencepiece")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                decode = _compiled(name).decode
                paths = _compiled(name).encode_many([t.as_py() or "" for t in part.column(text_column)])
                ends = np.cumsum([0, *map(len, paths)]) // 4
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                               pa.array(np.frombuffer(b"".join(paths), np.int32)))
                more = {ids_column: ids}
                if decoded_column:
                    more[decoded_column] = pa.array([decode(np.frombuffer(p, np.int32)) for p in paths], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, *more.values()], names=[*columns, *more])
        _compiled(name).rest()

    frame = docs.select(*[F.col(f"`{c}`") for c in columns])
    added = [F.array().cast("array<int>").alias(ids_column)]
    if decoded_column:
        added.append(F.lit(None).cast("string").alias(decoded_column))
    return frame.mapInArrow(kernel, frame.select("*", *added).schema)


def decode_pieces(docs: DataFrame, model_path: str, ids_column: str = "piece_ids",
                  text_column: str = "decoded") -> DataFrame:
    """``docs`` with the text that ``ids_column`` stands for."""
    name = share_model(docs, model_path)
    columns = [c for c in docs.columns if c != text_column]

    @lean("sentencepiece")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                decode = _compiled(name).decode
                texts = [decode(i.values.to_numpy()) if i.is_valid else None for i in part.column(ids_column)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())],
                                                 names=[*columns, text_column])

    frame = docs.select(*[F.col(f"`{c}`") for c in columns])
    return frame.mapInArrow(kernel, frame.select("*", F.lit(None).cast("string").alias(text_column)).schema)
