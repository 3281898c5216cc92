"""Fill-in-middle over seekable compressed texts.

A text is stored as independent zstandard frames of about ``FRAME_BYTES``, each with
the units (lines) and code points up to its end.  The cuts are chosen in units, so
only the cumulative counts are needed to find the two frames that hold them; those two
are decompressed and cut, all others go into the output as they are, compressed.  The
output again is a list of frames: sentinels, frames of the prefix, of the suffix, of
the middle in the order of the form.  Digests stream over frames in order, one in
memory at a time, so a task's memory does not follow the length of a text beyond
its compressed row.

``restore_text`` takes the output and the form alone: it looks for the
sentinels over the stream of frames (also where one spans two frames) and gives
frames of the prefix, middle and suffix in the text's order.

Defined results: a null or empty text and a text that holds a sentinel stay ``plain`` (as do
those over ``rate``); their output is the text.  A null id draws its cuts from the
seed alone.  Repeated rows are rows of their own.  Extra columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

FRAME_BYTES = 1 << 16
LEVEL = 3
SEED = 7
#: Of a hundred texts so many are transformed, and so many of those suffix first.
RATE = 100
SPM_RATE = 50
#: The sentinels of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The order of the parts in the output of each form.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_FRAMES = "array<struct<data: binary, units: bigint, chars: bigint>>"
_STORED = f"id long, marked boolean, units bigint, frames {_FRAMES}"


def code_points(data: bytes) -> int:
    """Code points of valid UTF-8."""
    return int(((np.frombuffer(data, np.uint8) & 0xC0) != 0x80).sum())


def frames_of(text: bytes, pack: zstandard.ZstdCompressor, size: int = FRAME_BYTES) -> list[tuple[bytes, int, int]]:
    """A UTF-8 text as frames: compressed data, and the units begun and the code points up
    to the frame's end."""
    out, at, units, chars = [], 0, 0, 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and text[end] & 0xC0 == 0x80:  # not inside a code point
            end -= 1
        part = text[at:end]
        opens = at == 0 or text[at - 1] == 10
        units += opens + part.count(b"\n") - part.endswith(b"\n")
        chars += code_points(part)
        out.append((pack.compress(part), units, chars))
        at = end
    return out


def store_frames(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                 frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The texts as written frames: ``id``, ``marked`` (holds a sentinel), ``units`` and ``frames``."""
    docs = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"),
                       F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit("")).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=LEVEL)
        for batch in batches:
            text = batch.column("text")
            rows = [frames_of(value.as_buffer().to_pybytes(), pack, frame_bytes) for value in text]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pc.match_substring_regex(text, "<[PSM]>"),
                 pa.array([frames[-1][1] if frames else 0 for frames in rows], pa.int64()), _frame_lists(rows)],
                names=["id", "marked", "units", "frames"])

    return cut(docs.mapInArrow(kernel, _STORED))


def _frame_lists(rows: list[list[tuple[bytes, int, int]]]) -> pa.Array:
    flat = [frame for frames in rows for frame in frames]
    kinds = (("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()))
    parts = pa.StructArray.from_arrays([pa.array([f[k] for f in flat], kind) for k, (_, kind) in enumerate(kinds)],
                                       [name for name, _ in kinds])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()), parts)


def _drawn(stored: DataFrame, seed: int, rate: int, spm_rate: int) -> DataFrame:
    """Form and cuts (in units) of each row, from a digest of seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)

    def draw(k: int) -> Column:
        return F.conv(F.substring("digest", 8 * k - 7, 8), 16, 10).cast("long")

    form = (F.when((F.col("units") == 0) | F.col("marked") | (draw(3) % 100 >= rate), F.lit("plain"))
            .when(draw(4) % 100 < spm_rate, F.lit("spm")).otherwise(F.lit("psm")))
    ends = [draw(k) % (F.col("units") + 1) for k in (1, 2)]
    return (stored.withColumn("digest", digest)
            .select("id", "units", "frames", form.alias("form"), F.least(*ends).alias("low"), F.greatest(*ends).alias("high")))


def _cut_at(frames: list[dict], at: int, open_frame) -> tuple[int, int, int]:
    """Where unit ``at`` begins: frame, byte in that frame, code points before it."""
    k = 0
    low, high = 0, len(frames)
    while low < high:  # the first frame that begins a unit after ``at`` of them
        k = (low + high) // 2
        low, high = (low, k) if frames[k]["units"] > at else (k + 1, high)
    if low == len(frames):
        return low, 0, frames[-1]["chars"] if frames else 0
    before = frames[low - 1] if low else {"units": 0, "chars": 0}
    skip = at - before["units"]  # units of this frame before the cut
    part, place = open_frame(low), 0
    opens = low == 0 or open_frame(low - 1).endswith(b"\n")
    for _ in range(skip if opens else skip + 1):
        place = part.index(b"\n", place) + 1
    return low, place, before["chars"] + code_points(part[:place])


def _between(frames: list[dict], first: tuple[int, int, int], last: tuple[int, int, int], open_frame, pack) -> list[bytes]:
    """Frames of the text between two cuts; whole frames as they are."""
    (i, a, _), (j, b, _) = first, last
    if i == j:
        return [pack.compress(open_frame(i)[a:b])] if a < b else []
    out = [frames[i]["data"] if a == 0 else pack.compress(open_frame(i)[a:])]
    out += [frame["data"] for frame in frames[i + 1:j]]
    return out + ([pack.compress(open_frame(j)[:b])] if b else [])


def stream_digest(frames: list[bytes], unpack: zstandard.ZstdDecompressor) -> str:
    """SHA-256 of a text from its frames in order, one in memory at a time."""
    digest = hashlib.sha256()
    for frame in frames:
        digest.update(unpack.decompress(frame))
    return digest.hexdigest()


def restore_text(output: list[bytes], form: str, pack: zstandard.ZstdCompressor,
                 unpack: zstandard.ZstdDecompressor) -> list[bytes]:
    """Frames of the text that an output of ``form`` was made from."""
    if form == "plain":
        return output
    order = FORMS[form]
    parts: dict[bytes, list[bytes]] = {name: [] for name in order}
    waiting, current, held = list(order), None, b""
    for k in range(len(output) + 1):
        last = k == len(output)
        part = held if last else held + unpack.decompress(output[k])
        whole = not held  # the stored frame can be used as it is
        place = 0
        while waiting and (at := part.find(waiting[0], place)) >= 0:
            if current is not None and at > place:
                parts[current].append(pack.compress(part[place:at]))
            current = waiting.pop(0)
            place, whole = at + len(current), False
        # The end of a frame may be the beginning of a sentinel.
        keep = 0 if last or not waiting else next(
            (n for n in (2, 1) if len(part) - place >= n and waiting[0].startswith(part[len(part) - n:])), 0)
        held = part[len(part) - keep:]
        rest = part[place:len(part) - keep]
        if rest and current is not None:
            parts[current].append(output[k] if whole and not keep and not last else pack.compress(rest))
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", seed: int = SEED,
                   rate: int = RATE, spm_rate: int = SPM_RATE, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """``id_column, n, form, prefix_chars, middle_chars, output`` (frames),
    ``output_sha256, restored_sha256``.  ``output_text`` makes text of the frames."""
    drawn = _drawn(store_frames(docs, id_column, text_column, frame_bytes), seed, rate, spm_rate)
    kind = ("id long, n long, form string, prefix_chars long, middle_chars long, output array<binary>, "
            "output_sha256 string, restored_sha256 string")
    return drawn.mapInArrow(_transform, kind).withColumnRenamed("id", id_column)


def _transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack, unpack = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()
    signs = {name: pack.compress(name) for name in (PREFIX, SUFFIX, MIDDLE)}
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            rows = []
            for i in range(part.num_rows):
                frames, form = part.column("frames")[i].as_py(), part.column("form")[i].as_py()
                if form == "plain":
                    output, chars = [frame["data"] for frame in frames], (None, None)
                else:
                    opened: dict[int, bytes] = {}

                    def open_frame(k: int, frames=frames, opened=opened) -> bytes:
                        if k not in opened:
                            if len(opened) > 3:
                                opened.clear()
                            opened[k] = unpack.decompress(frames[k]["data"])
                        return opened[k]

                    begin, end = (0, 0, 0), (len(frames), 0, frames[-1]["chars"])
                    low, high = (_cut_at(frames, part.column(c)[i].as_py(), open_frame) for c in ("low", "high"))
                    spans = {PREFIX: (begin, low), MIDDLE: (low, high), SUFFIX: (high, end)}
                    output = [data for name in FORMS[form]
                              for data in (signs[name], *_between(frames, *spans[name], open_frame, pack))]
                    chars = low[2], high[2] - low[2]
                rows.append((*chars, output, stream_digest(output, unpack),
                             stream_digest(restore_text(output, form, pack, unpack), unpack)))
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("units"), part.column("form"),
                 *[pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]],
                names=["id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256"])


def output_text(made: DataFrame, column: str = "output", name: str = "output_text") -> DataFrame:
    """``made`` with the text of a column of frames."""
    kept = [field for field in made.schema.fields if field.name != name]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + f", `{name}` string"

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts = [None if frames is None else b"".join(map(unpack.decompress, frames)).decode()
                     for frames in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in kept], pa.array(texts, pa.string())],
                                             names=[*[f.name for f in kept], name])

    return made.select(*[f"`{f.name}`" for f in kept]).mapInArrow(kernel, schema)


#: DuckDB: lines as a list.
INFILL_SQL = """
WITH lines AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS units,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents
),
drawn AS (
  SELECT *, len(units) AS n, CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(units) + 1) AS c1,
         CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(units) + 1) AS c2,
         CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 AS h3,
         CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 AS h4
  FROM lines
),
formed AS (
  SELECT *, CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 >= 100
                 THEN 'plain' WHEN h4 < 50 THEN 'spm' ELSE 'psm' END AS form,
         least(c1, c2) AS low, greatest(c1, c2) AS high
  FROM drawn
),
parted AS (
  SELECT *, coalesce(array_to_string(units[1:low], ''), '') AS prefix,
         coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
         coalesce(array_to_string(units[high + 1:], ''), '') AS suffix
  FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parted
"""
