"""WARC archives written, read back, and assembled to captures.

**Writing.**  Every page becomes a transaction of three records, request, response (or
revisit) and metadata, which name each other by ``WARC-Concurrent-To``.  Of pages with
equal payloads of ``min_bytes`` or more, that with the largest id is the response; the others are revisits,
which carry the payload's digest and its HTTP headers but no payload.  Records go out
through Spark's text writer as gzip files (a record ends with two line breaks, the
writer's separator), so that a lost task leaves no half archive.

**Reading.**  A gzip file is one task's stream: Spark's text reader hands it over in pieces
between separators, and the parser puts pieces together by ``Content-Length``, whatever
separators a payload holds; a task holds one record at a time.  Archives of others,
compressed record by record, read alike.

**Assembly.**  Records that name a capture (a response, revisit or resource), or that a
capture names, belong to it; other records belong to the capture of the records they
are connected with through further identifiers.  One row for each capture with its records nested.
A revisit finds its original by record id, or else by digest, in a narrow join; payloads
do not move.

Defined results: null html is an empty payload; a null url is not written and read as null; a
null id likewise, and counts as the smallest.  Equal payloads are told by SHA-1 and length.
Rows that repeat id, url and html are captures of their own: of those the first copy is the response.
Records without any capture are a row with no response.  Extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import components, cut, release

MIN_BYTES = 1000
#: When the pages are said to be captured; the tables hold no time.
CAPTURED = "2024-01-01T00:00:00Z"
BREAK = "\r\n"
SEPARATOR = BREAK * 2
#: Records of one archive file, at most.
FILE_RECORDS = 300_000
#: Kinds of record that are a capture.
CAPTURES = ("response", "revisit", "resource")
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _lines(*pairs: tuple[str, Column]) -> Column:
    """Header lines; those with a null value are left out."""
    return F.concat(*[F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(BREAK)), F.lit("")) for name, value in pairs])


def _safe(value: Column) -> Column:
    """A header value: control characters and spaces of an address, percent-encoded."""
    for code in (*range(33), 127):
        value = F.replace(value, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return value


def _urn(*parts: Column) -> Column:
    """A record id that follows from ``parts``."""
    h = F.sha2(F.concat_ws("\x1f", *parts).cast("binary"), 256)
    cuts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def write_archives(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url",
                   html_column: str = "html", min_bytes: int = MIN_BYTES, captured: str = CAPTURED,
                   compression: str = "gzip") -> None:
    """``pages`` as WARC files in the folder ``path``."""
    html = F.coalesce(F.col(f"`{html_column}`").cast("string"), F.lit(""))
    pages = pages.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{url_column}`").cast("string").alias("url"),
                         html.alias("html"), F.sha1(html.cast("binary")).alias("digest"),
                         F.octet_length(html).cast("long").alias("length"))
    payload = ["digest", "length"]
    # Only payloads that occur again: a narrow table, aggregated before it is shuffled.
    equal = (pages.where(F.col("length") >= min_bytes).groupBy(*payload)
             .agg(F.count("*").alias("times"),
                  F.max(F.struct(F.col("id").isNotNull().alias("named"), "id", F.col("url").isNotNull().alias("has"), "url"))
                  .alias("top"))
             .where("times > 1").select(*payload, "top"))
    keys = cut(pages.select("id", "url", *payload).where(F.col("length") >= min_bytes)
               .join(equal, payload).select("id", "url", *payload, "top").distinct())
    same = Window.partitionBy("id", "url", *payload).orderBy(F.lit(0))
    rows = pages.withColumn("copy", F.row_number().over(same)).alias("p").join(
        keys.alias("k"), F.expr("p.id <=> k.id and p.url <=> k.url and p.digest = k.digest and p.length = k.length"),
        "left").select("p.*", "k.top")

    def names(kind: str, page: Column, url: Column, copy: Column) -> Column:
        return _urn(F.lit(kind), page.cast("string").isNull().cast("string"), F.coalesce(page.cast("string"), F.lit("")),
                    url.isNull().cast("string"), F.coalesce(url, F.lit("")), "digest", copy.cast("string"))

    best = F.col("id").eqNullSafe(F.col("top.id")) & F.col("url").eqNullSafe(F.col("top.url")) & (F.col("copy") == 1)
    rows = (rows.withColumn("again", F.coalesce(F.col("top").isNotNull() & ~best, F.lit(False)))
            .withColumn("rid", names("response", F.col("id"), F.col("url"), F.col("copy")))
            .withColumn("qid", names("request", F.col("id"), F.col("url"), F.col("copy")))
            .withColumn("mid", names("metadata", F.col("id"), F.col("url"), F.col("copy")))
            .withColumn("first", F.when(F.col("again"), names("response", F.col("top.id"), F.col("top.url"), F.lit(1))))
            .withColumn("target", _safe(F.col("url"))))

    def record(kind: Column, rid: Column, mime: str, block: Column, *more: tuple[str, Column]) -> Column:
        head = _lines(("WARC-Type", kind), ("WARC-Record-ID", rid), ("WARC-Date", F.lit(captured)),
                      ("WARC-Target-URI", F.col("target")), *more, ("Content-Type", F.lit(mime)),
                      ("Content-Length", F.octet_length(block).cast("string")))
        return F.concat(F.lit(f"WARC/1.1{BREAK}"), head, F.lit(BREAK), block)

    http = F.concat(F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
                    F.col("length").cast("string"), F.lit(SEPARATOR))
    get = F.concat(F.lit("GET "), F.coalesce("target", F.lit("/")), F.lit(f" HTTP/1.1{SEPARATOR}"))
    told = _lines(("page_id", F.col("id").cast("string")), ("url", F.replace(F.replace("url", F.lit("\r"), F.lit("%0D")),
                                                                             F.lit("\n"), F.lit("%0A"))))
    response = record(
        F.when(F.col("again"), F.lit("revisit")).otherwise(F.lit("response")), F.col("rid"), "application/http; msgtype=response",
        F.when(F.col("again"), http).otherwise(F.concat(http, F.col("html"))),
        ("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        ("WARC-Profile", F.when(F.col("again"), F.lit(_PROFILE))), ("WARC-Refers-To", F.col("first")))
    near = ("WARC-Concurrent-To", F.col("rid"))
    request = record(F.lit("request"), F.col("qid"), "application/http; msgtype=request", get, near)
    # Metadata names the request, which names the response: a chain of two.
    metadata = record(F.lit("metadata"), F.col("mid"), "application/warc-fields", told, near,
                      ("WARC-Concurrent-To", F.col("qid")))
    (rows.select(F.explode(F.array(request, response, metadata)).alias("value"))
     .write.option("lineSep", SEPARATOR).option("compression", compression)
     .option("maxRecordsPerFile", FILE_RECORDS).text(path))
    release(keys)


_HEADERS = {"record_id": "warc-record-id", "type": "warc-type", "date": "warc-date", "target_uri": "warc-target-uri",
            "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
_RECORD = (", ".join(f"{name} string" for name in _HEADERS)
           + ", concurrent_to array<string>, http_headers string, payload binary")


def parse_records(pieces: Iterator[bytes]) -> Iterator[tuple[list[tuple[str, str]], bytes]]:
    """Header fields (lower-case names, in order) and block of each WARC record in a stream
    of bytes.  Bytes between records that begin none are passed over; a record cut off by
    the stream's end is an error."""
    held = bytearray()
    ended = False

    def more() -> bool:
        nonlocal ended
        piece = next(pieces, None)
        ended = piece is None
        held.extend(piece or b"")
        return not ended

    mark = SEPARATOR.encode()
    while True:
        while (at := held.find(b"WARC/1.")) < 0:
            del held[:max(0, len(held) - 6)]
            if not more():
                return
        del held[:at]
        start = 0
        while (end := held.find(mark, start)) < 0:
            start = max(0, len(held) - 3)
            if not more():
                raise ValueError("a WARC record ends within its header")
        text = re.sub(rb"\r\n[ \t]+", b" ", bytes(held[:end])).decode("utf-8", "replace")
        fields = [(name.strip().lower(), value.strip()) for name, _, value in
                  (line.partition(":") for line in text.split(BREAK)[1:])]
        length = next((int(v) for n, v in fields if n == "content-length"), None)
        if length is None:
            raise ValueError("a WARC record without Content-Length")
        del held[:end + 4]
        while len(held) < length:
            if not more():
                raise ValueError("a WARC record ends within its block")
        block = bytes(held[:length])
        del held[:length]
        yield fields, block


def _record(fields: list[tuple[str, str]], block: bytes) -> tuple:
    """A row of ``read_archives``."""
    first: dict[str, str] = {}
    for name, value in fields:
        first.setdefault(name, value)
    http, payload = None, block
    if first.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(SEPARATOR.encode())
        http = head.decode("utf-8", "replace")
    near = [value for name, value in fields if name == "warc-concurrent-to"]
    return (*[first.get(name) for name in _HEADERS.values()], near, http, payload)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files at ``path``: ids, type, date, target, digest as written,
    ``concurrent_to``, HTTP headers as text, and the payload (of HTTP records the
    body, of others the block)."""
    pieces = (spark.read.option("lineSep", SEPARATOR).text(path)
              .select(F.col("value").cast("binary").alias("value"), F.input_file_name().alias("file")))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        names = [*_HEADERS, "concurrent_to", "http_headers", "payload"]
        kinds = [pa.string()] * len(_HEADERS) + [pa.list_(pa.string()), pa.string(), pa.binary()]
        size = 0
        for stream in _files(batches):
            for fields, block in parse_records(stream):
                rows.append(_record(fields, block))
                size += len(block) + 500
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)
                    rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names)

    return pieces.mapInArrow(kernel, _RECORD)


def _files(batches: Iterator[pa.RecordBatch]) -> Iterator[Iterator[bytes]]:
    """A stream of bytes for each file in rows of pieces that follow each other."""
    mark = SEPARATOR.encode()
    rows = ((file, value) for batch in batches
            for file, value in zip(batch.column("file").to_pylist(), batch.column("value").to_pylist()))
    ahead = next(rows, None)
    while ahead is not None:
        current = ahead[0]

        def stream() -> Iterator[bytes]:
            nonlocal ahead
            while ahead is not None and ahead[0] == current:
                piece, ahead = ahead[1], next(rows, None)
                yield piece + mark

        one = stream()
        yield one
        for _ in one:  # what the parser left
            pass


def capture_of(records: DataFrame) -> DataFrame:
    """``record_id, capture``: the capture that each record which is none belongs to (its
    own component's smallest id where there is none)."""
    kinds = records.select("record_id", F.col("type").isin(*CAPTURES).alias("is_capture"), "concurrent_to")
    heads = kinds.where("is_capture").select(F.col("record_id").alias("other"), F.col("record_id").alias("head"))
    links = kinds.select("record_id", "is_capture", F.explode("concurrent_to").alias("other"))
    named = links.where("not is_capture").join(heads, "other").select("record_id", "head")  # names a capture
    naming = (links.where("is_capture").join(kinds.where("not is_capture").select(F.col("record_id").alias("other")), "other")
              .select(F.col("other").alias("record_id"), F.col("record_id").alias("head")))  # a capture names it
    direct = cut(named.unionByName(naming).groupBy("record_id").agg(F.min("head").alias("capture")))
    rest = cut(kinds.where("not is_capture").join(direct, "record_id", "left_anti").select("record_id"))
    if rest.isEmpty():
        return direct
    # Chains through other records: components of all links, named by their smallest capture.
    edges = links.select(F.col("record_id").alias("a"), F.col("other").alias("b"))
    found = components(edges)
    heads_of = (found.join(heads.withColumnRenamed("other", "node"), "node").groupBy("label").agg(F.min("head").alias("head")))
    far = (rest.join(found.withColumnRenamed("node", "record_id"), "record_id", "left")
           .join(heads_of, "label", "left")
           .select("record_id", F.coalesce("head", "label", "record_id").alias("capture")))
    return direct.unionByName(cut(far))


def assemble(records: DataFrame) -> DataFrame:
    """One row for each capture: ``capture`` (its record id), ``target_uri``, ``date``,
    ``record_type``, ``refers_to`` and ``original`` (record id of the response that a revisit repeats,
    null if no archive holds it), ``response`` (struct, null without one), ``requests`` and ``metadata`` (arrays of
    structs).  The structs have the other columns of ``records``, so leave out payloads that are not needed.
    A record id that occurs several times counts as one record, the first by date."""
    fields = [c for c in records.columns if c != "concurrent_to"]
    is_capture = F.col("type").isin(*CAPTURES)
    owner = capture_of(records)
    placed = (records.where(is_capture).withColumn("capture", F.col("record_id"))
              .unionByName(records.where(~is_capture).join(owner, "record_id").select(*records.columns, "capture")))
    whole = F.struct(*fields)

    def listed(kind: str) -> Column:
        return F.sort_array(F.collect_list(F.when(F.col("type") == kind, F.struct("date", "record_id", whole.alias("record")))))

    rows = (placed.groupBy("capture")
            .agg(F.min_by(F.when(is_capture, whole), F.when(is_capture, F.col("date"))).alias("response"),
                 listed("request").alias("requests"), listed("metadata").alias("metadata"))
            .select("capture", F.col("response.target_uri").alias("target_uri"), F.col("response.date").alias("date"),
                    F.col("response.type").alias("record_type"), F.col("response.refers_to").alias("refers_to"), "response",
                    *[F.transform(c, lambda r: r["record"]).alias(c) for c in ("requests", "metadata")]))
    return rows


def with_originals(captures: DataFrame, carried: Column, name: str) -> DataFrame:
    """``captures`` with ``name``: the value of ``carried`` in the response that a revisit repeats,
    found by its record id or, where that names none, by the payload's digest."""
    rows = cut(captures.withColumn("__carried", carried).withColumn("__digest", F.col("response.payload_digest")))
    first = rows.where("record_type = 'response'").select("capture", "__digest", "__carried")
    # Only responses that a revisit names; both sides are narrow, and a hot one is split by the skew join.
    by_id = first.select(F.col("capture").alias("refers_to"), F.col("__carried").alias("__by_id"))
    by_digest = first.groupBy("__digest").agg(F.max("__carried").alias("__by_digest"))
    again = rows.where("record_type = 'revisit'").join(by_id, "refers_to", "left")
    known = again.where("__by_id is not null").withColumn(name, F.col("__by_id"))
    rest = (again.where("__by_id is null").join(by_digest, "__digest", "left")
            .withColumn(name, F.col("__by_digest")))
    others = rows.where("record_type is null or record_type <> 'revisit'").withColumn(name, F.lit(None).cast(
        rows.schema["__carried"].dataType))
    kept = [*captures.columns, name]
    return others.select(*kept).unionByName(known.select(*kept)).unionByName(rest.select(*kept))


def archive_report(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
                   min_bytes: int = MIN_BYTES) -> DataFrame:
    """``pages`` written to archives in the scratch folder and read back: ``page_id,
    payload_bytes, payload_digest, record_type, refers_to`` for each capture."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_archives(pages, path, id_column, url_column, html_column, min_bytes)
    records = read_archives(spark, path)
    response = F.col("type") == "response"
    told = F.decode("payload", "utf-8")
    records = cut(records.withColumn("payload_bytes", F.when(response, F.octet_length("payload")).when(
        F.col("type") == "revisit", F.regexp_extract("http_headers", r"(?im)^content-length:[ \t]*([0-9]+)", 1)).cast("long"))
        .withColumn("sha1", F.when(response, F.sha1("payload")))
        .withColumn("page_id", F.when(F.col("type") == "metadata", F.regexp_extract(told, r"(?m)^page_id: (-?[0-9]+)", 1)))
        .drop("payload", "http_headers", "content_type"))
    captures = assemble(records)
    page = F.col("metadata")[0]["page_id"].try_cast("long")
    out = with_originals(captures, page, "original")
    return out.select(page.alias("page_id"), F.col("response.payload_bytes").alias("payload_bytes"),
                      F.coalesce("response.sha1", F.substring_index("response.payload_digest", ":", -1)).alias("payload_digest"),
                      "record_type", F.col("original").alias("refers_to"))


#: DuckDB: what the archives must say of each page.
WARC_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
),
last AS (SELECT payload_digest, max(page_id) AS page FROM payloads WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page <> page_id THEN page END AS refers_to
FROM payloads LEFT JOIN last USING (payload_digest)
"""
