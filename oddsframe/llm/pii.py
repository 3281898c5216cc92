"""Personal data, and the terms that give it away.

Base detectors find email addresses, IP addresses, payment cards and telephone
numbers.  The information-theoretic part then asks which ordinary terms reveal a
protected value: over the whole corpus, ``PMI(term; value) / IC(value)`` is the
share of the value's information that the term discloses (1: the term occurs
beside that value only).  Terms at ``disclosure`` or more, seen beside the value in
at least ``support`` different contexts (equal contexts, as in copies, count
once), are spans too wherever they occur.  Sanitising generalises base spans
to their kind and removes revealing terms.

Counts cover all documents: a first pass emits the terms beside protected values,
a second counts those terms everywhere (each task sends one number per term),
a third looks for the revealing ones.  Between passes a filter of fixed
size keeps other words from moving; joins decide exactly.

Defined results: null texts have no spans.  Offsets are code points, ends
exclusive.  Matches that fail their check are dropped without a retry.  Spans sort by
start, then kind as in ``KINDS``; a term inside a base span is not listed.
Repeated rows get equal results; null ids and extra columns are kept; an empty
table gives no rows.  Rows are told apart by a 64-bit hash of id and text.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, free_name, in_filter, key_filter, lean, row_key

KINDS = ("email", "ip", "card", "phone", "term")
#: Words on each side of a protected value that count as beside it.
CONTEXT = 8
SUPPORT = 3
DISCLOSURE = 0.95
#: Distinct terms that a task counts before it sends what it has.
_HELD = 200_000

# The detectors' patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"[^\W\d_]{3,}")

Span = tuple[int, int, str]


def _emails(text: str) -> Iterator[Span]:
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            free = domain.end()
            yield start, free, "email"
        at = text.find("@", max(at + 1, free))


def _ip_sound(match: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in match.split("."))


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """The base detectors' spans of a whole text, in order."""
    spans = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        # From the first digit of a run on, so a long run is read once.
        spans += [(*m.span(), "ip") for m in _IP.finditer(text) if _ip_sound(m[0])] if "." in text else []
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                spans.append((*m.span(), "card"))
        if "+" in text:
            spans += [(*m.span(), "phone") for m in _PHONE.finditer(text)
                      if 9 <= sum(c.isdigit() and c.isascii() for c in m[0]) <= 15]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _value(text: str, span: Span) -> int:
    start, end, kind = span
    found = text[start:end].lower()
    return _hash(f"{kind}:{found if kind in ('email', 'ip') else ''.join(filter(str.isdigit, found))}")


def _beside(words: list[tuple[int, int]], text: str, span: Span) -> list[str]:
    """The ``CONTEXT`` whole words before and after a span, lower-cased.
    ``words`` has the places of the text's words."""
    last = bisect_right(words, span[0], key=lambda w: w[1])
    first = bisect_left(words, (span[1], 0))
    near = words[max(0, last - CONTEXT):last] + words[first:first + CONTEXT]
    return [text[a:b].lower() for a, b in near]


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            text = text.as_py() or ""
            spans = base_spans(text)
            places = [m.span() for m in _WORD.finditer(text)] if spans else []
            for span in spans:
                if span[2] != "term":
                    words = _beside(places, text, span)
                    value, context = _value(text, span), _hash(" ".join(words))
                    rows += [(value, _hash(w), context) for w in words]
                    rows.append((value, None, context))
        yield pa.RecordBatch.from_pydict({
            "value": pa.array([r[0] for r in rows], pa.int64()), "term": pa.array([r[1] for r in rows], pa.int64()),
            "context": pa.array([r[2] for r in rows], pa.int64())})


def _term_counts(wanted: np.ndarray):
    @lean("pii")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        known: dict[str, int | None] = {}
        total = 0

        def sent() -> pa.RecordBatch:
            out = [*held.items(), (None, total)]
            return pa.RecordBatch.from_pydict({"term": pa.array([t for t, _ in out], pa.int64()),
                                               "n": pa.array([n for _, n in out], pa.int64())})

        for batch in batches:
            for text in batch.column("text"):
                words = _WORD.findall((text.as_py() or "").lower())
                total += len(words)
                fresh = list({w for w in words if w not in known})
                if len(known) + len(fresh) > 2 * _HELD:
                    known.clear()
                    fresh = list(set(words))
                hashes = np.array([_hash(w) for w in fresh], np.int64)
                known.update(zip(fresh, (h if keep else None for h, keep in
                                         zip(hashes.tolist(), in_filter(wanted, hashes)))))
                held.update(h for w in words if (h := known[w]) is not None)
            if len(held) > _HELD:
                yield sent()
                held, total = Counter(), 0
        yield sent()

    return kernel


def revealing_terms(docs: DataFrame, text_column: str = "text", support: int = SUPPORT,
                    disclosure: float = DISCLOSURE) -> DataFrame:
    """``term`` (64-bit hashes) of the terms that disclose a protected value."""
    texts = docs.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    seen = cut(texts.mapInArrow(_contexts, "value long, term long, context long")
               .groupBy("value", "term", "context").agg(F.count("*").alias("n")))
    values = seen.where("term is null").groupBy("value").agg(F.sum("n").alias("n_value"))
    pairs = cut(seen.where("term is not null").groupBy("value", "term")
                .agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts"))
                .where(F.col("contexts") >= support))
    counts = cut(texts.mapInArrow(_term_counts(key_filter(pairs.select("term"))), "term long, n long")
                 .groupBy("term").agg(F.sum("n").alias("n_term")))
    total = counts.where("term is null").agg(F.sum("n_term")).first()[0] or 0
    if not total:
        return pairs.select("term").distinct()
    information = -F.log2(F.col("n_value") / F.lit(total))
    shared = F.log2(F.least(F.col("n_both"), F.col("n_term")) * F.lit(float(total))
                    / (F.col("n_term") * F.col("n_value").cast("double")))
    return cut(pairs.join(counts, "term").join(values, "value")
               .where((information > 0) & (shared >= disclosure * information)).select("term").distinct())


def _term_spans(wanted: np.ndarray):
    @lean("pii")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int, int]] = []
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text")):
                text = (text.as_py() or "")
                words = [(m[0].lower(), *m.span()) for m in _WORD.finditer(text)]
                hashes = np.array([_hash(w) for w, _, _ in words], np.int64)
                out += [(key, int(h), words[i][1], words[i][2])
                        for i, h in zip(np.flatnonzero(in_filter(wanted, hashes)), hashes[in_filter(wanted, hashes)])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(4)],
                                             names=["key", "term", "start", "end"])

    return kernel


def personal_data(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with ``pii_spans``: an array of ``start, end, kind`` for each row."""
    return _with_spans(docs, id_column, text_column, clean=False, **options)


def _with_spans(docs: DataFrame, id_column: str, text_column: str, clean: bool, support: int = SUPPORT,
                disclosure: float = DISCLOSURE) -> DataFrame:
    terms = revealing_terms(docs, text_column, support, disclosure)
    key, found_terms = free_name(docs, "__key"), free_name(docs, "__terms")
    keyed = docs.withColumn(key, row_key(id_column, text_column))
    if terms.isEmpty():
        extra = None
    else:
        texts = keyed.select(F.col(key).alias("key"), F.col(f"`{text_column}`").cast("string").alias("text"))
        extra = cut(texts.mapInArrow(_term_spans(key_filter(terms)), "key long, term long, start long, end long")
                    .join(terms, "term").groupBy("key")
                    .agg(F.collect_set(F.struct("start", "end")).alias(found_terms)))
    spare = F.array().cast("array<struct<start:bigint,end:bigint>>")
    keyed = keyed.withColumn(found_terms, spare) if extra is None else (
        keyed.join(extra.withColumnRenamed("key", key), key, "left")
        .withColumn(found_terms, F.coalesce(found_terms, spare)))
    columns = list(docs.columns)
    if not clean:
        columns = [c for c in columns if c != "pii_spans"]
        spans = F.array().cast("array<struct<start:bigint,end:bigint,kind:string>>")
        schema = docs.select(*[F.col(f"`{c}`") for c in columns], spans.alias("pii_spans")).schema

    @lean("pii")
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                part = batch.slice(first, 500)
                texts = part.column(text_column).cast(pa.string()).to_pylist()
                rows = []
                for text, found in zip(texts, part.column(found_terms)):
                    spans = base_spans(text or "")
                    found = found.as_py()
                    if found:
                        free = [(t["start"], t["end"], "term") for t in found
                                if not any(s < t["end"] and t["start"] < e for s, e, _ in spans)]
                        spans = sorted(spans + free, key=lambda s: (s[0], KINDS.index(s[2])))
                    rows.append(spans)
                if clean:
                    texts = pa.array([sanitised(t, s) if s else t for t, s in zip(texts, rows)], pa.string())
                    out = [texts if c == text_column else part.column(c) for c in columns]
                    yield pa.RecordBatch.from_arrays(out, names=columns)
                    continue
                listed = pa.array([[{"start": s, "end": e, "kind": k} for s, e, k in r] for r in rows], kind)
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], listed],
                                                 names=[*columns, "pii_spans"])

    return keyed.drop(key).mapInArrow(kernel, docs.schema if clean else schema)


def sanitised(text: str, spans: list[Span]) -> str:
    """``text`` with base spans generalised to their kind and terms removed."""
    out, free = [], 0
    for start, end, kind in spans:
        if end <= free:
            continue
        out.append(text[free:max(start, free)])
        out.append("" if kind == "term" else f"[{kind.upper()}]")
        free = end
    return "".join(out) + text[free:]


def sanitise(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` with personal data out of ``text_column``; same columns."""
    return _with_spans(docs, id_column, text_column, clean=True, **options)


def span_digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def span_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``id_column, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term``."""
    found = personal_data(docs.select(F.col(f"`{id_column}`").alias(id_column), F.col(f"`{text_column}`").alias("text")),
                          id_column, "text", **options)
    of_kind = lambda kind: F.filter("pii_spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS]
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    base = F.filter("pii_spans", lambda s: s["kind"] != "term")
    return found.select(id_column, *counts[:4], F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("pii_spans")).alias("spans"), counts[4])
