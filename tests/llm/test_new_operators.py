"""Divergence, fill-in-middle and archives: kernels against brute force, odd rows, and
each query against its SQL."""

from __future__ import annotations

import gzip
import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import zstandard

from oddsframe.llm import divergence, infill, warc
from oddsframe.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_ORACLE, SF_SMOKE
from tests.oracle_check import compare, duck

NEW = ["op11_divergence", "op12_infill", "op13_warc"]


@pytest.mark.parametrize("name", NEW)
@pytest.mark.parametrize("sf_dir", [SF_SMOKE, SF_ORACLE])
def test_query_equals_its_sql(spark, name, sf_dir):
    assert compare(spark, duck(sf_dir), name, QUERIES[name], ORACLE[name], sf_dir)["status"] == "OK"


# ---- op11

def plain_terms(text):
    import re
    return [t.translate({c: c + 32 for c in range(65, 91)}) for t in re.findall("[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text)]


def test_terms_of_any_length(monkeypatch):
    rng = random.Random(3)
    monkeypatch.setattr(divergence, "SLICE", 16)
    for _ in range(300):
        text = "".join(rng.choice("aBcZ é日-_[1 \n\x00ÀÉ") for _ in range(rng.randint(0, 120)))
        if rng.random() < 0.2:
            text = "x" * rng.randint(0, 60) + "É" * rng.randint(0, 30) + text
        found = [t.decode() for part in divergence.terms(text.encode()) for t in part]
        assert found == plain_terms(text)


@pytest.mark.parametrize("rows, width, split", [(1, 5, 0), (3, 1, 0), (20, 70, 0), (40, 33, 0), (300, 40, 256), (290, 0, 256)])
def test_quadtree_sums_every_cell(rows, width, split):
    rng = np.random.default_rng(rows + width)
    floor = rng.integers(1, 1000, rows)
    p = np.repeat(floor[:, None], width, 1)
    filled = rng.random((rows, width)) < rng.choice([0.02, 0.5])
    filled[rows // 2:rows // 2 + 5] = False  # sources without a term here
    p[filled] = rng.integers(1, 10 ** 9, int(filled.sum()))
    r, c = np.nonzero(filled)
    found = divergence.Quadtree(r, c, p[r, c], floor, width).distances(split)
    want = np.abs(p[:, None, :] - p[None]).sum(2)
    x, y = (np.mgrid[0:split, split:rows].reshape(2, -1) if split else np.triu_indices(rows, 1))
    assert (found[x, y] == want[x, y]).all()


def brute_divergence(rows, min_docs, top):
    docs = [(lang or "", source or "", plain_terms(text or "")) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [(s, w) for g, s, w in docs if g == lang]
        df = Counter(t for _, w in own for t in set(w))
        kept = [t for t in df if df[t] >= min_docs]
        counts = {s: Counter(t for s2, w in own if s2 == s for t in w if df[t] >= min_docs) for s in {s for s, _ in own}}
        whole = sum(counts.values(), Counter())

        def share(c, t):
            return 1 + 10 ** 9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept))

        for s, c in counts.items():
            pairs = [(-sum(abs(share(c, t) - share(o, t)) for t in kept), item) for item, o in counts.items() if item != s]
            terms = [(share(whole, t) - share(c, t), t) for t in kept if c[t] and share(c, t) > share(whole, t)]
            for part, found in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))),
                                ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(found, 1)]
    return sorted(out)


def test_divergence_of_many_sources(spark, monkeypatch):
    """More sources than a tile has rows, more terms than it has columns, a hot source,
    nulls, empty texts, a language with one source and one without terms."""
    monkeypatch.setattr(divergence, "ROWS", 16)
    monkeypatch.setattr(divergence, "COLS", 8)
    monkeypatch.setattr(divergence, "HELD", 50)
    rng = random.Random(11)
    rows = [("en", f"s{k % 37}" if rng.random() < 0.6 else "hot", " ".join(f"W{chr(97 + rng.randint(0, 25))}É"
             for _ in range(rng.randint(0, 30)))) for k in range(300)]
    rows += [("en", "never", "only here"), ("en", "s1", None), (None, None, "wa wb"), ("de", "one", "x y z " * 4)]
    rows += [(None, "b", ""), ("xx", "a", "1 2"), ("xx", "b", None)] + [("de", "one", "x")] * 3
    docs = spark.createDataFrame([(*r, 1, "t") for r in rows], "lang string, source string, text string, term int, p string")
    found = divergence.source_divergence(docs, min_docs=3, top=5)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in found.collect()) == brute_divergence(rows, 3, 5)
    assert divergence.source_divergence(docs.limit(0)).collect() == []


# ---- op12

PACK, UNPACK = zstandard.ZstdCompressor(), zstandard.ZstdDecompressor()


def test_cuts_and_round_trips_over_small_frames():
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice("ab\n é日<SPM>") for _ in range(rng.randint(1, 60)))
        lines = [x for x in text.splitlines(keepends=True)] if "\r" not in text else []
        lines = text.split("\n")
        lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        data = text.encode()
        frames = [dict(zip(("data", "units", "chars"), f)) for f in infill.frames_of(data, PACK, rng.choice([4, 7, 1000]))]
        assert frames[-1]["units"] == len(lines) and frames[-1]["chars"] == len(text)
        assert b"".join(UNPACK.decompress(f["data"]) for f in frames) == data

        def open_frame(k):
            return UNPACK.decompress(frames[k]["data"])

        low, high = sorted(rng.randint(0, len(lines)) for _ in range(2))
        cuts = [infill._cut_at(frames, at, open_frame) for at in (low, high)]
        assert [c[2] for c in cuts] == [len("".join(lines[:low])), len("".join(lines[:high]))]
        spans = [((0, 0, 0), cuts[0]), (cuts[0], cuts[1]), (cuts[1], (len(frames), 0, 0))]
        prefix, middle, suffix = (infill._between(frames, *span, open_frame, PACK) for span in spans)
        assert b"".join(map(UNPACK.decompress, middle)).decode() == "".join(lines[low:high])
        if any(s in text for s in ("<P>", "<S>", "<M>")):
            continue
        for form, parts in (("psm", (prefix, suffix, middle)), ("spm", (suffix, prefix, middle))):
            output = b"".join(name + b"".join(map(UNPACK.decompress, part)) for name, part in zip(infill.FORMS[form], parts))
            size = rng.choice([1, 2, 3, 5, 100])  # sentinels over several frames
            again = infill.restore_text([PACK.compress(output[i:i + size]) for i in range(0, len(output), size)],
                                        form, PACK, UNPACK)
            assert b"".join(map(UNPACK.decompress, again)) == data


def test_infill_of_odd_rows(spark):
    texts = [None, "", "\n", "\n\n", "one", "a\nb\nc\n", "has <M> inside\nx", "é日\n" * 50_000, "x" * 200_000 + "\nend", "dup\nrow"]
    rows = [(k, t, "z", 1) for k, t in enumerate(texts)] + [(9, texts[9], "z", 1), (None, "no\nid\n", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, output string, units int")
    found = infill.output_text(infill.fill_in_middle(docs)).collect()
    assert len(found) == len(rows)
    for r in found:
        text = (dict((k, t) for k, t, *_ in rows[:-1]).get(r.doc_id) if r.doc_id is not None else "no\nid\n") or ""
        lines = text.split("\n")
        lines = [x + "\n" for x in lines[:-1]] + ([lines[-1]] if lines[-1] else [])
        h = hashlib.sha256(f"7:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        h1, h2, _, h4 = (int(h[8 * k:8 * k + 8], 16) for k in range(4))
        low, high = sorted((h1 % (len(lines) + 1), h2 % (len(lines) + 1)))
        a, b, c = "".join(lines[:low]), "".join(lines[low:high]), "".join(lines[high:])
        form = "plain" if not text or "<M>" in text else "spm" if h4 % 100 < 50 else "psm"
        want = {"plain": text, "psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[form]
        assert (r.n, r.form, r.output_text) == (len(lines), form, want)
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else (len(a), len(b)))
        assert r.output_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert infill.fill_in_middle(docs.limit(0)).collect() == []
    assert {r.form for r in infill.fill_in_middle(docs, rate=0).collect()} == {"plain"}


# ---- op13

def test_records_from_any_pieces():
    """Blocks with separators, empty blocks, folded headers, junk between, any cut of the stream."""
    blocks = [b"", b"\r\n", b"\r\n\r\n", b"WARC/1.1\r\nx: y\r\n\r\n", b"a" * 5000, b"end\r\n\r", b"\x00\xff" * 9]
    stream = b"junk\r\n" + b"".join(
        b"WARC/1.1\r\nWARC-Type: resource\r\nX-Long: one\r\n two\r\nContent-Length: %d\r\n\r\n" % len(b) + b + b"\r\n\r\n" for b in blocks)
    for size in (1, 3, 7, 64, 10_000):
        found = list(warc.parse_records(stream[i:i + size] for i in range(0, len(stream), size)))
        assert [b for _, b in found] == blocks
        assert all(dict(f)["x-long"] == "one two" for f, _ in found)
    with pytest.raises(ValueError):
        list(warc.parse_records(iter([stream[:-60]])))


PAGES = "page_id long, url string, html string, digest string, copy int, capture string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "d", 7, None) for r in rows], PAGES)


def test_archive_report_of_odd_rows(spark):
    big, other = "<p>é</p>" * 200, "x\r\n\r\nWARC/1.1\r\n\r\n" * 100
    rows = [(1, "http://a/1", big), (2, "http://a/2", big), (9, None, big), (3, "u", other), (4, "u", other), (5, "u", "small"),
            (6, "u", "small"), (7, "http://b/x y\r\nWARC-Type: z", None), (8, "", ""), (10, "d", big + "!"), (10, "d", big + "!"),
            (None, "n", other), (None, None, "q" * 1000), (None, None, "q" * 1000), (11, "edge", "e" * 999), (12, "edge", "e" * 999),
            (13, "w", "\r" * 70_000 + "\r\n" * 70_000)]
    found = warc.archive_report(pages(spark, rows)).collect()
    assert len(found) == len(rows)
    got = Counter(tuple(r[c] for c in ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")) for r in found)
    want = Counter()
    copies = Counter()
    for page, url, html in rows:
        data = (html or "").encode()
        equal = [(p is not None, p or 0, u is not None, u or "") for p, u, h in rows if (h or "").encode() == data]
        copies[page, url, html] += 1
        best = max(equal) == (page is not None, page or 0, url is not None, url or "") and copies[page, url, html] == 1
        again = len(data) >= 1000 and not best
        want[page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if again else "response",
             max(equal)[1] if again and max(equal)[0] else None] += 1
    assert got == want
    assert warc.archive_report(pages(spark, [])).collect() == []


def test_many_copies_of_one_page(spark):
    rows = [(k, f"http://h/{k}", "same page " * 150) for k in range(400)] + [(k, "u", f"page {k} " * 200) for k in range(400, 500)]
    found = warc.archive_report(pages(spark, rows)).collect()
    assert Counter((r.record_type, r.refers_to) for r in found) == {("response", None): 101, ("revisit", 399): 399}


def test_assembly_of_an_archive_made_elsewhere(spark, tmp_path):
    """Compressed record by record; a response that names its request, a chain through the request,
    metadata of no capture, a revisit without Refers-To."""
    def record(kind, rid, block, *more):
        head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", "WARC-Date: 2020-01-01T00:00:00Z", *more,
                f"Content-Length: {len(block)}"]
        return gzip.compress(("WARC/1.0\r\n" + "\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n")

    http = "Content-Type: application/http; msgtype=response"
    body = b"HTTP/1.0 200 OK\r\nX: 1\r\n\r\nbody\r\n\r\nmore"
    data = b"".join([
        record("warcinfo", "info", b"software: x\r\n"),
        record("response", "r1", body, http, "WARC-Concurrent-To: <q1>", "WARC-Payload-Digest: sha1:AAA"),
        record("request", "q1", b"GET / HTTP/1.0\r\n\r\n"),
        record("metadata", "m1", b"a: b", "WARC-Concurrent-To: <q1>"),
        record("metadata", "m2", b"a: c", "WARC-Concurrent-To: <m1>"),
        record("revisit", "v1", b"HTTP/1.0 200 OK\r\n\r\n", http, "WARC-Payload-Digest: sha1:AAA"),
        record("request", "q2", b"GET / HTTP/1.0\r\n\r\n", "WARC-Concurrent-To: <v1>"),
        record("metadata", "lone", b"x: y", "WARC-Concurrent-To: <gone>")])
    (tmp_path / "a.warc.gz").write_bytes(data)
    records = warc.read_archives(spark, str(tmp_path))
    assert {r.record_id: bytes(r.payload) for r in records.collect()}["<r1>"] == b"body\r\n\r\nmore"
    rows = {r.capture: r for r in warc.assemble(records).collect()}
    assert {r.record_id for r in rows["<r1>"].metadata} == {"<m1>", "<m2>"}
    assert [r.record_id for r in rows["<r1>"].requests] == ["<q1>"]
    assert [r.record_id for r in rows["<v1>"].requests] == ["<q2>"] and rows["<v1>"].record_type == "revisit"
    alone = [r for r in rows.values() if r.response is None]
    assert sorted(m.record_id for r in alone for m in r.metadata) == ["<lone>"]
    linked = warc.with_originals(warc.assemble(records), warc.F.col("capture"), "original")
    assert {r.capture: r.original for r in linked.collect()}["<v1>"] == "<r1>"
