"""Operators on small tables with nulls, empty and repeated rows, ties, extra
columns and no rows, against brute force."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from oddsframe.llm import chat, ngram_join
from oddsframe.llm.common import components, connect
from oddsframe.llm.decontamination import contaminated, decontaminate, with_flag
from oddsframe.llm.embedding_dedup import near_vectors
from oddsframe.llm.html_wrapper import main_text
from oddsframe.llm.language_id import identify_languages
from oddsframe.llm.passages import repeated_passages
from oddsframe.llm.pii import sanitise, span_report
from oddsframe.llm.piece_transducer import decode_pieces, encode_pieces
from oddsframe.llm.queries import MODEL_PATH, ORACLE, QUERIES
from oddsframe.llm.url_rules import RULES, judge_urls
from tests.conftest import SF_ORACLE, SF_SMOKE
from tests.oracle_check import compare, duck

#: ``cls``, ``key``, ``label`` and ``words`` are names that the operators use inside.
DOCS = "doc_id long, text string, lang string, source string, n_chars long, cls string, key int, words int"


def documents(spark, texts, ids=None, lang=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, lang, None, None, "x", 1, 2) for i, t in zip(ids, texts)], DOCS)


def prose(rng, n):
    return [f"w{rng.randint(0, 5000)}" for _ in range(n)]


def test_components_of_paths_and_hubs(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 101 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200)]
    rows = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    want = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 131)}, 200: 200, 201: 200}
    assert {r.node: r.label for r in rows} == want
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_more_links_for_components(spark):
    labels = components(spark.createDataFrame([(1, 2), (5, 6), (8, 9)], "a long, b long"))
    more = spark.createDataFrame([(6, 2), (9, 12), (20, 21), (2, 5)], "a long, b long")
    got = {(r.node, r.label) for r in connect(labels, more).collect()}
    assert got == {(1, 1), (2, 1), (5, 1), (6, 1), (8, 8), (9, 8), (12, 8), (20, 20), (21, 20)}
    assert connect(labels, more.limit(0)) is labels
    none = labels.limit(0)
    assert {(r.node, r.label) for r in connect(none, more.where("a = 20")).collect()} == {(20, 20), (21, 20)}


def test_ngram_join(spark):
    rng = random.Random(1)
    base = prose(rng, 120)
    texts = [None, "", " \t\n", "one two", "ONE two", "one", " ".join(base), " ".join(base).upper(), "x " * 9]
    for _ in range(30):  # a group of near copies, most of them linked through others
        near = list(base)
        for _ in range(3):
            near[rng.randrange(len(near))] = f"e{rng.randint(0, 99999)}"
        texts.append(" ".join(near))
    texts += [" ".join(prose(rng, 80) + base[:30]) for _ in range(10)]
    ids = [*range(len(texts) - 2), 6, None]
    texts[-2], texts[-1] = texts[6], texts[3]

    def grams(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    sets = [grams(t) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i in range(len(texts)):
            for j in range(len(texts)):
                both = len(sets[i] & sets[j])
                if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                    label[i] = min(label[i], label[j])
    smallest = {}
    for i, k in enumerate(label):
        if ids[i] is not None:
            smallest[k] = min(smallest.get(k, ids[i]), ids[i])
    want = sorted((str(ids[i]), len(sets[i]), str(smallest.get(label[i]))) for i in range(len(texts)))
    docs = documents(spark, texts, ids)
    got = ngram_join.ngram_jaccard_join(docs, block=4)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == want
    kept = ngram_join.one_of_each_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    groups = len({k for k, s in zip(label, sets) if s})
    assert len(rows) == groups + sum(not s for s in sets)
    assert ngram_join.ngram_jaccard_join(docs.limit(0)).collect() == []


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((6, 16))
    rows = [v for b in base for v in [b, *(b + 0.05 * rng.standard_normal((4, 16)))]]
    rows = [list(map(float, v)) for v in rows] + [list(map(float, base[0] * 1e200)), None, [], [0.0] * 16,
                                                  [float("nan")] * 16, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 0.0]]
    ids = [*range(len(rows))]
    ids[3], ids[4] = 2, None
    vectors = spark.createDataFrame(list(zip(ids, rows, ["z"] * len(rows))),
                                    "vec_id long, embedding array<double>, cls string")
    got = near_vectors(vectors, block=3).collect()
    units = [np.array(r) / np.abs(r).max() for r in rows[:31]]
    units = np.stack([u / np.linalg.norm(u) for u in units])
    near = units @ units.T >= 0.95
    label = list(range(31))
    for _ in range(31):
        label = [min(label[j] for j in range(31) if near[i, j]) for i in range(31)]
    by = {}
    for i in range(31):
        if ids[i] is not None:
            by[label[i]] = min(by.get(label[i], 99), ids[i])
    want = [(ids[i], int(near[i].sum()) - 1, by[label[i]], ids[i] == by[label[i]]) for i in range(31)]
    want += [(i, 0, i, True) for i in ids[31:]]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert near_vectors(vectors.limit(0)).collect() == []


def test_chats(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK_TURNS", 2)
    turns = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, 0, "user", "a"), (3, 0, "user", "a"),
             (3, 1, "assistant", "b"), (3, 2, "user", "c"), (5, 0, "user", None), (6, 0, "user", ""),
             (7, None, None, None), (None, 1, "x", "y"), (8, 0, "user", "a"), (8, 1, "assistant", "b"), (8, 2, "user", "c")]
    df = spark.createDataFrame([(*t, 1, 2) for t in turns], "conv_id long, turn long, role string, text string, "
                                                            "pos int, block int")
    got = sorted((r.conv_id, r.part, r.n_turns, r.n_copies) for r in chat.format_chats(df).collect())
    assert got == [(3, 0, 3, 2), (3, 1, 3, 2), (5, 0, 1, 1), (6, 0, 1, 1), (7, 0, 1, 1)]
    assert chat.format_chats(df.limit(0)).collect() == []


def test_decontamination(spark):
    rng = random.Random(3)
    items = [" ".join(prose(rng, n)) for n in (20, 40)] + ["tiny one", None, "!!", "tiny one"]
    bench = spark.createDataFrame([(i, t, "q") for i, t in enumerate(items)], "item_id long, text string, key string")
    edited = items[1].split()
    edited[-1] = "other"
    texts = [None, "", items[0].upper().replace(" ", ", "), " ".join(prose(rng, 50)) + " " + " ".join(edited),
             " ".join(prose(rng, 30)) + " " + " ".join(items[1].split()[:20]), "a tiny ONE, b", " ".join(prose(rng, 60))]
    docs = documents(spark, texts + [texts[2]], [*range(len(texts) - 1), None, 2])
    got = {(r.id, r.item): round(r.similarity, 3) for r in contaminated(docs, bench).collect()}
    assert got == {(2, 0): 1.0, (3, 1): round(35 / 37, 3), (5, 2): 1.0, (5, 5): 1.0}
    clean = decontaminate(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == ["0", "1", "4", "None"]
    assert decontaminate(docs, bench.limit(0)).count() == len(texts) + 1
    assert decontaminate(docs.limit(0), bench).count() == 0


def test_url_rules(spark):
    urls = ["http://A.Example.com/en/1", "https://www.example.com/en/", "http://x.net/fr/", "http://net/es/x?y",
            "http://example.org/en/", None, "no scheme/en/", "http://example.com", "ftp://example.com?/en/",
            "http://notexample.com/en/", "x://y://z.com/en/", "http://example.com/en"]
    pages = spark.createDataFrame([(i % 11, u, "z") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = spark.createDataFrame(RULES + [(None, "/", "block"), RULES[0]], "host string, path string, verdict string")

    def judge(url):
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, tail = rest[:cut].lower(), rest[cut:]
        path = tail[:min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
        fits = [(len(h + p), h + p, v) for h, p, v in RULES
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    got = sorted(map(str, map(tuple, judge_urls(pages, rules).collect())))
    assert got == sorted(str((i % 11, *judge(u))) for i, u in enumerate(urls))
    assert judge_urls(pages.limit(0), rules).collect() == []
    assert {r.verdict for r in judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_language_id(spark):
    rng = random.Random(4)
    vocabulary = {"aa": ["the", "and", "with", "that"], "bb": ["über", "nicht", "ßein", "ich"]}
    texts = [" ".join(rng.choices(vocabulary["ab"[i % 2] * 2], k=30)) for i in range(60)]
    rows = [(i, t, ["aa", "bb"][i % 2], "s", 1, "x", 1, 2) for i, t in enumerate(texts)]
    rows += [(100, None, "aa", "", 0, "", 0, 0), (101, "", "bb", "", 0, "", 0, 0), (102, "12 !? ✓", None, "", 0, "", 0, 0),
             (None, "the and", "aa", "", 0, "", 0, 0), (103, "的是不", None, "", 0, "", 0, 0), rows[0]]
    docs = spark.createDataFrame(rows, DOCS)
    got = identify_languages(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == ["aa", "bb"][i % 2] and 0 < by[i].score <= 1 and not by[i].rejected for i in range(60))
    assert all(by[i].lang_pred == "und" and by[i].score == 0 and by[i].rejected for i in (100, 101, 102))
    kept = identify_languages(docs, keep=True)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {*range(60), None}
    assert identify_languages(docs.limit(0)).collect() == []


def test_main_text(spark):
    page = ("<html><title>t</title><nav><a href=x>m{i}</a></nav><div class=k>Same &copy; line</div><article><h1>T{i}</h1>"
            "<p>Body {i} &lt;b&gt;<p>x  y{i}</article><footer>f{i}</footer>")
    rows = [(i, "http://h.com/%d" % i, page.format(i=i), "z") for i in range(5)]
    rows += [(9, "http://alone.org/", page.format(i=9), "z"), (10, None, None, "z"), (11, "http://h.com/e", "", "z"),
             (2, "http://h.com/2", page.format(i=2), "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = sorted((r.page_id, r.text, r.n_chars) for r in main_text(pages).collect())
    body = lambda i: f"T{i}\nBody {i} <b>\nx y{i}"
    want = [(i, body(i), len(body(i))) for i in [0, 1, 2, 2, 3, 4]]
    want += [(9, "Same © line\n" + body(9), len(body(9)) + 12), (10, "", 0), (11, "", 0)]
    assert got == sorted(want)
    assert main_text(pages.limit(0)).collect() == []


def test_copies_of_a_page_are_one_piece_of_evidence(spark):
    def page(name, n):
        lines = "".join(f"<p>{name} line {k}" for k in range(n))
        return f"<html><div class=k>Same line</div><article>{lines}</article>"

    rows = [(i, f"http://h.com/{i}", page("long", 30)) for i in range(4)]
    rows += [(10 + i, f"http://h.com/o{i}", page(f"short{i}", 20)) for i in range(4)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, _ in rows:
        name, n = ("long", 30) if i < 10 else (f"short{i - 10}", 20)
        assert got[i] == "\n".join(f"{name} line {k}" for k in range(n))


def test_near_copies_of_a_page_keep_their_article(spark):
    """Versions of one article that differ in a line are no evidence for template."""
    def page(name, n, date):
        lines = "".join(f"<p>{name} line {k} of the text" for k in range(n))
        return f"<html><div class=k>Same line</div><article><p>on day {date}{lines}</article>"

    rows = [(i, f"http://h.com/{i}", page("long", 31, i)) for i in range(8)]
    rows += [(10 + i, f"http://h.com/o{i}", page(f"short{i}", 22, i)) for i in range(4)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, _ in rows:
        name, n = ("long", 31) if i < 10 else (f"short{i - 10}", 22)
        assert got[i] == "\n".join([f"on day {i % 10}", *(f"{name} line {k} of the text" for k in range(n))])


def test_deep_pages_do_not_end_the_job(spark):
    rows = [(i, f"http://h.com/{i}", "<div>" * 5000 + f"<p>text {i}</p><p>same</p>") for i in range(4)]
    got = {r.page_id: r.text for r in main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"text {i}" for i in range(4)}


def test_pii(spark):
    rng = random.Random(5)
    other = lambda: " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(6))
    texts = [f"{other()} Zorblatt alpha wrote ann.k@site.org today {other()} {i}" for i in range(6)]
    texts += ["alpha " * 200, None, "", "Zorblatt was here", "ip 1.2.3.4, card 4111 1111 1111 1111, +1 (555) 123-4567"]
    docs = documents(spark, texts + [texts[-1]], [*range(len(texts)), None])
    rows = {r.doc_id: r for r in span_report(docs).collect()}
    assert rows[0].n_email == 1 and rows[10].n_ip == rows[10].n_card == rows[10].n_phone == 1
    assert rows[None].spans == rows[10].spans and rows[7].spans == rows[8].spans == ""
    assert rows[9].spans == "term:0:8" and rows[6].n_term == 0
    clean = sanitise(docs)
    assert clean.columns == docs.columns
    found = {r.doc_id: r.text for r in clean.collect()}
    assert found[10] == "ip [IP], card [CARD], [PHONE]" and found[9] == " was here" and found[7] is None
    assert found[6] == texts[6] and "ann.k" not in found[0] and "Zorblatt" not in found[0]
    assert span_report(docs.limit(0)).collect() == []


def test_pieces(spark):
    texts = [None, "", " a  b", "日本 \x00 text\n", "x" * 5000, "the end"]
    docs = documents(spark, texts).withColumnRenamed("cls", "decoded")
    coded = encode_pieces(docs, MODEL_PATH)
    rows = sorted(decode_pieces(coded, MODEL_PATH, text_column="back").collect(), key=lambda r: r.doc_id)
    assert [r.back for r in rows] == ["", *texts[1:]] and rows[0].piece_ids == [] and rows[2].decoded == "x"
    assert encode_pieces(docs.limit(0), MODEL_PATH, decoded_column="decoded").collect() == []


def test_repeated_passages(spark):
    rng = random.Random(6)
    shared = prose(rng, 70)
    fuzzy = list(shared)
    fuzzy[35] = "edit"
    texts = [" ".join(prose(rng, 40) + shared + prose(rng, 40)), " ".join(prose(rng, 9) + fuzzy + prose(rng, 5)),
             " ".join(shared[:40] + prose(rng, 60)), None, "", " ".join(prose(rng, 200)), " ".join(shared)]
    docs = documents(spark, texts + [texts[0], texts[6]], [*range(len(texts)), None, 6])
    got = sorted(tuple(r) for r in repeated_passages(docs).collect())
    assert got == [(1, 9, 79, 0, 40, 110, 69), (6, 0, 70, 0, 40, 110, 70)]
    assert repeated_passages(docs.limit(0)).collect() == []


def exact_repeats(texts, n=50):
    """``(id, place)`` of every run of ``n`` words that a text of a smaller id holds."""
    held, out = {}, []
    for i in sorted(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), texts[i] or ""))
        grams = [tuple(words[p:p + n]) for p in range(len(words) - n + 1)]
        out += [(i, p) for p, g in enumerate(grams) if held.get(g, i) < i]
        for g in grams:
            held.setdefault(g, i)
    return out


def not_reported(texts, rows, n=50):
    """The exact repeats that no passage of the document covers."""
    spans = {}
    for r in rows:
        spans.setdefault(r[0], []).append((r[1], r[2]))
    return [(i, p) for i, p in exact_repeats(texts, n)
            if not any(s <= p and p + n <= e for s, e in spans.get(i, []))]


def test_passages_after_a_long_insertion(spark):
    rng = random.Random(16)
    first, second, third = prose(rng, 500), prose(rng, 80), prose(rng, 60)
    texts = dict(enumerate(map(" ".join, [
        first + second + prose(rng, 30) + third, first + prose(rng, 70) + second + prose(rng, 300) + third,
        second + prose(rng, 200) + first])))
    docs = documents(spark, texts.values(), texts)
    assert len(exact_repeats(texts)) > 900
    assert not_reported(texts, map(tuple, repeated_passages(docs).collect())) == []


def test_exact_repeats_are_whole(spark):
    rng = random.Random(36)
    lines = [prose(rng, 25) for _ in range(5)]
    joined = lines[0] + lines[1] + lines[2]
    texts = [prose(rng, 30) + lines[k] + prose(rng, 30) for k in range(5)]
    texts += [prose(rng, 20) + joined + prose(rng, 20), prose(rng, 40) + joined + prose(rng, 5),
              joined[10:60] + prose(rng, 30), prose(rng, 8) + lines[3][:10] * 9, lines[3][:10] * 30,
              prose(rng, 20) + ["ha"] * 55 + prose(rng, 20), ["ha"] * 300, ["ha"] * 200 + prose(rng, 50)]
    texts = {i: " ".join(t) for i, t in enumerate(texts)}
    texts[20], again = texts[6], texts[11]
    docs = documents(spark, [*texts.values(), again], [*texts, 20])
    rows = [tuple(r) for r in repeated_passages(docs).collect()]
    assert {i for i, _ in exact_repeats(texts)} == {6, 7, 9, 11, 12, 20}
    assert not_reported(texts, rows) == [] and not_reported({**texts, 20: again}, rows) == []
    for i, s, e, ref, rs, re_, matched in rows:
        assert ref < i and min(e - s, re_ - rs) >= 50 and matched >= 0.8 * max(e - s, re_ - rs)


@pytest.mark.parametrize("sf", [SF_SMOKE, SF_ORACLE])
def test_exact_repeats_of_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [tuple(r) for r in repeated_passages(docs).collect()]
    print("runs of 50 words", len(exact_repeats(texts)), "passages", len(rows))
    assert not_reported(texts, rows) == []


@pytest.mark.parametrize("length, identity, least", [(60, 0.9, 0.97), (60, 0.85, 0.9), (100, 0.85, 0.97)])
def test_recall_of_edited_passages(spark, length, identity, least):
    rng = random.Random(26)
    texts, edits = [], 0
    for _ in range(100):
        shared = prose(rng, length)
        copy = list(shared)
        for at in rng.sample(range(length), round(length * (1 - identity))):
            copy[at], edits = f"edit{edits}", edits + 1
        texts += [" ".join(prose(rng, 30) + shared + prose(rng, 30)), " ".join(prose(rng, 30) + copy + prose(rng, 30))]
    found = {(r.doc_id, r.ref_id) for r in repeated_passages(documents(spark, texts)).collect()}
    recall = sum((i + 1, i) in found for i in range(0, 200, 2)) / 100
    print("recall", length, identity, recall)
    assert recall >= least


@pytest.mark.parametrize("name", ["op3_ngram_join", "op5_decontamination", "op6_url_filter"])
def test_queries_match_their_sql(spark, name):
    res = compare(spark, duck(SF_SMOKE), name, QUERIES[name], ORACLE[name], SF_SMOKE)
    assert res["status"] == "OK"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").where("lang is not null").select("doc_id", "lang")
    found = QUERIES["op7_language_id"](spark, SF_ORACLE).where("held_out").join(docs, "doc_id")
    right, all_rows = found.where("lang_pred = lang").count(), found.count()
    print("held-out accuracy", right, "of", all_rows)
    assert right >= 0.95 * all_rows > 0


def test_passages_whose_seeds_were_first_held_elsewhere(spark):
    rng = random.Random(46)
    shared = prose(rng, 90)
    lines = [shared[i:i + 15] for i in range(0, 90, 15)]
    texts = [" ".join(prose(rng, 20) + line + prose(rng, 20)) for line in lines]
    texts.append(" ".join([w for line in lines[::-1] for w in line + prose(rng, 50)]))
    texts.append(" ".join(prose(rng, 30) + shared + prose(rng, 10)))
    edited = [w if i % 30 != 17 else f"edit{i}" for i, w in enumerate(shared)]
    texts.append(" ".join(prose(rng, 25) + edited + prose(rng, 40)))
    rows = {(r.doc_id, r.ref_id): r for r in repeated_passages(documents(spark, texts)).collect()}
    assert set(rows) == {(8, 7)}
    assert (rows[8, 7].start_word, rows[8, 7].end_word, rows[8, 7].ref_start, rows[8, 7].matched) == (25, 115, 30, 87)


def test_flags_let_every_wanted_row_through(spark):
    rows = spark.range(-4000, 4000).select(F.xxhash64("id").alias("key"), "id", F.lit("x").alias("map"))
    wanted = rows.where("id % 100 = 0 or id < -3990").select(F.col("key").alias("k"))
    told = with_flag(rows, wanted, "key", "maybe")
    assert told.columns == ["key", "id", "map", "maybe"]
    got = {r.id: r.maybe for r in told.collect()}
    assert len(got) == 8000 and all(m for i, m in got.items() if i % 100 == 0 or i < -3990)
    assert sum(got.values()) < 200 and not any(r.maybe for r in with_flag(rows, wanted.limit(0), "key", "maybe").collect())
    assert not with_flag(rows.limit(1).withColumn("key", F.lit(None).cast("long")), wanted, "key", "maybe").first().maybe
    # Rows meet the filter where they are.
    assert "SortMergeJoin" not in told._jdf.queryExecution().executedPlan().toString()


def test_decontamination_keeps_clean_rows_whatever_their_columns(spark):
    rng = random.Random(56)
    item = prose(rng, 30)
    texts = [" ".join(prose(rng, 60)) for _ in range(50)] + [" ".join(prose(rng, 9) + item + prose(rng, 9)), None, ""]
    docs = documents(spark, texts, [*range(51), None, None]).withColumn("map", F.lit(1)).withColumn("maybe", F.lit(2))
    benchmark = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    clean = decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in clean.collect()) == [
        *[(False, i) for i in range(50)], (True, 0), (True, 0)]


def test_edited_passages_around_a_common_line(spark):
    rng = random.Random(66)
    line, other = prose(rng, 10), prose(rng, 10)
    texts = [line + prose(rng, 30), prose(rng, 30) + other]
    texts += [prose(rng, 30) + line + other + prose(rng, 30) for _ in range(20)]  # held in over 16 ways
    shared = prose(rng, 20) + line + other + prose(rng, 20)
    edited = [f"edit{i}" if i in (4, 9, 14, 19, 40, 45, 50, 55) else w for i, w in enumerate(shared)]
    texts += [prose(rng, 9) + shared + prose(rng, 9), prose(rng, 20) + edited + prose(rng, 9)]
    rows = [tuple(r) for r in repeated_passages(documents(spark, [" ".join(t) for t in texts])).collect()]
    assert rows == [(23, 20, 80, 22, 9, 69, 52)]
