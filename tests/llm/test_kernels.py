"""The operators' kernels against plain versions, without Spark."""

from __future__ import annotations

import os
import random
import time
import tracemalloc
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from oddsframe.llm import common, embedding_dedup, html_wrapper, language_id, ngram_join, passages, pii, words
from oddsframe.llm.decontamination import hamming_blocks
from oddsframe.llm.embedding_dedup import code_shape, rotations
from oddsframe.llm.queries import MODEL_PATH

TEXT = st.text(alphabet=st.sampled_from(list("abcAB é\u2003\n\t \x0b日1.,")), max_size=60)


def plain_words(text):
    return text.encode().lower().split()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_and_shingles(texts):
    column = pa.array(texts, pa.string())
    found, first = words.text_words(column)
    want = [plain_words(t or "") for t in texts]
    assert np.diff(first).tolist() == [len(w) for w in want]
    named = {}
    for w, h in zip([w for t in want for w in t], found.tolist()):
        assert named.setdefault(w, h) == h
    assert len(set(named.values())) == len(named)
    for w, s in zip(want, words.shingle_sets(column, 5)):
        grams = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        assert len(s) == len(grams)


def test_words_longer_than_a_slice():
    text = "x" * (words.SLICE * 2 + 5) + " y " + "Z" * (words.SLICE + 1)
    found, first = words.text_words(pa.array([text, text.lower()], pa.string()))
    assert first.tolist() == [0, 3, 6] and found[:3].tolist() == found[3:].tolist()


def test_bitmaps_bound_the_overlap_and_prefixes_meet():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n, m = rng.integers(1, 300, 2)
        pool = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
        a, b = np.unique(rng.choice(pool, n)), np.unique(rng.choice(pool, m))
        if rng.random() < 0.5:
            b = np.unique(np.concatenate([a[: int(len(a) * 0.93)], b[:2]]))
        both = len(np.intersect1d(a, b))
        linked = 100 * both >= 80 * (len(a) + len(b) - both)
        maps = [ngram_join.parity_bitmap(x) for x in (a, b)]
        args = (np.array([1, 2]), np.array([1, 2]), np.array([len(a), len(b)]), maps, 80)
        for every in (False, True):
            found = len(ngram_join.tile_pairs(*args, every)[0]) > 0
            small = len(ngram_join.small_tile_pairs([1, 2], [1, 2], [len(a), len(b)], maps, 80, every)) > 0
            assert found == small
            assert found or not linked
        if linked:
            pa_, pb = a[:ngram_join.prefix_length(len(a), 80)], b[:ngram_join.prefix_length(len(b), 80)]
            assert len(np.intersect1d(pa_, pb))


def test_code_estimates_stay_within_their_bound():
    rng = np.random.default_rng(3)
    width, bands = code_shape(5000, 0.95)
    bits = width * bands
    turn = rotations(64, bits, 1)
    assert np.allclose(turn.T @ turn, np.eye(64), atol=0.2)
    x = rng.standard_normal((300, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = x + 0.05 * rng.standard_normal(x.shape)
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    tx, ty = x @ turn.T, y @ turn.T
    factor = np.abs(tx).sum(1) / bits ** 0.5
    estimate = (np.sign(tx) * ty).sum(1) / bits ** 0.5 / factor
    error = estimate - (x * y).sum(1)
    assert abs(error.mean()) < 0.02
    assert (np.abs(error) <= 5 * np.sqrt((1 - factor ** 2) / (factor ** 2 * (bits - 1))) + 1e-9).all()


def test_hamming_blocks_cover_all_bits_once():
    for radius in (0, 3, 15, 63):
        blocks = hamming_blocks(radius)
        assert len(blocks) == radius + 1 and sum(w for _, w in blocks) == 64
        assert all(a + w == b for (a, w), (b, _) in zip(blocks, blocks[1:]))


def plain_base(text):
    out = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c in "0123456789"]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(reversed(d)))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((*m.span(), "phone"))
    return sorted(out, key=lambda s: (s[0], pii.KINDS.index(s[2])))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a@b.c", "x", "@", ".", "-", " ", "1", "23", "255", "256", "+4", "(", ")", "é", "٣",
                                 "4111111111111111", "1.2.3.4", "a.b@", "c-d.e", "\n", "%", "000"]), max_size=14))
def test_base_spans(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == plain_base(text)


def test_long_runs_of_digits_and_letters_are_read_once():
    assert pii.base_spans("1" * 50_000 + ".2.3.4") == []
    assert pii.base_spans("." + "1" * 500_000) == []
    assert pii.base_spans("a" * 50_000 + "@") == []


def test_transducer_equals_the_library():
    spm = pytest.importorskip("sentencepiece")
    if not os.path.exists(MODEL_PATH):
        pytest.skip("no model file")
    from oddsframe.llm.piece_transducer import PieceTransducer

    with open(MODEL_PATH, "rb") as f:
        ours = PieceTransducer(f.read())
    library = spm.SentencePieceProcessor(model_file=MODEL_PATH)
    rng = random.Random(0)
    parts = [" ", "  ", "the", "ing", "tion", "\n", "é", "日本", "a", "0", "12", ".", "🙂", "\x00", "    ", "xx", ","]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 16)))
        assert ours.encode(text) == library.encode(text)
        assert ours.decode(ours.encode(text)) == text


def test_chunks_relaxed_together_equal_the_library(monkeypatch):
    spm = pytest.importorskip("sentencepiece")
    if not os.path.exists(MODEL_PATH):
        pytest.skip("no model file")
    from oddsframe.llm import piece_transducer

    with open(MODEL_PATH, "rb") as f:
        ours = piece_transducer.PieceTransducer(f.read())
    library = spm.SentencePieceProcessor(model_file=MODEL_PATH)
    rng = random.Random(1)
    letters = "abcdeghilnorstuy  .,-019\n\x00éß日本🙂"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 90))) for _ in range(3000)]
    texts += ["", " ", "x" * 70, "a" * 5000, texts[0]]
    want = [library.encode(t) for t in texts]
    monkeypatch.setattr(piece_transducer, "BATCH", 4000)   # several compositions in one call
    for _ in range(2):                                     # new chunks, then known ones
        got = ours.encode_many(texts)
        assert [np.frombuffer(p, np.int32).tolist() for p in got] == want
    monkeypatch.setattr(piece_transducer, "_SEEN", 16)     # neighbours that share a place
    small = piece_transducer.PieceTransducer(open(MODEL_PATH, "rb").read())
    monkeypatch.setattr(piece_transducer, "MEMO", 10)
    assert small.encode_many(texts) == got
    assert ours.encode_many([]) == []
    assert [ours.decode(i) for i in want] == texts


def test_unigram_paths_cost_least():
    from oddsframe.llm.piece_transducer import PieceTransducer

    def message(*fields):
        out = b""
        for number, value in fields:
            if isinstance(value, bytes):
                out += bytes([number << 3 | 2, len(value)]) + value
            elif isinstance(value, float):
                out += bytes([number << 3 | 5]) + np.float32(value).tobytes()
            else:
                out += bytes([number << 3, value])
        return out

    pieces = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -1.0, 1), ("b", -1.0, 1), ("ab", -1.5, 1), ("▁ab", -4.0, 1)]
    model = b"".join(message((1, message((1, t.encode()), (2, s), (3, k)))) for t, s, k in pieces)
    model += message((2, message((3, 1)))) + message((3, message((3, 1), (4, 1))))
    ours = PieceTransducer(model)
    assert ours.encode("ab") == [1, 4]         # 3.5 beats 4 and 4
    assert ours.encode("  a  é ") == [1, 2, 1, 0]
    assert ours.decode(ours.encode("ab a")) == "ab a"


def test_html_blocks():
    def read(html):
        return [b.text for b in html_wrapper.text_blocks(html_wrapper.parse(html)) if not b.marked]

    assert read("<p>a<p>b <i>c</i>d<br>e") == ["a", "b cd e"]
    assert read('<div class="sidebar">x</div><main><h2>T</h2>x &amp; y<ul><li>1<li>2</ul></main>') == [
        "T", "x & y", "1", "2"]
    assert read("a < b <!-- c --> d <script>if(a<b){}</script><style>p{}</style>") == ["a < b d"]
    assert read("<article><header><h1>T</h1></header><p>q</article><header>no</header><form>f</form>") == ["T", "q"]
    assert read('<div id="comments"><p>no</div><p hidden>h</p><section class="no-sidebar">k</section>') == ["k"]
    assert read("") == [] and read("<b>x") == ["x"]


def test_sections_of_an_article_are_kept():
    html = ('<article><section id="related-work"><p>r</section><div id="social-history">s</div>'
            '<p class="notice-period">n</p><div class="share-buttons">b</div><div class="newsletter">l</div></article>'
            '<div id="social-history">out</div>')
    assert [b.text for b in html_wrapper.text_blocks(html_wrapper.parse(html)) if not b.marked] == ["r", "s", "n"]


def test_tree_matching_is_the_best_one():
    def brute(a, b):
        if a.label != b.label:
            return 0
        table = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
        for i, x in enumerate(a.children):
            for j, y in enumerate(b.children):
                table[i + 1][j + 1] = max(table[i][j + 1], table[i + 1][j], table[i][j] + brute(x, y))
        return 1 + table[-1][-1]

    rng = random.Random(2)

    def grow(depth):
        node = html_wrapper.Node(rng.choice("abc") if depth < 3 else "r", False)
        node.children = [grow(depth - 1) for _ in range(rng.randint(0, 4))] if depth else []
        return node

    for _ in range(200):
        a, b = grow(3), grow(3)
        shapes = html_wrapper.Shapes()
        assert shapes.weight(shapes.of(a)[0], shapes.of(b)[0]) == brute(a, b)


def _table_pairs(shapes, x, y):
    """The best matching from the whole table, with the same choice among equals."""
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            w = shapes.weight(x[i], y[j])
            best[i][j] = max(best[i + 1][j], best[i][j + 1], best[i + 1][j + 1] + w if w else 0)
    return best[0][0]


def test_long_lists_of_children_are_matched_as_well_as_short_ones(monkeypatch):
    rng = random.Random(5)

    def child():
        node = html_wrapper.Node(rng.choice(["p", "ul", "h2"]), False)
        node.children = [html_wrapper.Node("#text", False, "t") for _ in range(rng.randint(0, 4))]
        return node

    def parent(n):
        node = html_wrapper.Node("div", False)
        node.children = [child() for _ in range(n)]
        return node

    for size in (3, 17, 90):
        a, b = parent(size), parent(size + 5)
        shapes = html_wrapper.Shapes()
        (_, left), (_, right) = shapes.of(a), shapes.of(b)
        x, y = tuple(p[0] for p in left), tuple(p[0] for p in right)
        by_table = shapes.pairs(x, y) if size < 60 else None
        monkeypatch.setattr(html_wrapper, "_TABLE", 1)
        by_rows, weight = shapes.pairs(x, y), html_wrapper.Shapes()
        assert by_table is None or by_rows == by_table
        assert sum(shapes.weight(x[i], y[j]) for i, j in by_rows) == _table_pairs(shapes, x, y)
        assert all(i < k and j < m for (i, j), (k, m) in zip(by_rows, by_rows[1:]))
        assert weight.weight(weight.of(a)[0], weight.of(b)[0]) == 1 + _table_pairs(shapes, x, y)
        monkeypatch.undo()


def test_twenty_thousand_mixed_children_align_within_seconds():
    rng = random.Random(6)

    def page():
        return html_wrapper.parse("<article>" + "".join(
            rng.choice(["<p>x", "<h2>t</h2>", "<ul><li>a<li>b</ul>", "<ul><li>a</ul>", f"<div class=c{rng.randint(0, 3000)}>d</div>"])
            for _ in range(20_000)) + "</article>")

    a, b = page(), page()
    began = time.monotonic()
    found = html_wrapper.aligned(a, b, html_wrapper.Shapes())
    assert len(found) > 5000 and time.monotonic() - began < 60


def test_trees_of_any_depth():
    def page(text, depth=5000):
        return html_wrapper.parse("<div>" * depth + f"<p>{text}</p><p>same</p>")

    a, b = page("one"), page("two", 4990)
    shapes = html_wrapper.Shapes()
    assert len(html_wrapper.aligned(a, page("three"), shapes)) == 2
    assert html_wrapper.aligned(a, b, shapes) == {}
    back, texts = html_wrapper._unpacked(html_wrapper._packed(a))
    assert shapes.of(back)[0] == shapes.of(a)[0] and sorted(texts.values()) == [3, 4]


def test_formulas_and_labels_of_an_article_are_text():
    def read(html):
        return [b.text for b in html_wrapper.text_blocks(html_wrapper.parse(html)) if not b.marked]

    assert read("<article><p>Energy is <math><mi>E</mi></math> here, <label>l</label> <output>4</output> "
                "<object>o</object></article>") == ["Energy is E here, l 4 o"]
    assert read("<article><p>a<form><label>l</label></form></article><label>out</label>") == ["a"]


def test_chains_are_collinear_and_cover_a_planted_passage():
    rng = np.random.default_rng(1)
    x = np.concatenate([np.arange(100, 160, 6), rng.integers(0, 400, 20)]).astype(np.int64)
    y = np.concatenate([np.arange(300, 360, 6), rng.integers(0, 400, 20)]).astype(np.int64)
    found = passages.chain(x, y)
    assert sorted(i for c in found for i in c) == list(range(len(x)))
    for c in found:
        assert (np.diff(x[c]) > 0).all() and (np.diff(y[c]) > 0).all()
    assert set(range(10)) <= set(found[0])


def test_chains_go_on_after_a_long_insertion():
    x = np.concatenate([np.arange(0, 500, 6), np.arange(600, 700, 6)])
    y = np.concatenate([np.arange(0, 500, 6), np.arange(500, 600, 6)])
    assert sorted(map(len, passages.chain(x, y))) == [17, 84]


def test_alignment_bridges_edits():
    rng = np.random.default_rng(4)
    a = rng.integers(0, 1 << 60, 120)
    b = np.concatenate([rng.integers(0, 1 << 60, 30), a[20:50], rng.integers(0, 1 << 60, 1), a[51:100]])
    s, e, rs, re_, matched = passages.align(a, b, np.array([22, 60]), np.array([32, 70]))
    assert (s, e, rs, re_, matched) == (20, 100, 30, 110, 79)


def test_gram_counts_do_not_depend_on_slices(monkeypatch):
    column = pa.array(["Über the É!! 12 quick", None, "", "x" * 300, "the the"], pa.string())
    want = language_id.gram_counts(column)
    assert want[1].sum() == want[2].sum() == 0
    assert (language_id.gram_counts(pa.array(["über the é!! 99 quick"]))[0] == want[0]).all()
    monkeypatch.setattr(language_id, "_BYTES", 7)
    assert (language_id.gram_counts(column) == want).all()


def plain_scores(x, y):
    """Chain scores by looking at every earlier match."""
    reach, score = passages.MAX_GAP + passages.K, [0] * len(x)
    for j in np.lexsort((-y, x)).tolist():
        score[j] = passages.WORD_GAIN * passages.K
        for i in range(len(x)):
            dx, dy = int(x[j] - x[i]), int(y[j] - y[i])
            if 0 < dx <= reach and 0 < dy <= reach:
                words = min(dx, dy, passages.K)
                score[j] = max(score[j], score[i] + passages.WORD_GAIN * words - (dx + dy - 2 * words))
    return score


def test_fenwick_chains_score_as_all_earlier_matches_do():
    rng = np.random.default_rng(3)
    for n, spread in ((0, 1), (1, 1), (40, 12), (60, 40), (80, 300), (150, 90)):
        for _ in range(12):
            x, y = rng.integers(0, spread, n), rng.integers(0, spread, n)
            score, before = passages.predecessors(x, y)
            assert score == plain_scores(x, y)
            for j, i in enumerate(before):
                assert i < 0 or (x[i] < x[j] and y[i] < y[j])


def test_max_tree_values_may_fall():
    rng = np.random.default_rng(4)
    tree, held = passages.MaxTree(37), {}
    for _ in range(600):
        slot = int(rng.integers(1, 38))
        held[slot] = None if rng.random() < 0.4 else int(rng.integers(-50, 50))
        tree.assign(slot, held[slot])
        low, high = sorted(int(v) for v in rng.integers(1, 38, 2))
        best = max((v for k, v in held.items() if low <= k <= high and v is not None), default=None)
        assert tree.value[tree.best(low, high)] == best


def test_chains_of_many_groups_are_those_of_each():
    rng = np.random.default_rng(12)
    parts = []
    for g in range(60):
        x = np.cumsum(rng.choice([1, 2, 5, 6, 9, 40, 60], 50))
        y = x + 400 + np.cumsum(np.where(rng.random(50) < 0.05, rng.integers(5, 30, 50), 0))
        y = np.where(rng.random(50) < 0.02 * (g % 4), rng.integers(0, 600, 50), y)
        parts.append((x, y, np.full(50, g)))
    x, y, group = map(np.concatenate, zip(*parts))
    matches, first = passages.chains_of_groups(x, y, group, 2)
    got = sorted(tuple(matches[a:b].tolist()) for a, b in zip(first, first[1:]))
    assert got == sorted(tuple(50 * g + i for i in links) for g, (a, b, _) in enumerate(parts)
                         for links in passages.chain(a, b) if len(links) > 1)
    assert len(passages.chains_of_groups(x[:0], y[:0], group[:0], 2)[0]) == 0


def test_chunks_of_a_batch_give_its_classes_once(monkeypatch):
    texts = [f"w{i % 40} a b c d e {i % 40}" for i in range(120)] + [None, "", "x"]
    wanted = np.full(1 << 10, 255, np.uint8)
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    want = [r for out in ngram_join._arrays(5, wanted)(iter([batch])) for r in out.to_pylist()]
    monkeypatch.setattr(words.chunks, "__defaults__", (200,))
    parts = list(ngram_join._arrays(5, wanted)(iter([batch])))
    assert [r for out in parts for r in out.to_pylist()] == want and len(want) == 41
    assert max(out.num_rows for out in parts) < 20


def test_a_worker_forgets_the_transducer_when_another_operator_begins(monkeypatch):
    from oddsframe.llm import piece_transducer

    monkeypatch.setattr(piece_transducer.SparkFiles, "get", lambda name: MODEL_PATH)
    kept = piece_transducer._compiled("model")
    assert piece_transducer._compiled("model") is kept
    model = pd.DataFrame({"lang": [], "floor": [], "centre": []})
    kernel = language_id._predict(model, np.ones(language_id.DIMS), "text", ["text"], True)
    list(kernel(iter([pa.RecordBatch.from_pydict({"text": ["a text"]})])))
    assert piece_transducer._compiled.cache_info().currsize == 0


def test_gram_counts_hold_little_beside_the_counts():
    texts = pa.array(["some words of a text " * 400] * 120)
    tracemalloc.start()
    counts = language_id.gram_counts(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert counts.sum() > 120 * 8000
    assert peak < 40 << 20


def test_minimisers_of_many_texts_are_those_of_each(monkeypatch):
    monkeypatch.setattr(passages, "_SLICE", 64)
    rng = np.random.default_rng(3)
    for _ in range(40):
        sizes = rng.choice([0, 3, 5, 7, 8, 64, 68, 69, 70, 71, 72, 133, 134, 135, 200], 9)
        text = rng.integers(0, 30, sizes.sum()).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum(sizes)])
        every, want = words.sequence_hashes(text, passages.K), []
        for s, e in zip(first[:-1], first[1:]):
            own = every[s:max(s, e - passages.K + 1)]
            places = [passages.minimisers(own[i:i + 64 + passages.WINDOW - 1]) + i for i in range(0, len(own), 64)]
            want += [s + p for p in sorted(set(np.concatenate(places).tolist()))] if places else []
        place, text_of = passages.text_minimisers(every, first)
        assert place.tolist() == want
        assert all(first[d] <= p < first[d + 1] for p, d in zip(place, text_of))


def test_blocks_of_seeds_name_the_first_holder():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(60)]
    passage = " ".join(vocabulary[:40])
    texts = [None, "", passage] + [" ".join(rng.choice(vocabulary, 30)) + " " + passage * (i % 2) for i in range(20)]
    ids = rng.integers(0, 12, len(texts))
    batches = [pa.RecordBatch.from_pydict({"id": ids[a:a + 4], "text": pa.array(texts[a:a + 4], pa.string())})
               for a in range(0, len(texts), 4)]
    held = {}
    for h, own, pos in passages._chunk_seeds(iter(batches)):
        for seed, i, p in zip(h.view(np.int64).tolist(), own.tolist(), pos.tolist()):
            held.setdefault(seed, set()).add((i, p))
    want = {(seed, *min(places)) for seed, places in held.items() if len({i for i, _ in places}) > 1}
    blocks = pa.Table.from_batches(passages._blocks(4)(iter(batches))).combine_chunks().sort_by("range")
    found = pa.Table.from_batches(passages._first_holders(iter(blocks.to_batches(max_chunksize=3))))
    assert sorted(zip(*(found.column(c).to_pylist() for c in ("h", "ref", "ref_pos")))) == sorted(want)


def test_hashes_of_long_runs_tell_runs_apart():
    text = np.random.default_rng(7).integers(0, 2, 3000).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for n in (1, 3, 31, 50, 64):
        named = {}
        found = words.long_sequence_hashes(text, n).tolist()
        assert len(found) == 3001 - n
        for i, h in enumerate(found):
            assert named.setdefault(text[i:i + n].tobytes(), h) == h
        assert len(set(named.values())) == len(named)


def test_prefixes_hold_the_sets_of_a_chunk_only():
    rng = np.random.default_rng(11)
    texts = pa.array([" ".join(map(str, rng.integers(0, 1 << 30, 250))) for _ in range(2500)])
    batch = pa.RecordBatch.from_pydict({"text": texts})
    kernel = ngram_join._prefixes(5, 80, np.zeros(1 << ngram_join.SKETCH_BITS, bool))
    rows = 0
    tracemalloc.start()
    for out in kernel(iter([batch])):
        rows += out.num_rows
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2500 * ngram_join.prefix_length(246, 80)
    assert peak < 14 << 20, peak


def odd_texts(rng):
    """Two texts of common lines, runs of one word and prose, with edited copies of each other's parts."""
    names = np.array([f"w{i}" for i in range(400)])
    lines = [rng.choice(names, rng.integers(6, 30)).tolist() for _ in range(6)]

    def piece():
        kind = rng.integers(4)
        if kind == 0:
            return list(lines[rng.integers(6)])
        if kind == 1:
            return [str(names[rng.integers(3)])] * int(rng.integers(5, 60))
        return rng.choice(names, rng.integers(5, 40)).tolist()

    one = [w for _ in range(8) for w in piece()]
    two = []
    for _ in range(5):
        a = int(rng.integers(len(one)))
        copy = one[a:a + int(rng.integers(10, 120))]
        rate = rng.choice([0, 0.1, 0.2])
        two += [w for w in copy for w in ([w] if rng.random() >= rate else [["edit"], [], [w, "more"]][rng.integers(3)])]
        two += piece()
    return " ".join(one), " ".join(two)


def test_contexts_that_are_ruled_out_hold_no_passage():
    every, accepted, ruled_out, all_pairs = np.full(64, 255, np.uint8), 0, 0, 0
    for trial in range(5):
        texts = odd_texts(np.random.default_rng(trial))
        batch = pa.RecordBatch.from_pydict({"id": pa.array([0, 1]), "text": pa.array(texts)})
        (_, words_, place, first, of, _, _, y, y2), = passages._chunk_pairs(iter([batch]), every, every, 100)
        shown = pa.Table.from_batches(passages._contexts(every, every, every, every, 100)(iter([batch])))
        around = np.stack([np.frombuffer(w.as_py(), np.uint32) for w in shown.column("words")])
        gap, seeds = shown.column("gap").to_numpy(), [np.frombuffer(w.as_py(), np.uint16) for w in shown.column("seeds")]
        at = {(int(o), int(a - first[o]), int(b - first[o])): n for n, (o, a, b) in enumerate(zip(of, y, y2))}
        text = [words_[first[o]:first[o + 1]] for o in (0, 1)]
        h = [words.sequence_hashes(t, passages.K) for t in text]
        own = [place[(place >= first[o]) & (place < first[o + 1])] - first[o] for o in (0, 1)]
        same = np.argwhere(h[1][own[1]][:, None] == h[0][own[0]][None])
        x, ref = own[1][same[:, 0]], own[0][same[:, 1]]
        matches, begins = passages.chains_of_groups(x, ref, np.zeros(len(x), np.int64), 2)
        wanted = []
        for a, b in zip(begins, begins[1:]):
            xs, ys = x[matches[a:b]], ref[matches[a:b]]
            s, e, rs, re_, matched = passages.align(text[1], text[0], xs, ys)
            # Where a passage is no longer than the contexts, each of its pairs says that there is one.
            if 50 <= min(e - s, re_ - rs) and max(e - s, re_ - rs) <= min(100, matched / 0.8):
                wanted += [(at[1, int(p), int(q)], at[0, int(u), int(v)]) for p, q, u, v in zip(xs, xs[1:], ys, ys[1:])]
        left, right = np.flatnonzero(of == 1), np.flatnonzero(of == 0)
        left = np.unique([*left[::40], *[i for i, _ in wanted]])
        alike = {(i, int(j)) for i, some in passages._alike(around, gap, seeds, left, right, 50, 40.0, 100) for j in some}
        assert set(wanted) <= alike
        accepted += len(wanted)
        ruled_out, all_pairs = ruled_out + len(left) * len(right) - len(alike), all_pairs + len(left) * len(right)
    print("links of passages", accepted, "ruled out", ruled_out, "of", all_pairs)
    assert accepted > 100 and ruled_out > 0.02 * all_pairs


def test_sequences_of_one_document_stay_whatever_the_filter_holds():
    rng = np.random.default_rng(9)
    shared, lone = rng.integers(0, 1 << 60, 80), rng.integers(0, 1 << 60, 400)
    texts = [" ".join(f"w{w}" for w in [*lone[:200], *shared, *lone[200:]]), " ".join(f"w{w}" for w in shared)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array([4, 7]), "text": pa.array(texts)})
    full, held = np.full(64, 255, np.uint8), np.zeros(1 << 12, np.uint8)
    words_, first = words.text_words(batch.column("text"))
    every = words.sequence_hashes(words_[200:280], passages.K)
    for slot in common._slots(every.view(np.int64), 1 << 15):
        np.bitwise_or.at(held, slot >> 3, (128 >> (slot & 7)).astype(np.uint8))
    rows = pa.Table.from_batches(passages._held(full, held, 50)(iter([batch])))
    found = set(zip(rows.column("id").to_pylist(), rows.column("pos").to_pylist()))
    whole = {(4, 200 + p) for p in range(31)} | {(7, p) for p in range(31)}
    assert whole <= found and len(found) < len(whole) + 10
    assert len(pa.Table.from_batches(passages._held(full, full, 50)(iter([batch])))) == 431 + 31


def test_large_groups_of_near_vectors_fit_in_memory():
    rng, count, (width, bands) = np.random.default_rng(12), 1500, code_shape(600_000, 0.95)
    vectors = rng.standard_normal(64) + 0.2 * rng.standard_normal((count, 64))
    vectors[-1] = -vectors[0]
    column = pa.array(list(vectors), pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_pydict({"cls": pa.array(np.arange(count)), "v": column})
    codes = pa.Table.from_batches(embedding_dedup._encode(width, bands, 7)(iter([batch]))).drop(["keys"])
    same = {c: pa.array(np.zeros(count, kind)) for c, kind in (
        ("bucket", np.int64), ("own", np.int32), ("lo", np.int32), ("hi", np.int32))}
    bits = np.stack([np.unpackbits(np.frombuffer(c.as_py(), np.uint8), count=width * bands) for c in codes.column("code")])
    last = bits.reshape(count, bands, width)
    fresh = np.array([~(last[i, :-1] == last[:, :-1]).all(2).any(1) for i in range(count)])
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    linked = fresh & (unit @ unit.T >= 0.95)
    np.fill_diagonal(linked, False)
    for size in (1, 3):
        tile = pa.RecordBatch.from_pydict({
            **same, "band": pa.array(np.full(count, bands - 1, np.int32)), "size": pa.array(np.full(count, size)),
            **{c: codes.column(c).combine_chunks() for c in ("cls", "code", "factor", "v")}})
        tracemalloc.start()
        rows = pa.Table.from_batches(embedding_dedup._compare(0.95, width, bands, 7)(iter([tile])))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert dict(zip(rows.column("a").to_pylist(), rows.column("others").to_pylist())) == {
            i: int(n) * size for i, n in enumerate(linked.sum(1)) if n}
        assert len(rows) < count and peak < 150e6
    print("peak MB", peak / 1e6, "links", linked.sum() // 2)
