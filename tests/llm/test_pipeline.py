"""The corpus pipeline over the smallest tables: near duplicates against brute
force, and what the last stage holds against the stages before it."""

from __future__ import annotations

import re

import sentencepiece

import corpus_pipeline
from oddsframe.llm.queries import MODEL_PATH
from tests.conftest import SF_SMOKE

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def shingles(text: str | None) -> frozenset:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(found[i:i + 5]) for i in range(max(1, len(found) - 4))) if found else frozenset()


def representatives(texts: dict[int, str | None]) -> set[int]:
    """The smallest id of each component, by comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    label = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((label[a], label[b]))
                label = {i: low if v == high else v for i, v in label.items()}
    return set(label.values())


def test_pipeline(spark, monkeypatch):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "ngram_join", "decontamination", "pii", "sentencepiece"]
    stages = []
    cut = corpus_pipeline.cut

    def kept(df):
        stages.append(cut(df))
        return stages[-1]

    monkeypatch.setattr(corpus_pipeline, "cut", kept)
    rows = corpus_pipeline.run(spark, SF_SMOKE).collect()
    docs = spark.read.parquet(f"{SF_SMOKE}/documents.parquet")
    assert all(s.columns == docs.columns for s in stages[:4])

    texts = [{r.doc_id: r.text for r in s.collect()} for s in [docs, *stages[:4]]]
    assert set(texts[2]) == representatives(texts[1])
    assert all(set(after) <= set(before) for before, after in zip(texts, texts[1:]))
    assert set(texts[4]) == set(texts[3]) == {r.doc_id for r in rows} and len(rows) == len(texts[4]) > 0

    model = sentencepiece.SentencePieceProcessor(model_file=MODEL_PATH)
    for r in rows:
        assert list(r.piece_ids) == model.encode(texts[4][r.doc_id] or "") and r.n_pieces == len(r.piece_ids)
        assert r.round_trip and not EMAIL.search(model.decode(list(r.piece_ids)))
