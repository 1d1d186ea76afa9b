"""The language model's step as one graph, and the base score without a row for each word."""

from __future__ import annotations

import collections
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from quotelake.llm import attention, lm_scoring  # noqa: E402
from quotelake.llm.common import LOWER  # noqa: E402
from quotelake.llm.subwords import ByteWords, tokenizer_path  # noqa: E402


def _model():
    rng = np.random.default_rng(4)
    coarse_of = np.append(0, rng.integers(1, sum(attention.COARSE) + 1, sum(attention.FINE))).astype(np.uint8)
    w = attention.Weights.start((len(coarse_of), sum(attention.COARSE) + 1))
    w.after[:] = rng.standard_normal(w.after.shape)
    w.distance[:] = rng.standard_normal(w.distance.shape)
    return w, coarse_of, [rng.integers(1, 500, n).astype(np.uint16) for n in (0, 1, 15, 16, 17, 700)]


def test_graphs_equal_numpy(monkeypatch):
    """With and without onnxruntime: the same slopes, losses and scores."""
    pytest.importorskip("onnxruntime")
    w, coarse_of, texts = _model()
    batch = next(attention._steps(texts, coarse_of, 1, 0))
    lengths = np.array([len(t) for t in texts])

    def results():
        return attention._slopes(w, *batch, coarse_of), attention.text_scores(w, np.concatenate(texts), lengths, coarse_of)

    assert attention._STEP.ready() and attention._SCORES.ready()
    (slopes, loss), scores = results()
    for graph in (attention._STEP, attention._SCORES):
        monkeypatch.setattr(graph, "session", False)
    (plain, plain_loss), plain_scores = results()
    for part, other in zip(slopes, plain, strict=True):
        assert np.abs(part - other).max() < 1e-5 * max(1e-3, np.abs(other).max())
    assert abs(loss - plain_loss) < 1e-6 and np.allclose(scores, plain_scores, rtol=1e-6)


def test_graphs_travel_without_session():
    import pickle

    graph = pickle.loads(pickle.dumps(attention._STEP))
    assert graph.session is None and graph.ready() == attention._STEP.ready()


def test_words_are_those_of_bytes_split():
    rng = random.Random(1)
    for _ in range(300):
        texts = ["".join(rng.choice("aB é\t\n\x0b\x0c\r\x1c\x85  Z") for _ in range(rng.choice([0, 1, 3, 30]))).encode()
                 for _ in range(rng.choice([0, 1, 5]))]
        words = [t.translate(LOWER).split() for t in texts]
        joined, n = lm_scoring._split(texts)
        assert joined.tobytes() == b"".join(w + b" " for own in words for w in own)
        assert n.tolist() == list(map(len, words))


def test_ids_of_words_with_odd_spaces():
    coder = ByteWords(tokenizer_path(lm_scoring.VOCABULARY))
    for words in ([], ["a", "word", "déjà"], ["a\x1cb", "x"], ["é\x85b", "x"], ["　", " y", "é"]):
        ids, sizes = coder.ids("".join(w + " " for w in words).encode())
        assert len(sizes) == len(words) and sizes.sum() == len(ids)
        assert coder.coder.decode(ids.tolist()) == "".join(" " + w for w in words)


def test_no_row_for_each_word(spark):
    """A block has a row for each document and at most ``CELLS`` for all its words."""
    text = " ".join(f"w{n}" for n in range(3 * lm_scoring.CELLS))
    docs = spark.createDataFrame([(1, False, text), (2, False, text)], "doc_id long, held_out boolean, text string").coalesce(1)
    rows = lm_scoring.document_blocks(docs, tokenizer_path(lm_scoring.VOCABULARY)).count()
    assert rows <= lm_scoring.CELLS + 2


def test_counts_over_blocks_and_cells(spark, monkeypatch):
    """Small blocks, few cells and batches that part a cell; against counts of all words."""
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 150)
    monkeypatch.setattr(lm_scoring, "CELLS", 5)
    rng = random.Random(3)
    kinds = ["the"] * 30 + [f"w{n}" for n in range(80)]
    rows = [(None if n % 9 == 0 else n % 50, n % 7 == 2, " ".join(rng.choices(kinds, k=rng.choice([0, 1, 9, 70])))) for n in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, held_out boolean, text string").repartition(3)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        blocks = lm_scoring.document_blocks(docs, tokenizer_path(lm_scoring.VOCABULARY)).cache()
        documents = blocks.filter("ids is not null")
        counts = lm_scoring.word_counts(blocks).cache()
        found = lm_scoring.base_sums(documents, counts).join(documents, ["block", "doc"]).collect()
        total = counts.selectExpr("sum(kinds)").first()[0]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    n = collections.Counter(w for _, held, text in rows if not held for w in text.split())
    assert total == len(n) and blocks.filter("ids is not null").select("block").distinct().count() > 20
    expected = [(i or 0, held, len(t.split()) + 1, sum(n[w] > 0 for w in t.split()),
                 round(sum(np.log10(n[w] + 1) for w in t.split()), 6)) for i, held, t in rows]
    assert sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.known, round(r.base, 6)) for r in found) == sorted(expected)
