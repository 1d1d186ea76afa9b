"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Terms of a document are its words, their shapes (letters of either case, digits, marks) and
immediate repetitions, hashed to ``TERMS`` columns. Term weights are log counts times inverse
document frequencies over all documents. A truncated singular value decomposition of the
labelled sample gives the latent space. The labelled vectors are broadcast, each document is
compared with all of them in blocks of matrix products, and its nearest neighbours vote with
their similarity as weight.

The only sample is the labelled one: at most ``SAMPLE`` labelled documents, in hash order of their ids,
so vectors (``SAMPLE`` x ``LATENT`` floats) and driver memory are bounded.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.common import id_remainder, text_of

SAMPLE = 5000
WORD_TERMS = 3072
SHAPE_TERMS = 1023
TERMS = WORD_TERMS + SHAPE_TERMS + 1
LATENT = 64
NEIGHBOURS = 40
SHARPNESS = 8
ACCEPT = 0.7

#: The share of rows (remainder 2 of 4) whose labels are never learned from.
FOLDS, HELD_OUT = 4, 2

#: Documents whose products with the labelled vectors are taken at a time.
ROWS = 256

WORDS_KEPT = 500_000

_SHAPES = ((re.compile(r"[^\W\d_a-zß-ÿ]+"), "A"), (re.compile(r"[^\W\d_A]+"), "a"), (re.compile(r"\d+"), "0"),
           (re.compile(r"([^\w\s])\1+"), r"\1\1"))


def shape(word: str) -> str:
    for pattern, mark in _SHAPES:
        word = pattern.sub(mark, word)
    return word[:12]


class TermCounter:
    """Counts of hashed terms of whole texts."""

    def __init__(self):
        self.known: dict[str, tuple[int, int]] = {}

    def _terms(self, word: str) -> tuple[int, int]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        bare = word.lower().strip(".,;:!?")
        own = zlib.crc32(bare.encode("utf-8")) % WORD_TERMS
        form = WORD_TERMS + zlib.crc32(shape(word).encode("utf-8")) % SHAPE_TERMS
        self.known[word] = own, form
        return own, form

    def counts(self, text: str) -> np.ndarray:
        words = text.split()
        if not words:
            return np.zeros(TERMS, dtype=np.float32)
        known = self.known
        pairs = np.array([known.get(w) or self._terms(w) for w in words], dtype=np.int64)
        found = np.bincount(pairs.ravel(), minlength=TERMS).astype(np.float32)
        found[-1] = np.count_nonzero((pairs[1:] == pairs[:-1]).all(axis=1))
        return found


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and all documents. Per task one row a term, summed by Spark."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, n, total = TermCounter(), np.zeros(TERMS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                n += counter.counts(text) > 0
                total += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(TERMS + 1, dtype=np.int32)), pa.array(np.append(n, total))], names=["term", "n"]
        )

    rows = (
        docs.select(text_of().alias("text")).mapInArrow(counted, "term int, n long")
        .groupBy("term").agg(F.sum("n").alias("n")).collect()
    )
    found = np.zeros(TERMS + 1, dtype=np.int64)
    for row in rows:
        found[row.term] = row.n
    return found[:-1], int(found[-1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Term counts and labels of at most ``size`` labelled documents outside the held-out rows."""
    usable = labels.filter((id_remainder(FOLDS) != HELD_OUT) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    chosen = (
        usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).cast("double").alias("__label"))
        .orderBy(F.xxhash64("__id"), "__id").limit(size)
    )

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TermCounter()
        for batch in batches:
            counts = [counter.counts(t) for t in batch.column(1).to_pylist()]
            terms = [np.flatnonzero(c).astype("<u2") for c in counts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([t.tobytes() for t in terms], pa.binary()),
                    pa.array([c[t].astype("<f4").tobytes() for c, t in zip(counts, terms, strict=True)], pa.binary()),
                ],
                names=["label", "terms", "counts"],
            )

    # at most `size` rows of two numbers
    picked = docs.join(F.broadcast(chosen), docs.doc_id == chosen["__id"])
    rows = (
        picked.select("__label", text_of().alias("text"))
        .mapInArrow(counted, "label double, terms binary, counts binary").collect()
    )
    # an id may be repeated in the documents; then rows are many times as many as ids
    rows = sorted(rows, key=lambda r: (bytes(r.terms), bytes(r.counts), r.label))[: 2 * size]
    counts = np.zeros((len(rows), TERMS), dtype=np.float32)
    for at, row in enumerate(rows):
        counts[at, np.frombuffer(row.terms, "<u2")] = np.frombuffer(row.counts, "<f4")
    return counts, np.array([r.label for r in rows], dtype=np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


@dataclass(frozen=True)
class Neighbours:
    """Term weights, latent axes, and the labelled vectors with their labels."""

    weights: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(counts) * self.weights) @ self.axes)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; the overall share where nothing is similar."""
        if not len(self.labels):
            return np.full(len(counts), 0.5)
        base = float(self.labels.mean())
        near = self.latent(counts) @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        at = np.argpartition(-near, k - 1, axis=1)[:, :k]
        similar = np.maximum(np.take_along_axis(near, at, axis=1), 0).astype(np.float64) ** SHARPNESS
        votes = similar.sum(axis=1)
        found = (similar * self.labels[at]).sum(axis=1)
        return np.where(votes > 1e-9, found / np.maximum(votes, 1e-9), base)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Neighbours:
    held, total = document_frequencies(docs)
    weights = np.log((1 + total) / (1 + held)).astype(np.float32) + 1
    counts, known = labelled_sample(docs, labels, label, sample)
    if not len(known):
        return Neighbours(weights, np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), known)
    rows = _unit(np.log1p(counts) * weights)
    # randomised range finder: two power steps, then the small decomposition
    rng = np.random.default_rng(4)
    span = rows.T @ (rows @ rng.standard_normal((TERMS, LATENT + 16)).astype(np.float32))
    for _ in range(2):
        span = rows.T @ (rows @ np.linalg.qr(span)[0])
    base = np.linalg.qr(span)[0]
    _, _, right = np.linalg.svd(rows @ base, full_matrices=False)
    axes = (base @ right[:LATENT].T).astype(np.float32)
    return Neighbours(weights, axes, _unit(rows @ axes).astype(np.float32), known)


def scored(docs: DataFrame, model: Neighbours, column: str = "__score") -> DataFrame:
    """``docs`` (every column) with the score of its text."""
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.weights, model.axes, model.vectors, model.labels)
    )
    kept = docs.columns
    schema = T.StructType([*docs.schema.fields, T.StructField(column, T.DoubleType())])

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, model = TermCounter(), Neighbours(*shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            for at in range(0, len(batch), ROWS):
                counts = np.stack([counter.counts(t or "") for t in texts.slice(at, ROWS).to_pylist()])
                part = batch.slice(at, ROWS)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(model.scores(counts).astype(np.float64))], names=[*kept, column]
                )

    return docs.mapInArrow(rows, schema)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. A null or empty text, which resembles nothing, gets
    the labels' mean; without any labels all scores are 0.5."""
    found = scored(docs.select("doc_id", text_of().alias("text")), fit(docs, labels), "score")
    return found.select(
        "doc_id",
        (id_remainder(FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents whose score reaches ``ACCEPT``, with all their columns; all of them where nothing is labelled."""
    model = fit(docs, labels)
    if not len(model.labels):
        return docs
    column = "__score"
    while column in docs.columns:
        column = "_" + column
    return scored(docs, model, column).filter(F.col(column) >= ACCEPT).select(*(F.col(f"`{c}`") for c in docs.columns))
