"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents are the positives; everything else is unlabelled, negatives are never taken
as such. With class prior p the risk of a classifier g is estimated as

    p * risk of g on positives as toxic
      + max(0, risk of g on unlabelled as clean - p * risk of g on positives as clean),

and where the second part falls below zero, a step is taken against it. The classifiers are
logistic models over hashed words and word beginnings, fitted in numpy on bounded samples
(``POSITIVES``, ``UNLABELLED`` documents in hash order of ids). Only columns take part that positives hold
clearly more often than the unlabelled do. The prior is the share of toxic rows among all
labelled rows outside the held-out ones.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import id_remainder, text_of

POSITIVES = 3000
UNLABELLED = 9000
COLUMNS = 1 << 24
BEGINNINGS = (4, 5)

#: A column takes part if at least so many positives hold it, by so many standard deviations more than expected.
LEAST_ROWS = 3
DEVIATIONS = 5.0

ACCEPT = 0.3
FOLDS, HELD_OUT = 4, 2
MEMBERS = 3
EPOCHS = 40
BATCHES = 8
RATE = 0.05
SHRINK = 1e-4
WORDS_KEPT = 500_000


class Features:
    """Distinct hashed words and word beginnings of a text; with ``places`` only the columns in
    it, as their places."""

    def __init__(self, places: dict[int, int] | None = None):
        self.known: dict[str, tuple[int, ...]] = {}
        self.places = places

    def _columns(self, word: str) -> tuple[int, ...]:
        if len(self.known) > WORDS_KEPT:
            self.known.clear()
        bare = word.strip(".,;:!?\"'()|*#$%&")
        parts = [f"={bare}", *(bare[:n] for n in BEGINNINGS if len(bare) >= n)]
        found = tuple(zlib.crc32(p.encode("utf-8")) % COLUMNS for p in parts)
        if self.places is not None:
            found = tuple(self.places[c] for c in found if c in self.places)
        self.known[word] = found
        return found

    def of(self, text: str) -> np.ndarray:
        known = self.known
        columns: set[int] = set()
        for word in set(text.lower().split()):
            found = known.get(word)
            columns.update(self._columns(word) if found is None else found)
        return np.fromiter(columns, np.int64, len(columns))


@dataclass
class Rows:
    """Sparse rows of ones: the columns of all rows in turn, and where each row starts."""

    columns: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, found: list[np.ndarray]) -> Rows:
        lengths = [len(f) for f in found]
        return cls(np.concatenate([*found, np.zeros(0, np.int64)]), np.cumsum([0, *lengths]))

    def __len__(self) -> int:
        return len(self.starts) - 1

    def take(self, rows: np.ndarray) -> Rows:
        return Rows.of([self.columns[self.starts[r] : self.starts[r + 1]] for r in rows])

    def dot(self, weights: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(weights[self.columns])))
        return total[self.starts[1:]] - total[self.starts[:-1]]

    def back(self, slope: np.ndarray, width: int) -> np.ndarray:
        return np.bincount(self.columns, np.repeat(slope, np.diff(self.starts)), width)

    def within(self, columns: np.ndarray) -> Rows:
        """The rows over the sorted ``columns`` alone, as places in it."""
        at = np.minimum(np.searchsorted(columns, self.columns), max(0, len(columns) - 1))
        own = columns[at] == self.columns if len(columns) else np.zeros(len(at), bool)
        kept = np.concatenate(([0], np.cumsum(own)))
        return Rows(at[own], kept[self.starts])


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def telling_columns(positive: Rows, unlabelled: Rows) -> np.ndarray:
    """Columns that positives hold clearly more often than the unlabelled, sorted."""
    columns, counts = np.unique(positive.columns, return_counts=True)
    columns, counts = columns[counts >= LEAST_ROWS], counts[counts >= LEAST_ROWS]
    there, of_all = np.unique(unlabelled.columns, return_counts=True)
    others = np.zeros(len(columns))
    common, own, at = np.intersect1d(columns, there, return_indices=True)
    others[own] = of_all[at]
    expected = (others + 1) / (len(unlabelled) + 2) * len(positive)
    return columns[counts > expected + DEVIATIONS * np.sqrt(expected)]


def fit_member(positive: Rows, unlabelled: Rows, width: int, prior: float, seed: int) -> np.ndarray:
    """Weights and, last, the intercept of one logistic model, by Adam on mini-batches."""
    rng = np.random.default_rng(seed)
    theta = np.zeros(width + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    step = 0
    for _ in range(EPOCHS):
        parts = zip(
            np.array_split(rng.permutation(len(positive)), BATCHES),
            np.array_split(rng.permutation(len(unlabelled)), BATCHES),
            strict=True,
        )
        for own_p, own_u in parts:
            if not len(own_p) or not len(own_u):
                continue
            p, u = positive.take(own_p), unlabelled.take(own_u)
            zp, zu = p.dot(theta[:-1]) + theta[-1], u.dot(theta[:-1]) + theta[-1]
            # log losses: log(1 + exp(-z)) as toxic, log(1 + exp(z)) as clean
            clean = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            slope_u = _sigmoid(zu) / len(u)
            slope_clean = -prior * _sigmoid(zp) / len(p)
            slope_toxic = -prior * _sigmoid(-zp) / len(p)
            if clean >= 0:
                on_p, on_u = slope_toxic + slope_clean, slope_u
            else:
                on_p, on_u = -slope_clean, -slope_u
            slope = np.append(p.back(on_p, width) + u.back(on_u, width), on_p.sum() + on_u.sum())
            slope[:-1] += SHRINK * theta[:-1]
            step += 1
            first = 0.9 * first + 0.1 * slope
            second = 0.99 * second + 0.01 * slope**2
            theta -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
    return theta


def _features_of(docs: DataFrame, chosen: DataFrame) -> Rows:
    """Features of the documents whose ids are chosen (a bounded number of rows)."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            found = [np.sort(features.of(t)).astype("<u4").tobytes() for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["columns"])

    picked = docs.join(F.broadcast(chosen), docs.doc_id == chosen["__id"])
    found = picked.select(text_of().alias("text")).mapInArrow(rows, "columns binary").collect()
    return Rows.of([np.frombuffer(b, "<u4").astype(np.int64) for b in sorted(bytes(r.columns) for r in found)])


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> tuple[np.ndarray, np.ndarray] | None:
    """Columns, and weights of the ensemble, one row a member; None without toxic labels."""
    usable = labels.filter((id_remainder(FOLDS) != HELD_OUT) & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = usable.groupBy(F.col("doc_id").alias("__id")).agg(F.max(label).alias("__label"))
    share = known.agg(F.avg("__label")).first()[0]
    if not share:
        return None
    prior = min(max(share, 0.001), 0.5)
    order = [F.xxhash64("__id"), F.col("__id")]
    toxic = known.filter(F.col("__label") == 1).select("__id").orderBy(*order).limit(POSITIVES)
    others = (
        docs.filter((id_remainder(FOLDS) != HELD_OUT) & F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("__id")).distinct().orderBy(*order).limit(UNLABELLED)
    )
    positive, unlabelled = _features_of(docs, toxic), _features_of(docs, others)
    if not len(positive) or not len(unlabelled):
        return None
    columns = telling_columns(positive, unlabelled)
    p, u = positive.within(columns), unlabelled.within(columns)
    return columns, np.stack([fit_member(p, u, len(columns), prior, seed) for seed in range(MEMBERS)])


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document. A null text is empty and scores by the intercept
    alone. Without any toxic label all scores are 0."""
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns, members = shared.value or (np.zeros(0, np.int64), None)
        features = Features({int(c): at for at, c in enumerate(columns)})
        for batch in batches:
            if members is None:
                score = np.zeros(len(batch))
            else:
                found = Rows.of([features.of(t) for t in batch.column(1).to_pylist()])
                score = np.mean([_sigmoid(found.dot(m[:-1]) + m[-1]) for m in members], axis=0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return (
        docs.select(ids, text_of().alias("text")).mapInArrow(rows, "doc_id long, score double")
        .select(
            "doc_id",
            (id_remainder(FOLDS) == HELD_OUT).alias("held_out"),
            "score",
            (F.col("score") >= ACCEPT).cast("int").alias("predicted"),
        )
    )
