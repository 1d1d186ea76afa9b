"""Document fingerprints by a randomised edit embedding.

A walk reads a text from its first character: at step i it puts out the character under it and
then stays or moves on by one, as a random bit of (i, character) says. All texts share these bits, so
two texts that differ by few edits fall into step again after each edit, and their outputs
agree at most steps: edit distance has become Hamming distance. A walk takes about twice as
many steps as the text has characters and always covers the text to its end.

The fingerprint samples the embedding. Each of ``SLOTS`` slots ranks all steps by a random
priority and keeps 8 bits of the outputs that end at its first-ranked step among those the
walk took. Walks of nearly equal length mostly sample the same steps.

Likeness is the share of equal slots. ``near_pairs`` finds alike documents by banding: equal runs
of slots give candidates, likeness verifies them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import stored, text_of

SLOTS = 64
BAND = 4
WINDOW = 8
STEPS = 256
SEED = 5

#: Bytes of text in a range of ids; one task streams over it.
RANGE_BYTES = 24 << 20

#: Characters and documents walked at a time.
WALK_CHARS = 6_000_000
WALK_TEXTS = 6_000

ROW = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
      "near_edited double, near_next double"
EDGE = "first_id long, first_text string, last_id long, last_text string"


def classes(text: str) -> np.ndarray:
    """Characters as numbers 1 to 255; 0 marks the end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    mixed = (points * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
    return np.append((mixed % np.uint64(255)).astype(np.uint8) + np.uint8(1), np.uint8(0))


class Walks:
    """The random bits and priorities that all walks share, by chunks of ``STEPS`` steps."""

    def __init__(self):
        self.bits: list[np.ndarray] = []
        self.first: list[dict[int, np.ndarray]] = []  # step in the chunk -> slots whose first-ranked step it is so far
        self.best = np.full(SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)

    def chunk(self, number: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        while len(self.first) <= number:
            rng = np.random.default_rng((SEED, 1, len(self.first)))
            ranks = rng.integers(0, 1 << 64, (STEPS, SLOTS), dtype=np.uint64, endpoint=False)
            before = np.minimum.accumulate(np.vstack([self.best, ranks]), axis=0)
            new = ranks < before[:-1]
            self.first.append({int(s): np.flatnonzero(new[s]) for s in np.flatnonzero(new.any(axis=1))})
            self.best = before[-1]
        bits = np.random.default_rng((SEED, 2, number)).integers(0, 2, (STEPS, 256), dtype=np.uint8)
        bits[:, 0] = 0  # the end is never left
        return bits, self.first[number]

    def fingerprints(self, texts: list[str]) -> np.ndarray:
        """One row of ``SLOTS`` bytes for each text; zeros for an empty one."""
        order = sorted(range(len(texts)), key=lambda t: -len(texts[t]))
        found = np.zeros((len(texts), SLOTS), dtype=np.uint8)
        at = 0
        while at < len(order):
            chars, part = 0, []
            while at < len(order) and len(part) < WALK_TEXTS and (not part or chars < WALK_CHARS):
                part.append(order[at])
                chars += len(texts[order[at]])
                at += 1
            found[part] = self._walk([classes(texts[t]) for t in part])
        return found

    def _walk(self, rows: list[np.ndarray]) -> np.ndarray:
        flat = np.concatenate(rows)
        place = np.concatenate(([0], np.cumsum([len(r) for r in rows])))[:-1].astype(np.int64)
        owner = np.arange(len(rows))
        found = np.zeros((len(rows), SLOTS), dtype=np.uint8)
        salt = np.random.default_rng((SEED, 3)).integers(1, 1 << 63, SLOTS, dtype=np.uint64) | np.uint64(1)
        before = np.zeros((WINDOW, len(rows)), dtype=np.uint8)
        number = 0
        while len(owner):
            bits, events = self.chunk(number)
            out = np.empty((STEPS + WINDOW, len(owner)), dtype=np.uint8)
            out[:WINDOW] = before
            for step in range(STEPS):
                now = out[step + WINDOW]
                np.take(flat, place, out=now)
                place += bits[step][now]
            for step, slots in events.items():
                alive = np.flatnonzero(out[step + WINDOW])
                if not len(alive):
                    continue
                seen = np.ascontiguousarray(out[step + 1 : step + 1 + WINDOW][:, alive].T).view(np.uint64).ravel()
                for slot in slots:
                    found[owner[alive], slot] = ((seen ^ (seen >> np.uint64(29))) * salt[slot]) >> np.uint64(56)
            going = flat[place] != 0
            before = out[-WINDOW:][:, going]
            place, owner = place[going], owner[going]
            number += 1
        return found


def edited(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by as many first characters of ``following``, or all."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


def _rows(ids: list, texts: list[str], walks: Walks) -> dict[str, list]:
    """Columns of ``ROW`` for all texts but the last, each with the next as its following text."""
    own, changed = texts[:-1], [edited(a, b) for a, b in zip(texts, texts[1:], strict=False)]
    prints = walks.fingerprints(texts + changed)
    first, second = prints[: len(texts)], prints[len(texts) :]
    return {
        "doc_id": ids[: len(own)],
        "n_chars": [len(t) for t in own],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed],
        "fingerprint": [p.tobytes().hex() for p in first[:-1]],
        "edited_fingerprint": [p.tobytes().hex() for p in second],
        "near_edited": (first[:-1] == second).mean(axis=1).tolist(),
        "near_next": (first[:-1] == first[1:]).mean(axis=1).tolist(),
    }


_TYPES = {"doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
          "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64()}
_EDGE_TYPES = {"first_id": pa.int64(), "first_text": pa.string(), "last_id": pa.int64(), "last_text": pa.string()}


def _along(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range of documents, then one row with the range's first and last document."""
    walks = Walks()
    first = last = None
    for batch in batches:
        for at in range(0, len(batch), 2000):
            part = batch.slice(at, 2000)
            ids, texts = part.column(0).to_pylist(), part.column(1).to_pylist()
            if last is None:
                first = ids[0], texts[0]
            else:
                ids, texts = [last[0], *ids], [last[1], *texts]
            last = ids[-1], texts[-1]
            if len(texts) > 1:
                yield _full(_rows(ids, texts, walks))
    if first is not None:
        yield _full(dict(zip(_EDGE_TYPES, ([x] for x in (*first, *last)), strict=True)))


def _full(columns: dict[str, list]) -> pa.RecordBatch:
    """A batch of all columns, nulls where none are given."""
    n = len(next(iter(columns.values())))
    kinds = _TYPES | _EDGE_TYPES
    return pa.RecordBatch.from_arrays(
        [pa.array(columns.get(c, [None] * n), t) for c, t in kinds.items()], names=list(kinds)
    )


def _resolved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last document of each range with the one that follows it."""
    walks = Walks()
    for batch in batches:
        for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            columns = _rows([doc_id], [text, following], walks)
            yield pa.RecordBatch.from_arrays([pa.array(columns[c], t) for c, t in _TYPES.items()], names=list(_TYPES))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Columns of ``ROW`` for every document. The following document is that with the next larger id; null ids
    come first, repeated ids in order of their texts' hash, and the last is followed by the first. A
    null text is empty. An empty table gives an empty result."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    size = plain.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranged = plain.repartitionByRange(max(1, -(-size // RANGE_BYTES)), "doc_id").sortWithinPartitions(
        "doc_id", F.xxhash64("text")
    )
    found = stored(ranged.mapInArrow(_along, f"{ROW}, {EDGE}"), "edit-fingerprints")
    rows = found.filter(F.col("fingerprint").isNotNull()).select(*_TYPES)
    # one row for each range of ids
    edges = found.filter(F.col("first_text").isNotNull()).select(*_EDGE_TYPES)
    order = Window.orderBy(F.asc_nulls_first("first_id"))
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = edges.select(
        "last_id", "last_text",
        F.coalesce(F.lead("first_text").over(order), F.first("first_text").over(around)).alias("following"),
    )
    return rows.unionByName(ends.mapInArrow(_resolved, ROW))


def likeness(left: Column, right: Column) -> Column:
    """Share of equal slots of two fingerprints."""
    same = F.aggregate(
        F.sequence(F.lit(0), F.lit(SLOTS - 1)),
        F.lit(0),
        lambda n, s: n + (F.substr(left, s * 2 + 1, F.lit(2)) == F.substr(right, s * 2 + 1, F.lit(2))).cast("int"),
    )
    return same / SLOTS


def band_groups(least: float, band: int) -> list[tuple[int, ...]]:
    """Sets of bands of which alike fingerprints agree in at least one.

    Each differing slot spoils one band at most, so some number of bands stays whole. Dealt out
    to one heap fewer, two whole bands share a heap: pairs within heaps are enough.
    """
    bands = SLOTS // band
    whole = bands - int((1 - least) * SLOTS + 1e-9)
    if whole < 1:
        raise ValueError(f"bands of {band} slots may all differ at a likeness of {least}")
    if whole == 1:
        return [(b,) for b in range(bands)]
    return [(b, c) for b in range(bands) for c in range(b + whole - 1, bands, whole - 1)]


def near_pairs(found: DataFrame, least: float = 0.8, band: int = BAND) -> DataFrame:
    """doc_id, other_id, likeness of documents at least ``least`` alike; ``found`` has doc_id and fingerprint.

    Equal fingerprints form a class: each of its documents is linked to the smallest, and only these smallest
    ones are paired with other classes, so copies are not expanded into all pairs. Every alike pair of classes is
    found: candidates agree in one of the ``band_groups``, and likeness decides within the join. A null id
    names a class only where it has no other.
    """
    classes = found.groupBy("fingerprint").agg(F.min("doc_id").alias("own_id"))
    part = 2 * band
    keys = F.explode(F.array(*[
        F.struct(F.lit(n).alias("group"), F.concat(*[F.substring("fingerprint", b * part + 1, part) for b in group]).alias("bits"))
        for n, group in enumerate(band_groups(least, band))
    ]))
    keyed = classes.select("own_id", "fingerprint", keys.alias("key"))
    other = keyed.select(F.col("key").alias("other_key"), F.col("own_id").alias("next_id"), F.col("fingerprint").alias("next_print"))
    alike = likeness(F.col("fingerprint"), F.col("next_print"))
    pairs = keyed.join(
        other,
        (F.col("key") == F.col("other_key")) & (F.col("fingerprint") < F.col("next_print")) & (alike >= least),
    ).select(
        F.greatest("own_id", "next_id").alias("doc_id"), F.least("own_id", "next_id").alias("other_id"),
        alike.alias("likeness"),
    ).distinct()
    named = classes.withColumnRenamed("fingerprint", "of")
    copies = found.join(named, F.col("fingerprint") == F.col("of")).filter(F.col("doc_id") != F.col("own_id"))
    return pairs.unionByName(copies.select("doc_id", F.col("own_id").alias("other_id"), F.lit(1.0).alias("likeness")))
