"""SimHash fingerprints and near-duplicate groups by a Gray-order hierarchical index.

A document's fingerprint has 64 bits, each the majority over its shingles' hashes. Two
fingerprints are linked if they differ in at most 3 bits.

Index: 64 bits fall into 4 blocks of 16, and two linked fingerprints agree in at least
one block. For each block in turn the fingerprints are rotated so that it leads, and sorted by
their rank in Gray order; equal leading bits are then neighbours. The bits that such a run
shares are factored out into an upper node, level by level from 16 to 64 bits. A search
goes down from pairs of equal nodes on the first level and adds up the differing bits of
each level's node patterns; a pair of nodes beyond 3 bits is pruned with all that is below it.

Only distinct fingerprints enter the index. A task hands on a spanning forest of the links it
found, not the links themselves, and groups come from the connected components of all forests.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import LOWER, stored, text_of
from quotelake.llm.components import components

SHINGLE_WORDS = 3
MAX_BITS = 3
SEED = 42

BLOCKS = 4
LEVELS = (16, 22, 28, 34, 40, 46, 52, 58, 64)

#: Rotated fingerprints held by an index task at a time; cuts fall between leading blocks.
INDEX_ROWS = 200_000

#: Pairs of nodes expanded at a time.
PAIRS = 1 << 18


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    """Majority bits over the XXH64 of the text's shingles, as an unsigned number; 0 without words."""
    import xxhash

    parts = text.encode("utf-8").translate(LOWER).split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    n = max(1, len(parts) - words + 1)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    first = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    last = ends[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, 4096):  # long texts in parts
        ones += np.unpackbits(hashes[at : at + 4096].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(
            axis=0, dtype=np.int64
        )
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long. Null text: fingerprint zero."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, text_of().alias("text")).mapInArrow(rows, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit Gray code in Gray order, as a signed long of the same order."""
    rank = code
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, shift))
    return rank.bitwiseXOR(F.lit(-(2**63)))


def rotated(fp: Column, bits: Column) -> Column:
    left = F.call_function("shiftleft", fp, bits)
    return F.when(bits == 0, fp).otherwise(left.bitwiseOR(F.call_function("shiftrightunsigned", fp, 64 - bits)))


def _starts(prefix: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))


def close_pairs(codes: np.ndarray, most: int = MAX_BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j of ``codes`` (distinct, unsigned, in Gray order) with equal leading blocks and at most
    ``most`` differing bits, by descent through the node levels."""
    n = len(codes)
    starts = [_starts(codes >> np.uint64(64 - level)) for level in LEVELS[:-1]] + [np.arange(n)]
    # node a of a level has the children first[a] .. first[a + 1] - 1 on the next
    first = [np.append(np.searchsorted(low, high), len(low)) for high, low in zip(starts, starts[1:], strict=False)]
    patterns = []
    for level, (above, bits) in enumerate(zip(LEVELS, LEVELS[1:], strict=False)):
        new = np.uint64((1 << (bits - above)) - 1)
        patterns.append((codes[starts[level + 1]] >> np.uint64(64 - bits)) & new)
    top = np.arange(len(starts[0]))
    crowded = top[np.diff(np.append(starts[0], n)) > 1]
    work = [(0, crowded[i : i + PAIRS], crowded[i : i + PAIRS], np.zeros(len(crowded[i : i + PAIRS]), np.int8))
            for i in range(0, len(crowded), PAIRS)]
    while work:
        level, a, b, differ = work.pop()
        if level == len(LEVELS) - 1:
            own = a < b
            if own.any():
                yield a[own], b[own]
            continue
        down = first[level]
        wide = down[b + 1] - down[b]
        times = (down[a + 1] - down[a]) * wide
        if len(a) > 1 and times.sum() > 8 * PAIRS:
            half = len(a) // 2
            work += [(level, a[:half], b[:half], differ[:half]), (level, a[half:], b[half:], differ[half:])]
            continue
        pair = np.repeat(np.arange(len(a)), times)
        nth = np.arange(len(pair)) - np.repeat(np.cumsum(times) - times, times)
        x, y = down[a][pair] + nth // wide[pair], down[b][pair] + nth % wide[pair]
        total = differ[pair] + np.bitwise_count(patterns[level][x] ^ patterns[level][y]).astype(np.int8)
        stay = (total <= most) & (x <= y)
        if stay.any():
            work.append((level + 1, x[stay], y[stay], total[stay]))


def forest(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected with."""
    label = np.arange(n)
    for u, v in links:
        while True:
            lu, lv = label[u], label[v]
            apart = lu != lv
            if not apart.any():
                break
            u, v, lu, lv = u[apart], v[apart], lu[apart], lv[apart]
            np.minimum.at(label, np.maximum(lu, lv), np.minimum(lu, lv))
            while True:  # to the roots
                up = label[label]
                if (up == label).all():
                    break
                label = up
    return label


def links(distinct: DataFrame, most: int = MAX_BITS) -> DataFrame:
    """Edges (u, v) that connect the distinct fingerprints ``fp`` as all links would."""
    turned = distinct.select(F.explode(F.array(*[F.lit(16 * b) for b in range(BLOCKS)])).alias("turn"), "fp").select(
        "turn", rotated(F.col("fp"), F.col("turn")).alias("code")
    )
    keyed = turned.withColumn("lead", F.shiftrightunsigned("code", 48)).withColumn("rank", gray_rank(F.col("code")))

    def edges(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: list[np.ndarray] = []
        codes: list[np.ndarray] = []

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            turn, code = np.concatenate(turns), np.concatenate(codes)
            lead = code >> np.uint64(48)
            cut = len(code)
            if not last:  # the last leading block may go on
                cut = np.flatnonzero((turn != turn[-1]) | (lead != lead[-1]))
                cut = int(cut[-1]) + 1 if len(cut) else 0
            for t in np.unique(turn[:cut]):
                own = code[:cut][turn[:cut] == t]
                label = forest(len(own), close_pairs(own, most))
                bound = np.flatnonzero(label != np.arange(len(own)))
                u, v = (np.bitwise_or(c >> np.uint64(t), c << np.uint64(64 - t)) if t else c
                        for c in (own[bound], own[label[bound]]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
                )
            turns[:], codes[:] = [turn[cut:]], [code[cut:]]

        held = 0
        for batch in batches:
            turns.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            codes.append(batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64))
            held += len(batch)
            if held > INDEX_ROWS:
                yield from settle(False)
                held = 0
        if codes:
            yield from settle(True)

    return (
        keyed.repartition("turn", "lead")
        .sortWithinPartitions("turn", "rank")
        .select("turn", "code")
        .mapInArrow(edges, "u long, v long")
    )


def _component_of(fps: DataFrame, most: int) -> DataFrame:
    """(own, component_id): every distinct fingerprint with the smallest doc_id linked to it."""
    distinct = stored(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp"), most))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy(F.col("root").alias("of")).agg(F.min("least").alias("component_id"))
    return rooted.join(least, rooted.root == least.of).select(F.col("fp").alias("own"), "component_id")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """doc_id, fp, component_id (smallest doc_id of the group) of every document. Null ids take part in
    groups but name one only where no other id is there. An empty table gives an empty result."""
    fps = stored(fingerprints(docs, words), "simhash")
    named = _component_of(fps, most)
    return fps.join(named, fps.fp == named.own).select("doc_id", "fp", "component_id")


def _fresh(df: DataFrame, base: str) -> str:
    name = base
    while name in df.columns:
        name = "_" + name
    return name


def one_per_group(docs: DataFrame, words: int = SHINGLE_WORDS, most: int = MAX_BITS) -> DataFrame:
    """One row of each near-duplicate group stays, with all its columns.

    The row kept has the group's smallest id (its component_id); of several such rows (a repeated id
    with other texts of the group, or repeated rows) the one with the least fingerprint, then the first
    in the stored input. Null ids take part in groups; a null-id row stays only in a group without any
    other id. Helper columns take names the input does not use. An empty table gives an empty result.
    """
    row = _fresh(docs, "__row")
    placed = stored(docs.withColumn(row, F.monotonically_increasing_id()), "simhash-rows")

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, words) for t in batch.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))], names=["row", "doc_id", "fp"]
            )

    fps = stored(
        placed.select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
        .mapInArrow(rows, "row long, doc_id long, fp long"),
        "simhash-row-fps",
    )
    named = _component_of(fps.select("doc_id", "fp"), most)
    chosen = (
        fps.join(named, fps.fp == named.own)
        .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
        .groupBy("component_id")
        .agg(F.min(F.struct("fp", "row")).alias("pick"))
        .select(F.col("pick.row").alias(row))
    )
    return placed.join(chosen, row, "left_semi").drop(row)
