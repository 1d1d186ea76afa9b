"""Shards of near-equal bytes by a minimax contiguous partition.

Equal texts form one group, and a group is never split. Groups are ordered by the digest of
their text. The smallest feasible shard capacity is found by binary search, a
capacity being checked greedily: fill a shard up to it, then start the next. The
shards are cut where the greedy check with the smallest capacity cuts.

A group at least as large as an even share of what is left takes a shard of
its own, and the rest is partitioned over the other shards.

The driver never holds all groups. It holds sizes of digest intervals, and has only those
intervals split further in which a cut can lie: the cuts of every capacity between the smallest
that is feasible with divisible intervals and the smallest feasible with whole ones.
After a few rounds all intervals around the cuts are single groups and the result is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import numbered, stored, text_of

SHARDS = 8

#: Hex digits added to an interval's digest prefix in a round: 16**3 intervals at first.
FIRST_DIGITS = 3
MORE_DIGITS = 2
DIGEST_DIGITS = 64


def digest_of(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def size_of() -> Column:
    return (F.octet_length(text_of()) + 1).cast("long")


@dataclass(frozen=True)
class Interval:
    """Groups whose digests start with ``prefix``; ``groups`` of them, ``size`` bytes together."""

    prefix: str
    size: int
    groups: int
    largest: int

    @property
    def whole(self) -> bool:
        return self.groups == 1


def _greedy(items: list[Interval], capacity: int, divisible: bool) -> list[int] | None:
    """Index of the item at which each shard ends (exclusive), or None if an item does not fit.

    Divisible: intervals of several groups may be cut anywhere; the index is then that of the cut item.
    """
    ends, free = [], capacity
    for at, item in enumerate(items):
        if item.whole or not divisible:
            if item.size > capacity:
                return None
            if item.size > free:
                ends.append(at)
                free = capacity
            free -= item.size
        else:
            if item.largest > capacity:
                return None
            left = item.size
            while left > free:
                left -= free
                ends.append(at)
                free = capacity
            free -= left
    return [*ends, len(items)]


def _smallest_capacity(items: list[Interval], shards: int, divisible: bool) -> int:
    low, high = 0, sum(i.size for i in items)
    while low < high:
        middle = (low + high) // 2
        ends = _greedy(items, middle, divisible)
        if ends is not None and len(ends) <= shards:
            high = middle
        else:
            low = middle + 1
    return low


def _children(groups: DataFrame, prefixes: list[str], digits: int) -> list[Interval]:
    """Sizes of the next finer intervals below each prefix."""
    lengths = {len(p) for p in prefixes}
    found = []
    for length in sorted(lengths):
        own = [p for p in prefixes if len(p) == length]
        part = groups if own == [""] else groups.filter(F.substring("digest", 1, length).isin(own))
        finer = F.substring("digest", 1, min(length + digits, DIGEST_DIGITS)).alias("prefix")
        found += (
            part.groupBy(finer)
            .agg(
                F.sum("bytes").alias("size"), F.count(F.lit(1)).alias("groups"),
                F.max("bytes").alias("largest"), F.min("digest").alias("only"),
            )
            .collect()
        )
    return [Interval(r.only if r.groups == 1 else r.prefix, r.size, r.groups, r.largest) for r in found]


def cut_digests(groups: DataFrame, shards: int) -> list[str]:
    """First digest of every shard but the first, by the minimax partition of ``groups``
    (digest, bytes). Fewer than ``shards`` - 1 where fewer shards are enough."""
    items = sorted(_children(groups, [""], FIRST_DIGITS), key=lambda i: i.prefix)
    total = sum(i.size for i in items)
    while items:
        # no interval of several groups may be as large as a good part of a shard
        split = {
            at
            for at, item in enumerate(items)
            if not item.whole and item.size * 16 * shards > total
        }
        if not split:
            split = _undecided(items, shards)
        if not split:
            ends = _greedy(items, _smallest_capacity(items, shards, False), False)
            return [items[at].prefix for at in ends[:-1]]
        finer = _children(groups, [items[at].prefix for at in sorted(split)], MORE_DIGITS)
        kept = [item for at, item in enumerate(items) if at not in split]
        items = sorted(kept + finer, key=lambda i: i.prefix)
    return []


def _undecided(items: list[Interval], shards: int) -> set[int]:
    """Intervals of several groups in which a shard may end.

    The smallest capacity lies between the one for divisible and the one for whole
    intervals. With any capacity in that range the n-th shard ends between where whole
    intervals end it under the lower and divisible ones under the higher capacity.
    """
    low = _smallest_capacity(items, shards, True)
    high = max(low, _smallest_capacity(items, shards, False))
    early, late = _greedy(items, low, False), _greedy(items, high, True)
    early += [early[-1]] * (shards - len(early))
    late += [len(items)] * (shards - len(late))
    return {
        at
        for first, last in zip(early[: shards - 1], late[: shards - 1], strict=True)
        for at in range(min(first, last), min(max(first, last) + 1, len(items)))
        if not items[at].whole
    }


@dataclass(frozen=True)
class Layout:
    """Digests that have a shard of their own, and where the others are cut."""

    alone: tuple[str, ...]
    cuts: tuple[str, ...]

    def shard(self, digest: Column) -> Column:
        first = len(self.alone)
        at = F.lit(first)
        for cut in self.cuts:
            at = at + (digest >= cut).cast("int")
        for number, own in enumerate(self.alone):
            at = F.when(digest == own, number).otherwise(at)
        return at.cast("int")


def plan_shards(groups: DataFrame, shards: int = SHARDS) -> Layout:
    """Layout for ``groups`` (digest, bytes), one row per group."""
    total = groups.agg(F.sum("bytes")).first()[0] or 0
    alone: list[str] = []
    for row in groups.orderBy(F.desc("bytes"), "digest").limit(shards).collect():
        if len(alone) == shards - 1 or row.bytes * (shards - len(alone)) < total:
            break
        alone.append(row.digest)
        total -= row.bytes
    rest = groups.filter(~F.col("digest").isin(alone)) if alone else groups
    return Layout(tuple(alone), tuple(cut_digests(rest, shards - len(alone))))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row. Size is the UTF-8 bytes plus one;
    a null text has none and equals the empty one. Slots have no gaps within a shard. Null or
    repeated ids are placed like any other; an empty table gives an empty result."""
    rows = stored(
        docs.select(
            F.col("doc_id"),
            size_of().alias("size"),
            F.crc32(F.encode(text_of(), "utf-8")).alias("text_crc32"),
            digest_of(text_of()).alias("digest"),
        ),
        "shard-rows",
    )
    groups = stored(rows.groupBy("digest").agg(F.sum("size").alias("bytes")), "shard-groups")
    layout = plan_shards(groups, shards)
    placed = rows.withColumn("shard", layout.shard(F.col("digest")))
    return numbered(placed, "shard", F.struct("doc_id", "digest"), "slot").drop("digest")
