"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put in hash order and cut into blocks. With weight w the k-th
block of a source (from 0) is released at slot floor(k / w) and due by slot
ceil((k + 1) / w). Serving the released block with the earliest deadline in every slot keeps
each source within less than one block of w * t after every slot t.

Weights are whole shares of ``MOST`` at most. Weights as short decimals are exact; others are rounded to one
part in ``MOST``, which moves a source by less than a thousandth of a block in a million slots. The driver lays
out the slots of all blocks, one number each, and hands them on in cells. When a source runs
out, a new phase begins over the others. Every document is kept.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.llm.common import numbered

#: Documents in a block.
BLOCK = 32

#: Shares of all weights together, at most: products with a number of blocks stay whole numbers of 64 bits.
MOST = 1 << 31

#: Blocks in a cell of the plan.
CELL = 1024

#: Without given weights a source weighs its number of documents to this power.
TEMPER = 0.5

#: Documents in a stored chunk of the mixed order.
CHUNK = 4_000

PHASES = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("phase", T.IntegerType()),
    T.StructField("share", T.LongType()), T.StructField("shares", T.LongType()),
    T.StructField("phase_block", T.LongType()), T.StructField("cell", T.LongType()),
    T.StructField("first_block", T.LongType()), T.StructField("blocks", T.LongType()),
    T.StructField("first_slot", T.LongType()), T.StructField("slots", T.ArrayType(T.LongType())),
])


def shares_of(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """Whole shares in proportion to the weights: exact where they fit into ``MOST``, else at least one each."""
    exact = {s: Fraction(repr(float(w))) for s, w in weights.items()}
    if any(w <= 0 for w in exact.values()):
        raise ValueError("weights are above zero")
    scale = math.lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * scale) for s, w in exact.items()}
    common = math.gcd(*whole.values())
    total = sum(whole.values())
    if total // common <= MOST:
        return {s: n // common for s, n in whole.items()}
    return {s: max(1, round(Fraction(n * (MOST - len(whole)), total))) for s, n in whole.items()}


def one_period(shares: Mapping[str | None, int], slots: int | None = None) -> list[str | None]:
    """Source served in each slot of a period, or of its first ``slots``: earliest deadline among released blocks."""
    total = sum(shares.values())
    names = sorted(shares, key=lambda s: (s is None, s or ""))
    waiting = [(0, n) for n in range(len(names))]  # by release
    ready: list[tuple[int, int]] = []  # by deadline
    served = [0] * len(names)
    order: list[str | None] = []
    heapq.heapify(waiting)
    for slot in range(total if slots is None else min(total, slots)):
        while waiting and waiting[0][0] <= slot:
            _, n = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(served[n] + 1) * total // shares[names[n]]), n))
        _, n = heapq.heappop(ready)
        order.append(names[n])
        served[n] += 1
        if served[n] < shares[names[n]]:
            heapq.heappush(waiting, (served[n] * total // shares[names[n]], n))
    return order


def plan_phases(blocks: Mapping[str | None, int], shares: Mapping[str | None, int]) -> list[tuple]:
    """Rows of ``PHASES``: which blocks of each source a phase serves, in cells, and in which slots.

    A phase lasts as long as no source can run out of blocks within it.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows: list[tuple] = []
    slot = phase = 0
    while left:
        common = math.gcd(*(shares[s] for s in left))
        own = {s: shares[s] // common for s in left}
        total = sum(own.values())
        length = min(left[s] * total // own[s] for s in left)
        places: dict[str | None, list[int]] = {s: [] for s in left}
        for at, source in enumerate(one_period(own, length)):
            places[source].append(at)
        rounds, rest = divmod(length, total)
        for source in list(left):
            n = rounds * own[source] + sum(at < rest for at in places[source])
            begin, end = done[source], done[source] + n
            while begin < end:
                cell = begin // CELL
                upto = min(end, (cell + 1) * CELL)
                turns = (divmod(k - done[source], own[source]) for k in range(begin, upto))
                slots = [slot + turn * total + places[source][k] for turn, k in turns]
                rows.append((source, phase, own[source], total, done[source], cell, begin, upto - begin, slot, slots))
                begin = upto
            done[source] += n
            left[source] -= n
            if not left[source]:
                del left[source]
        slot += length
        phase += 1
    return rows


def target_weights(counts: Mapping[str | None, int], temper: float = TEMPER) -> dict[str | None, float]:
    return {s: n**temper for s, n in counts.items()}


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, float] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """All rows of ``docs`` in a column ``__doc``, with their place in the mixture:
    ``__block`` and ``__at`` (place in the block), ``__slot``, ``__release``, ``__deadline``
    (slots), ``__phase``, ``__weight`` (the target of the phase), ``__deviation`` (blocks served up to and with this
    one in its phase, less the target).

    Sources absent from ``weights`` get the smallest given weight; a null source is a source of its own. The
    driver holds one number per source and block. Equal or null ids are placed like others; an empty
    table gives an empty result.
    """
    spark = docs.sparkSession
    counts = {r[0]: r[1] for r in docs.groupBy("source").count().collect()}
    given = dict(weights) if weights else target_weights(counts)
    least = min(given.values(), default=1.0)
    shares = shares_of({s: given.get(s, least) for s in counts}) if counts else {}
    phases = plan_phases({s: -(-n // block) for s, n in counts.items()}, shares)
    of_phase: dict[int, dict[str | None, float]] = {}
    for source, phase, *_ in phases:
        of_phase.setdefault(phase, {})[source] = given.get(source, least)
    totals = {phase: math.fsum(own.values()) for phase, own in of_phase.items()}
    rows = [(*row, of_phase[row[1]][row[0]] / totals[row[1]]) for row in phases]
    kinds = T.StructType([*PHASES.fields, T.StructField("target", T.DoubleType())])
    plan = spark.createDataFrame(rows, kinds).withColumnsRenamed({"source": "__of"})
    packed = docs.select(
        F.struct(*docs.columns).alias("__doc"), F.col("source").alias("__source"), F.col("doc_id").alias("__id")
    )
    # a source holds many rows, so each is numbered in many cells
    ranked = numbered(packed, "__source", F.struct("__id", "__source"), "__rank").withColumns(
        {"__block": F.floor(F.col("__rank") / block), "__at": (F.col("__rank") % block).cast("int")}
    )
    # one row per source, phase and cell, from the driver's own plan
    served = ranked.withColumn("__cell", F.floor(F.col("__block") / CELL)).join(
        F.broadcast(plan),
        F.col("__source").eqNullSafe(F.col("__of"))
        & (F.col("__cell") == F.col("cell"))
        & (F.col("__block") >= F.col("first_block"))
        & (F.col("__block") < F.col("first_block") + F.col("blocks")),
    )
    k = F.col("__block") - F.col("phase_block")
    slot = F.element_at("slots", (F.col("__block") - F.col("first_block") + 1).cast("int"))
    return served.select(
        "__doc",
        "__source",
        "__id",
        F.col("__block").cast("long"),
        "__at",
        slot.alias("__slot"),
        (F.col("first_slot") + F.expr("(__block - phase_block) * shares div share")).alias("__release"),
        (F.col("first_slot") + F.expr("((__block - phase_block + 1) * shares + share - 1) div share")).alias(
            "__deadline"
        ),
        F.col("phase").alias("__phase"),
        F.col("target").alias("__weight"),
        (k + 1 - F.col("target") * (slot + 1 - F.col("first_slot"))).alias("__deviation"),
    )


def mixed(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """All documents in the order of the mixture: partitions (and so the files written from them) in order of slot,
    and rows by slot and place within them."""
    placed = mix_sources(docs, weights)
    # a chunk of consecutive slots is a partition of its own; at most one block per source is not full
    blocks = docs.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("n")).agg(F.sum("n")).first()[0] or 0
    chunk = F.floor(F.col("__slot") * BLOCK / CHUNK).cast("int")
    return (
        placed.repartitionById(max(1, -(-blocks * BLOCK // CHUNK)), chunk)
        .sortWithinPartitions("__slot", "__at")
        .select("__doc.*")
    )


def report(docs: DataFrame, weights: Mapping[str | None, float] | None = None) -> DataFrame:
    """doc_id, source, block, place, slot, release, deadline, phase, weight (the target), deviation of every document."""
    placed = mix_sources(docs.select("doc_id", "source"), weights)
    return placed.select(
        F.col("__id").alias("doc_id"), F.col("__source").alias("source"), F.col("__block").alias("block"),
        F.col("__at").alias("place"), F.col("__slot").alias("slot"), F.col("__release").alias("release_slot"),
        F.col("__deadline").alias("deadline_slot"), F.col("__phase").alias("phase"), F.col("__weight").alias("weight"),
        F.col("__deviation").alias("deviation"),
    )
