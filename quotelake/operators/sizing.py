"""Broadcast only what the plan's own statistics show to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 16 * 1024 * 1024
#: Rates hold one row per currency and day, so the calendar bounds them: some 180
#: currencies over 50 years are about 3 million rows.
RATE_BYTES = 48 * 1024 * 1024
#: Symbols hold one row per fund, far fewer than bars or holdings. Shuffling those for the
#: symbol's sake costs more than sending some hundred thousand descriptions to every executor.
SYMBOL_BYTES = 128 * 1024 * 1024


#: Planned sizes of scans are compressed bytes on disk; rows in memory may take this much more.
EXPANSION = 10


def planned_bytes(df: DataFrame) -> int:
    """Size by the plan's statistics, for a scan its bytes on disk; runs no job."""
    stats = df._jdf.queryExecution().optimizedPlan().stats()
    return int(str(stats.sizeInBytes()))


def is_small(df: DataFrame, max_bytes: int | None = None) -> bool:
    """Whether the planned size, expanded, is within the bound."""
    max_bytes = BROADCAST_BYTES if max_bytes is None else max_bytes
    return planned_bytes(df) * EXPANSION <= max_bytes


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint a broadcast for a side within the bound. A larger side is returned
    as it is and joined by shuffle, where adaptive execution splits hot keys."""
    return F.broadcast(df) if is_small(df, max_bytes) else df


def broadcast_per_row(df: DataFrame, source: DataFrame, max_bytes: int) -> DataFrame:
    """The same for a side of a few rows per row of ``source``, whose own planned size
    says nothing: the plan multiplies sizes at joins and keeps them at aggregates."""
    return F.broadcast(df) if is_small(source, max_bytes) else df
