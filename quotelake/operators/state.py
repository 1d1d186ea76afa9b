"""Stored state of every symbol: newest day, last close, peak, row count, greatest id.

The state is kept per (symbol, month) and stored by month, beside the bars. A load recomputes the
rows of the months it touched, from those months of the bar table only, and replaces them; the
state of a symbol is the fold of its month rows, which is associative (minimum, maximum, sum, and
the close of the newest day), so any grouping of months gives the same result. Readers of the
high-water mark, the next id or the newest close read the state instead of the bar table, which
it shrinks by the number of bars a month (about 21).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.sources.storage import MONTH, month_of

#: Columns of a stored state row; ``latest_date`` also gives the row's month.
STATE_COLUMNS = ["symbol_id", "first_date", "latest_date", "last_close", "peak_close", "rows", "max_id"]


def month_state(bars: DataFrame) -> DataFrame:
    """One state row per (symbol, month) of ``bars``; an aggregate that combines before its shuffle."""
    return (
        bars.groupBy("symbol_id", month_of(F.col("date")).alias(MONTH))
        .agg(
            F.min("date").alias("first_date"),
            F.max("date").alias("latest_date"),
            F.max_by("close", "date").alias("last_close"),
            F.max("close").alias("peak_close"),
            F.count(F.lit(1)).alias("rows"),
            F.max("id").alias("max_id"),
        )
        .select(*STATE_COLUMNS)
    )


def fold(states: DataFrame) -> DataFrame:
    """Merge state rows per symbol: the state of the union of their bars."""
    return states.groupBy("symbol_id").agg(
        F.min("first_date").alias("first_date"),
        F.max("latest_date").alias("latest_date"),
        F.max_by("last_close", "latest_date").alias("last_close"),
        F.max("peak_close").alias("peak_close"),
        F.sum("rows").alias("rows"),
        F.max("max_id").alias("max_id"),
    )


def marks(states: DataFrame) -> DataFrame:
    """High-water mark per symbol from the state: (symbol_id, latest_date)."""
    return states.groupBy("symbol_id").agg(F.max("latest_date").alias("latest_date"))


def next_bar_id(states: DataFrame):
    """One past the greatest bar id, from the state (a scalar subquery)."""
    return states.agg(F.coalesce(F.max("max_id"), F.lit(0)) + 1).scalar()


def only_newer_by_state(landed: DataFrame, states: DataFrame, start: str) -> DataFrame:
    """Landed bars past their symbol's mark, or from ``start`` on for a symbol without one."""
    day, mark = F.col("date"), F.col("latest_date")
    newer = F.when(mark.isNull(), day >= F.lit(start).cast("date")).otherwise(day > mark)
    return landed.join(marks(states), "symbol_id", "left").filter(newer).drop("latest_date")
