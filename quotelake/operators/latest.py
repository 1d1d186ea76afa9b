"""Newest or oldest row per key, by aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    order_is_unique: bool = True,
) -> DataFrame:
    """One row per key: ``columns`` of the row with the greatest ``order``.

    Where ``order`` cannot repeat within a key, one ``max_by`` per column gives
    the same row and keeps fixed-width values in a hash aggregate; otherwise a
    struct keeps the columns of one row together.
    """
    if order_is_unique:
        picked = [F.max_by(c, order).alias(c) for c in columns]
        return df.groupBy(*keys).agg(*picked).select(*keys, *columns)
    rows = df.groupBy(*keys).agg(F.max_by(F.struct(*columns), order).alias("_row"))
    return rows.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in columns))


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: str, n: int
) -> DataFrame:
    """The ``n`` newest rows per key. Spark keeps at most ``n`` rows per key in
    every task before it shuffles, so a hot key stays small."""
    from pyspark.sql import Window

    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    ranked = df.withColumn("_rank", F.row_number().over(newest))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")
