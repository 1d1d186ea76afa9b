"""Surrogate ids: ascending, gap-free, the same on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_DIGITS = 3  # 16**3 buckets; their counts fit one small task at any size


def key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *(F.col(k).cast("string") for k in keys))


def number_rows(
    df: DataFrame, keys: Sequence[str], start: Column, name: str = "id"
) -> DataFrame:
    """Number rows ``start``, ``start + 1`` … in order of (key hash, keys).

    ``keys`` must be unique. Their hash spreads rows evenly over a fixed number
    of buckets; a running sum over the bucket counts gives each bucket its
    offset, so no task ever sees more than one bucket's rows.
    """
    bucket = F.substring(F.md5(key_text(keys)), 1, HASH_DIGITS)
    spread = df.withColumn("_bucket", bucket)
    ordered = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(
            "_bucket",
            F.coalesce(F.sum("_rows").over(ordered), F.lit(0)).alias("_offset"),
        )
    )
    within = Window.partitionBy("_bucket").orderBy(*keys)
    # at most 16**HASH_DIGITS rows, whatever the input
    numbered = spread.join(F.broadcast(offsets), "_bucket")
    number = start + F.col("_offset") + F.row_number().over(within) - 1
    return numbered.withColumn(name, number.cast("long")).drop("_bucket", "_offset")


def next_id(table: DataFrame, name: str = "id") -> Column:
    """One past the greatest id in use, as a scalar subquery."""
    return table.agg(F.coalesce(F.max(name), F.lit(0)) + 1).scalar()
