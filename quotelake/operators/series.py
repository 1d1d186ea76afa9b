"""Ordered operations on long series.

One series may hold a large share of all rows, so no window here spans a whole
series. Rows are grouped by (key, calendar year) and each year receives what it
needs from the years before it:

* ``look_back``       copies of the few preceding rows,
* ``carry_max``       the running maximum so far,
* ``with_position``   the number of rows so far.

What is carried is one short record per (key, year), computed by an aggregate
that combines before its shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = "_chunk"
IS_COPY = "_is_copy"


def chunked(df: DataFrame, order: str = "date") -> DataFrame:
    return df.withColumn(CHUNK, F.year(order))


def chunk_window(keys: Sequence[str], order: str = "date"):
    return Window.partitionBy(*keys, CHUNK).orderBy(order)


def _earlier_chunks(keys: Sequence[str]):
    """Frame over the one-row-per-year summaries that precede a year."""
    return Window.partitionBy(*keys).orderBy(CHUNK)


def newest_in_chunk(
    df: DataFrame, keys: Sequence[str], rows: int, order: str = "date"
) -> DataFrame:
    """The newest ``rows`` rows of every key and chunk; each task keeps no more
    than that before the shuffle."""
    newest = Window.partitionBy(*keys, CHUNK).orderBy(F.col(order).desc())
    ranked = df.withColumn("_n", F.row_number().over(newest))
    return ranked.filter(F.col("_n") <= rows).drop("_n")


def _tails(
    df: DataFrame, keys: Sequence[str], rows: int, fields: Sequence[str]
) -> DataFrame:
    """The newest ``rows`` rows of every key and chunk as one sorted array. A
    single row needs no sort: a hash aggregate finds it."""
    order, *values = fields
    if rows == 1:
        newest = df.groupBy(*keys, CHUNK).agg(
            F.max(order).alias(order), *(F.max_by(v, order).alias(v) for v in values)
        )
        return newest.select(*keys, CHUNK, F.array(F.struct(*fields)).alias("_tail"))
    return (
        newest_in_chunk(df, keys, rows, order)
        .groupBy(*keys, CHUNK)
        .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("_tail"))
    )


def look_back(
    df: DataFrame,
    keys: Sequence[str],
    rows: int,
    values: Sequence[str],
    order: str = "date",
) -> DataFrame:
    """``df`` with CHUNK, plus copies of the ``rows`` rows before each chunk.

    Copies carry keys, order and ``values`` (other columns null) and are marked
    by IS_COPY; apply a window over ``chunk_window`` and drop them afterwards.
    """
    base = chunked(df, order)
    fields = [order, *values]
    tails = _tails(base.select(*keys, CHUNK, *fields), keys, rows, fields)
    before = _earlier_chunks(keys).rowsBetween(-rows, -1)
    carried = F.flatten(F.collect_list("_tail").over(before))
    short = F.slice(carried, -F.least(F.size(carried), F.lit(rows)), rows)
    copies = (
        tails.withColumn("_before", F.when(F.size(carried) > 0, short))
        .select(*keys, CHUNK, F.explode("_before").alias("_row"))
        .select(
            *keys,
            CHUNK,
            *(F.col(f"_row.{c}").alias(c) for c in fields),
            F.lit(True).alias(IS_COPY),
        )
    )
    marked = base.withColumn(IS_COPY, F.lit(False))
    return marked.unionByName(copies, allowMissingColumns=True)


def originals(df: DataFrame) -> DataFrame:
    """Drop the copies and helper columns again."""
    return df.filter(~F.col(IS_COPY)).drop(IS_COPY, CHUNK)


def moving_average(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    rows: int,
    name: str,
    order: str = "date",
) -> DataFrame:
    """Mean of the current and ``rows - 1`` preceding rows, partial at the start."""
    frame = chunk_window(keys, order).rowsBetween(1 - rows, 0)
    wide = look_back(df, keys, rows - 1, [value], order)
    return originals(wide.withColumn(name, F.avg(value).over(frame)))


def with_previous(
    df: DataFrame, keys: Sequence[str], value: str, name: str, order: str = "date"
) -> DataFrame:
    """Value of the preceding row of the same series."""
    wide = look_back(df, keys, 1, [value], order)
    lagged = F.lag(value).over(chunk_window(keys, order))
    return originals(wide.withColumn(name, lagged))


def carry_max(
    df: DataFrame, keys: Sequence[str], value: str, name: str, order: str = "date"
) -> DataFrame:
    """Running maximum from the start of the series."""
    base = chunked(df, order)
    earlier = _earlier_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    peaks = (
        base.groupBy(*keys, CHUNK)
        .agg(F.max(value).alias("_peak"))
        .withColumn("_before", F.max("_peak").over(earlier))
        .drop("_peak")
    )
    within = chunk_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    joined = base.join(peaks, [*keys, CHUNK])
    running = F.greatest(F.max(value).over(within), F.col("_before"))
    return joined.withColumn(name, running).drop("_before", CHUNK)


def position_slice(
    df: DataFrame,
    keys: Sequence[str],
    first: Column,
    last: Column,
    order: str = "date",
) -> DataFrame:
    """Rows whose 0-based position lies in [first, last] as column ``position``.

    ``first`` and ``last`` may use ``_total``, the row count of the series.
    Years outside the slice are dropped before any row is ranked.
    """
    base = chunked(df, order)
    whole = Window.partitionBy(*keys)
    earlier = _earlier_chunks(keys).rowsBetween(Window.unboundedPreceding, -1)
    spans = (
        base.groupBy(*keys, CHUNK)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .withColumn("_total", F.sum("_rows").over(whole))
        .withColumn("_first", first)
        .withColumn("_last", last)
        .filter(
            (F.col("_offset") <= F.col("_last"))
            & (F.col("_offset") + F.col("_rows") > F.col("_first"))
        )
        .drop("_rows", "_total")
    )
    rank = F.row_number().over(chunk_window(keys, order)) - 1 + F.col("_offset")
    return (
        base.join(spans, [*keys, CHUNK])
        .withColumn("position", rank)
        .filter(F.col("position").between(F.col("_first"), F.col("_last")))
        .drop(CHUNK, "_offset", "_first", "_last")
    )
