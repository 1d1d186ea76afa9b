"""Summary of price series: returns, volatility and worst drawdown in one pass over the prices.

Rows are grouped by (key, calendar year), which the calendar bounds, so a key with a third of all
rows spreads over as many tasks as it has years. What a year needs from the years before it, the peak
so far and the last close, comes from a small aggregate per (key, year); it joins the year's rows as
one more row at their head, so the prices are exchanged once. Windows over a year give each row its
previous close and running peak; counts, moments and the least fall then combine in one aggregate
per key.

Semantics equal ``daily_returns``/``volatility`` and ``running_drawdown``/``worst_drawdown``: a
return needs a positive previous close and a non-zero close (the previous bar counts even when its
close is null); null closes are skipped by the drawdown; a zero peak gives no fall.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TRADING_DAYS = 252.0


def _measures(value: str, keys: Sequence[str], order: str) -> tuple[Column, Column]:
    """Daily return and (fall, date) of each row of a year, its head row included."""
    rows = Window.partitionBy(*keys, "_year").orderBy(F.desc("_is_head"), order, value)
    price, previous = F.col(value), F.lag(value).over(rows)
    usable = ~F.col("_is_head") & (previous > 0) & price.isNotNull() & (price != 0)
    change = F.when(usable, (price - previous) / F.nullif(previous, F.lit(0.0)))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    peak = F.max(F.greatest(price, F.col(f"_peak_{value}"))).over(so_far)
    fall = F.when(~F.col("_is_head"), (price - peak) / F.nullif(peak, F.lit(0.0)))
    return change, F.when(fall < 0, F.struct(fall.alias("f"), F.col(order).alias("d")))


def series_summaries(
    prices: DataFrame, keys: Sequence[str], values: Sequence[str], order: str = "date"
) -> DataFrame:
    """Per key one struct per value column: ``returns``, ``volatility`` (annualised population
    deviation of daily returns), ``max_drawdown`` (0 without a fall), ``drawdown_date``,
    ``drawdown_year``."""
    keys, values = list(keys), list(values)
    rows = prices.select(
        *keys, order, F.year(order).alias("_year"), *(F.col(v).cast("double").alias(v) for v in values)
    )
    by_year = Window.partitionBy(*keys).orderBy("_year")
    earlier = by_year.rowsBetween(Window.unboundedPreceding, -1)
    heads = (
        rows.groupBy(*keys, "_year")
        .agg(
            *(F.max(v).alias(f"_max_{v}") for v in values),
            *(F.max_by(v, order).alias(f"_last_{v}") for v in values),
        )
        .select(
            *keys,
            "_year",
            *(F.lag(f"_last_{v}").over(by_year).alias(v) for v in values),
            *(F.max(f"_max_{v}").over(earlier).alias(f"_peak_{v}") for v in values),
            F.lit(True).alias("_is_head"),
        )
    )
    both = rows.withColumn("_is_head", F.lit(False)).unionByName(heads, allowMissingColumns=True)
    measured = both.filter(F.col("_year").isNotNull())
    for value in values:
        change, fall = _measures(value, keys, order)
        measured = measured.withColumns({f"_return_{value}": change, f"_fall_{value}": fall})
    found = measured.groupBy(*keys).agg(
        *(F.count(f"_return_{v}").alias(f"_n_{v}") for v in values),
        *(F.stddev_pop(f"_return_{v}").alias(f"_dev_{v}") for v in values),
        *(F.min(f"_fall_{v}").alias(f"_worst_{v}") for v in values),
    )

    def summary(value: str) -> Column:
        worst = F.col(f"_worst_{value}")
        return F.struct(
            F.nullif(F.col(f"_n_{value}"), F.lit(0)).alias("returns"),
            (F.col(f"_dev_{value}") * F.sqrt(F.lit(TRADING_DAYS))).alias("volatility"),
            F.coalesce(worst["f"], F.lit(0.0)).alias("max_drawdown"),
            worst["d"].alias("drawdown_date"),
            F.year(worst["d"]).alias("drawdown_year"),
        ).alias(value)

    return found.select(*keys, *(summary(v) for v in values))


def series_summary(prices: DataFrame, keys: Sequence[str], value: str, order: str = "date") -> DataFrame:
    """``series_summaries`` of one value, its columns beside the keys."""
    found = series_summaries(prices, keys, [value], order)
    return found.select(*keys, f"{value}.*")
