"""52-week metrics and entry levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.sources.storage import MONTH, in_dates

WINDOW_DAYS = 365

# Factor of the high per entry level, as binary literals.
LEVEL_FACTORS = {5: 0.95, 10: 0.90, 15: 0.85, 20: 0.80, 25: 0.75, 30: 0.70}


def newest_date(bars: DataFrame) -> Column:
    """Newest date of the table as a scalar subquery. A table stored by month has
    its dates read in the newest month alone."""
    if MONTH in bars.columns:
        bars = bars.filter(F.col(MONTH) == bars.agg(F.max(MONTH)).scalar())
    return bars.agg(F.max("date")).scalar()


def metrics_52week(bars: DataFrame, as_of: Column) -> DataFrame:
    """Highest high and lowest low over the 365 days up to ``as_of``, with the
    earliest date of each. Symbols without a bar in the window are absent."""
    recent = in_dates(bars, "date", F.date_sub(as_of, WINDOW_DAYS), as_of)
    high, low, day = F.col("high"), F.col("low"), F.col("date")
    found = recent.groupBy("symbol_id").agg(
        F.max(high).alias("high_52week"),
        F.min(low).alias("low_52week"),
        F.min_by(day, F.when(high.isNotNull(), F.struct(-high, day))).alias("high_date"),
        F.min_by(day, F.when(low.isNotNull(), F.struct(low, day))).alias("low_date"),
    )
    dates = ["high_52week", "low_52week", "high_date", "low_date"]
    return found.select("symbol_id", as_of.alias("calculation_date"), *dates)


def entry_levels(metrics: DataFrame) -> DataFrame:
    """Unrounded prices 5 to 30 percent below the high, one column per level."""
    high = F.col("high_52week")
    return metrics.select(
        "symbol_id",
        "calculation_date",
        high.alias("high_52week_price"),
        *(
            (high * F.lit(factor)).alias(f"decrease_{level}_price")
            for level, factor in LEVEL_FACTORS.items()
        ),
    )


def unpivot_levels(thresholds: DataFrame, keep: list[str]) -> DataFrame:
    """One row per level: ``pct_below`` and ``threshold_price``. A table
    without some level column yields the levels it has."""
    present = [n for n in LEVEL_FACTORS if f"decrease_{n}_price" in thresholds.columns]
    pairs = F.array(
        *(
            F.struct(
                F.lit(n).alias("pct_below"),
                F.col(f"decrease_{n}_price").alias("threshold_price"),
            )
            for n in present
        )
    )
    return thresholds.select(*keep, F.inline(pairs))
