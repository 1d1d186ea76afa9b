"""Intermediate EUR prices and the four marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelake.functions.currency import BASE_CURRENCY
from quotelake.functions.numeric import pct, round2
from quotelake.operators.fx import latest_rates
from quotelake.operators.latest import latest_per_key
from quotelake.operators.metrics import unpivot_levels
from quotelake.operators.sizing import RATE_BYTES, SYMBOL_BYTES, broadcast_if_small
from quotelake.plans.staging import SYMBOL_COLUMNS, described_symbols
from quotelake.sources.schemas import EUR_COLUMNS, LEVELS, PRICE_COLUMNS

AVERAGE_ROWS = 7
DAILY_COLUMNS = (
    "daily_change",
    "daily_change_pct",
    "daily_change_eur",
    "daily_change_eur_pct",
)


def eur_prices(staged: DataFrame, staged_fx: DataFrame) -> DataFrame:
    """Every price row with EUR prices: loaded value, else the day's rate, else
    the newest rate of the pair, else the native price.

    Both rate sides have one row per currency and day at most, so their size is
    bounded by the calendar; they are broadcast only if the plan confirms it.
    """
    to_eur = staged_fx.filter(F.col("to_currency") == BASE_CURRENCY)
    by_day = to_eur.select(
        F.col("from_currency").alias("native_currency"),
        F.col("rate_date").alias("date"),
        F.col("exchange_rate").alias("_day"),
    )
    newest = latest_rates(to_eur).select(
        F.col("from_currency").alias("native_currency"),
        F.col("exchange_rate").alias("_newest"),
    )
    joined = staged.join(
        broadcast_if_small(by_day, RATE_BYTES), ["native_currency", "date"], "left"
    ).join(broadcast_if_small(newest, RATE_BYTES), "native_currency", "left")
    foreign = F.col("native_currency") != BASE_CURRENCY
    filled = {
        target: F.coalesce(
            F.col(target),
            F.when(foreign, round2(F.col(source) * F.col("_day"))),
            F.when(foreign, round2(F.col(source) * F.col("_newest"))),
            F.col(source),
        )
        for source, target in zip(PRICE_COLUMNS, EUR_COLUMNS)
    }
    return joined.withColumns(filled).select(
        "id",
        "symbol_id",
        *SYMBOL_COLUMNS,
        "date",
        *PRICE_COLUMNS,
        "volume",
        *EUR_COLUMNS,
    )


def with_daily_change(prices: DataFrame) -> DataFrame:
    """Close against open of the same day, native and EUR."""
    change = F.col("close") - F.col("open")
    change_eur = F.col("close_eur") - F.col("open_eur")
    return prices.withColumns(
        {
            "daily_change": round2(change),
            "daily_change_pct": round2(pct(change, F.col("open"))),
            "daily_change_eur": round2(change_eur),
            "daily_change_eur_pct": round2(pct(change_eur, F.col("open_eur"))),
        }
    )


def price_history(prices: DataFrame) -> DataFrame:
    """Mart of all prices with daily change and the 7-row EUR average.

    A symbol has one bar a day (``dq_unique_composite`` checks it), so the calendar
    bounds a ticker's rows (50 years: 18,300) and one window per ticker needs one
    read, one exchange and one sort. Series in which a day may repeat take
    ``series.moving_average``."""
    week = Window.partitionBy("ticker").orderBy("date").rowsBetween(1 - AVERAGE_ROWS, 0)
    averaged = prices.withColumn("_average", F.avg("close_eur").over(week))
    return with_daily_change(averaged).select(
        *SYMBOL_COLUMNS,
        "date",
        *PRICE_COLUMNS,
        "volume",
        *EUR_COLUMNS,
        *DAILY_COLUMNS,
        round2(F.col("_average")).alias("close_eur_7d_avg"),
    )


def latest_price(history: DataFrame) -> DataFrame:
    """Newest price per ticker."""
    newest = latest_per_key(
        history, ["ticker"], "date", ["date", "close", "close_eur", "daily_change_eur_pct"]
    )
    return newest.select(
        "ticker",
        F.col("date").alias("latest_price_date"),
        F.col("close").alias("latest_close"),
        F.col("close_eur").alias("latest_close_eur"),
        "daily_change_eur_pct",
    )


def _with_symbol_and_price(
    per_symbol: DataFrame, symbols: DataFrame, newest: DataFrame
) -> DataFrame:
    described = broadcast_if_small(described_symbols(symbols), SYMBOL_BYTES)
    return per_symbol.join(described, "symbol_id").join(newest, "ticker", "left")


def week52_metrics(
    metrics: DataFrame, symbols: DataFrame, newest: DataFrame
) -> DataFrame:
    """Mart of the newest 52-week metrics per active symbol with its price."""
    columns = ["calculation_date", "high_52week", "low_52week", "high_date", "low_date"]
    current = latest_per_key(metrics, ["symbol_id"], "calculation_date", columns)
    high, low = F.col("high_52week"), F.col("low_52week")
    close = F.col("latest_close")
    return _with_symbol_and_price(current, symbols, newest).select(
        *SYMBOL_COLUMNS,
        "high_52week",
        "low_52week",
        "high_date",
        "low_date",
        "calculation_date",
        round2(high - low).alias("range_52week"),
        round2(pct(high - low, low)).alias("range_52week_pct"),
        "latest_price_date",
        "latest_close",
        "latest_close_eur",
        "daily_change_eur_pct",
        round2(high - close).alias("distance_from_high"),
        round2(pct(high - close, high)).alias("pct_below_52w_high"),
        round2(close - low).alias("distance_from_low"),
        round2(pct(close - low, low)).alias("pct_above_52w_low"),
    )


def latest_thresholds(thresholds: DataFrame) -> DataFrame:
    """Newest threshold row per symbol; level columns the table lacks are skipped."""
    levels = [f"decrease_{n}_price" for n in LEVELS]
    present = [c for c in levels if c in thresholds.columns]
    columns = ["calculation_date", "high_52week_price", *present]
    return latest_per_key(thresholds, ["symbol_id"], "calculation_date", columns)


def entry_thresholds(
    thresholds: DataFrame, symbols: DataFrame, newest: DataFrame
) -> DataFrame:
    """Mart of entry prices, one row per active symbol and level."""
    levels = unpivot_levels(
        latest_thresholds(thresholds),
        ["symbol_id", "calculation_date", "high_52week_price"],
    )
    gap = F.col("latest_close") - F.col("threshold_price")
    reached = F.col("latest_close") <= F.col("threshold_price")
    return _with_symbol_and_price(levels, symbols, newest).select(
        "ticker",
        "etf_name",
        "exchange",
        "native_currency",
        "calculation_date",
        "high_52week_price",
        "pct_below",
        "threshold_price",
        F.when(reached, True).otherwise(False).alias("is_at_or_below_threshold"),
        round2(gap).alias("gap_to_threshold"),
        round2(pct(gap, F.col("threshold_price"))).alias("gap_to_threshold_pct"),
        "latest_close",
        "latest_close_eur",
    )


def fx_rates(staged_fx: DataFrame) -> DataFrame:
    """Mart of usable rates to EUR."""
    return staged_fx.filter(F.col("to_currency") == BASE_CURRENCY).select(
        "from_currency", "to_currency", "rate_date", "exchange_rate"
    )
