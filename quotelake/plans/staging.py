"""Staging projections over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.sizing import SYMBOL_BYTES, broadcast_if_small
from quotelake.sources.schemas import EUR_COLUMNS, PRICE_COLUMNS

SYMBOL_COLUMNS = ("ticker", "etf_name", "isin", "exchange", "native_currency")


def active_symbols(symbols: DataFrame) -> DataFrame:
    columns = ["id", "isin", "ticker", "name", "asset_type", "exchange", "currency"]
    return symbols.filter("is_active").select(*columns)


def described_symbols(symbols: DataFrame) -> DataFrame:
    """Active symbols under the names the marts use."""
    return symbols.filter("is_active").select(
        F.col("id").alias("symbol_id"),
        "ticker",
        F.col("name").alias("etf_name"),
        "isin",
        "exchange",
        F.col("currency").alias("native_currency"),
    )


def stage_prices(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Bars of active symbols with the symbol's description."""
    sides = broadcast_if_small(described_symbols(symbols), SYMBOL_BYTES)
    return bars.join(sides, "symbol_id").select(
        "id",
        "symbol_id",
        *SYMBOL_COLUMNS,
        "date",
        *PRICE_COLUMNS,
        "volume",
        *EUR_COLUMNS,
        "created_at",
    )


def stage_fx(rates: DataFrame) -> DataFrame:
    """Rates that can be used: above zero."""
    return rates.filter(F.col("exchange_rate") > 0).select(
        "id", "from_currency", "to_currency", "rate_date", "exchange_rate", "created_at"
    )
