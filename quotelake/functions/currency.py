"""Currency expressions: pivot conversion, symbols, money text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASE_CURRENCY = "EUR"

# Display symbol per currency, and the stand-in EUR ratio used
# when a series has no converted price.
CURRENCY_SYMBOLS = {
    "USD": "$",
    "GBP": "£",
    "EUR": "€",
    "CHF": "CHF",
    "SEK": "kr",
    "NOK": "kr",
}
APPROXIMATE_EUR_RATIO = 0.85
MISSING_MONEY = "—"

# Home currency per investor country; anything else is USD.
COUNTRY_CURRENCY = {
    "USA": "USD",
    "Australia": "USD",
    "Germany": "EUR",
    "France": "EUR",
}


def lookup(key: Column, mapping: dict, default: Column) -> Column:
    """Small constant map as a CASE chain."""
    chain = None
    for name, value in mapping.items():
        chain = (F if chain is None else chain).when(key == F.lit(name), F.lit(value))
    return chain.otherwise(default)


def convert(value: Column, source_rate: Column, target_rate: Column) -> Column:
    """Convert through EUR. Without both rates the value passes unchanged."""
    known = source_rate.isNotNull() & target_rate.isNotNull()
    return F.when(known, value * source_rate / target_rate).otherwise(value)


def convert_at_latest_ratio(value: Column, close: Column, close_eur: Column) -> Column:
    """EUR value by the ratio of the latest bar, or by the stand-in ratio."""
    usable = close.isNotNull() & close_eur.isNotNull()
    factor = F.when(usable, close_eur / F.nullif(close, F.lit(0.0))).otherwise(
        F.lit(APPROXIMATE_EUR_RATIO)
    )
    return F.when(value == 0, value).otherwise(value * factor)


def currency_symbol(currency: Column) -> Column:
    return lookup(currency, CURRENCY_SYMBOLS, currency)


def country_currency(country: Column) -> Column:
    return lookup(country, COUNTRY_CURRENCY, F.lit("USD"))


def money_text(value: Column, currency: Column) -> Column:
    """``€1,234.50``; a dash for a missing amount. Only the three currencies
    offered for display carry a symbol here, others have none."""
    shown = {c: CURRENCY_SYMBOLS[c] for c in ("USD", "GBP", "EUR")}
    text = F.concat(lookup(currency, shown, F.lit("")), F.format_number(value, 2))
    return F.when(value.isNull(), F.lit(MISSING_MONEY)).otherwise(text)


def plain_money_text(value: Column, currency: Column) -> Column:
    """``kr1234.50``: any known symbol or else the code, no grouping; N/A for a
    missing amount."""
    digits = F.replace(F.format_number(value, 2), F.lit(","), F.lit(""))
    text = F.concat(currency_symbol(currency), digits)
    return F.when(value.isNull(), F.lit("N/A")).otherwise(text)


def signed_pct_text(value: Column) -> Column:
    return F.format_string("%+.2f%%", value)
