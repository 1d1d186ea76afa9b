"""Symbol validation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted codes and the messages users already know.
REQUIRED_FIELDS = ("isin", "ticker", "name", "asset_type", "exchange", "currency")
ASSET_TYPES = ("ETF", "STOCK")
EXCHANGES = ("LSE", "NYSE", "NASDAQ")
CURRENCIES = ("USD", "GBP", "EUR")
ISIN_PATTERN = "^[A-Z]{2}[A-Z0-9]{9}[0-9]$"
ISIN_FORMAT_MESSAGE = (
    "ISIN must be 12 characters: 2 letters + 9 alphanumeric + 1 check digit"
)
ISIN_COUNTRY_MESSAGE = "ISIN must start with 'IE' (UCITS) or 'US' (US-listed)"
IRISH_EXCHANGE_MESSAGE = "Irish ISINs (UCITS) must use LSE exchange"
US_EXCHANGE_MESSAGE = "US ISINs must use NYSE or NASDAQ exchange"


def isin_error(isin: Column) -> Column:
    """Null for an accepted ISIN, else why it is refused."""
    return (
        F.when(isin.isNull() | (isin == ""), F.lit("ISIN cannot be empty"))
        .when(~isin.rlike(ISIN_PATTERN), F.lit(ISIN_FORMAT_MESSAGE))
        .when(
            ~(isin.startswith("IE") | isin.startswith("US")),
            F.lit(ISIN_COUNTRY_MESSAGE),
        )
    )


def _not_in(column: Column, label: str, accepted: tuple[str, ...]) -> Column:
    message = f"Invalid {label}. Must be one of: {list(accepted)}"
    return F.when(~column.isin(*accepted), F.lit(message))


def exchange_error(isin: Column, exchange: Column) -> Column:
    return F.when(
        isin.startswith("IE") & (exchange != "LSE"), F.lit(IRISH_EXCHANGE_MESSAGE)
    ).when(
        isin.startswith("US") & ~exchange.isin("NYSE", "NASDAQ"),
        F.lit(US_EXCHANGE_MESSAGE),
    )


def symbol_errors() -> Column:
    """Array of messages for one symbol row. A missing field hides the rest."""
    missing = F.array_compact(
        F.array(
            *(
                F.when(
                    F.col(name).isNull() | (F.col(name) == ""),
                    F.lit(f"Missing or empty required field: {name}"),
                )
                for name in REQUIRED_FIELDS
            )
        )
    )
    isin, exchange = F.col("isin"), F.col("exchange")
    content = F.array_compact(
        F.array(
            isin_error(isin),
            _not_in(F.col("asset_type"), "asset_type", ASSET_TYPES),
            _not_in(exchange, "exchange", EXCHANGES),
            exchange_error(isin, exchange),
            _not_in(F.col("currency"), "currency", CURRENCIES),
        )
    )
    return F.when(F.size(missing) > 0, missing).otherwise(content)
