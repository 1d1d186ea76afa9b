"""Exchange-rate operators: lookup, pivots to EUR, batch conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.currency import BASE_CURRENCY, convert
from quotelake.functions.numeric import round2
from quotelake.operators.latest import latest_per_key
from quotelake.operators.sizing import RATE_BYTES, SYMBOL_BYTES, broadcast_if_small, is_small
from quotelake.sources.schemas import EUR_COLUMNS, PRICE_COLUMNS
from quotelake.sources.storage import in_dates

PAIR = ["from_currency", "to_currency"]


def rates_between(
    rates: DataFrame, start, end, to_currency: str = BASE_CURRENCY,
    from_currency: str | None = None,
) -> DataFrame:
    """Rates to ``to_currency`` in a date range, for one or all sources."""
    picked = rates.filter(F.col("to_currency") == to_currency)
    if from_currency is not None:
        picked = picked.filter(F.col("from_currency") == from_currency)
    columns = [*PAIR, "rate_date", "exchange_rate"]
    return in_dates(picked, "rate_date", start, end).select(*columns)


def identity_rates(bars: DataFrame, currency: str = BASE_CURRENCY) -> DataFrame:
    """Rate 1.0 of a currency to itself for every day the bars span."""
    span = bars.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return span.select(
        F.lit(currency).alias("from_currency"),
        F.lit(currency).alias("to_currency"),
        F.explode(F.sequence("first", "last")).alias("rate_date"),
        F.lit(1.0).alias("exchange_rate"),
    )


def lookup_rates(requests: DataFrame, rates: DataFrame) -> DataFrame:
    """Stored rate per (from, to, rate_date) request: 1.0 for a currency to
    itself, null where nothing is stored."""
    keys = [*PAIR, "rate_date"]
    stored = broadcast_if_small(
        rates.select(*keys, F.col("exchange_rate").alias("_stored"))
    )
    same = F.col("from_currency") == F.col("to_currency")
    rate = F.when(same, F.lit(1.0)).otherwise(F.col("_stored"))
    joined = requests.join(stored, keys, "left")
    return joined.withColumn("exchange_rate", rate).drop("_stored")


def latest_rates(rates: DataFrame) -> DataFrame:
    """Newest rate per currency pair."""
    newest = latest_per_key(rates, PAIR, "rate_date", ["rate_date", "exchange_rate"])
    return newest.select(*PAIR, "rate_date", "exchange_rate")


def _with_base(rates: DataFrame) -> DataFrame:
    """Add EUR = 1.0 unless the frame holds EUR itself."""
    base = rates.sparkSession.range(1).select(
        F.lit(BASE_CURRENCY).alias("currency"), F.lit(1.0).alias("rate_to_eur")
    )
    return rates.unionByName(base).groupBy("currency").agg(
        F.coalesce(
            F.max(F.when(F.col("currency") != BASE_CURRENCY, F.col("rate_to_eur"))),
            F.min("rate_to_eur"),
        ).alias("rate_to_eur")
    )


def pivot_rates(fx: DataFrame) -> DataFrame:
    """EUR rate per currency from the newest stored rate of each."""
    newest = latest_per_key(fx, ["from_currency"], "rate_date", ["exchange_rate"])
    return _with_base(
        newest.select(
            F.col("from_currency").alias("currency"),
            F.col("exchange_rate").alias("rate_to_eur"),
        )
    )


def implied_rates(prices: DataFrame) -> DataFrame:
    """EUR rate per currency from the newest bar that has both prices."""
    usable = prices.filter(
        F.col("close").isNotNull()
        & F.col("close_eur").isNotNull()
        & F.col("native_currency").isNotNull()
    )
    newest = usable.groupBy("native_currency").agg(
        F.max_by(F.struct("close", "close_eur"), F.struct("date", "ticker")).alias("_b")
    )
    return _with_base(
        newest.filter(F.col("_b.close") != 0).select(
            F.col("native_currency").alias("currency"),
            (F.col("_b.close_eur") / F.col("_b.close")).alias("rate_to_eur"),
        )
    )


def rates_to_eur(fx: DataFrame, prices: DataFrame) -> DataFrame:
    """Pivot rates from the FX mart, or implied ones where it has no rows. The
    choice is part of the plan; no job runs while it is made."""
    stored = fx.agg(F.count(F.lit(1)) > 0).scalar()
    return pivot_rates(fx).filter(stored).unionByName(implied_rates(prices).filter(~stored))


def rate_of(rates: DataFrame, currency: str) -> Column:
    """One currency's pivot rate as a scalar subquery; null when unknown."""
    row = rates.filter(F.col("currency") == currency)
    return row.agg(F.max("rate_to_eur")).scalar()


def with_source_rate(
    df: DataFrame, rates: DataFrame, currency_column: str = "native_currency"
) -> DataFrame:
    """Attach ``source_rate`` for the row's own currency."""
    side = rates.select(
        F.col("currency").alias(currency_column),
        F.col("rate_to_eur").alias("source_rate"),
    )
    return df.join(broadcast_if_small(side), currency_column, "left")


def convert_columns(
    df: DataFrame, rates: DataFrame, columns: Sequence[str], target: str
) -> DataFrame:
    """Convert native-currency columns into ``target`` through EUR."""
    target_rate = rate_of(rates, target)
    joined = with_source_rate(df, rates)
    converted = {
        c: convert(F.col(c), F.col("source_rate"), target_rate) for c in columns
    }
    return joined.withColumns(converted).drop("source_rate")


def _owners(symbols: DataFrame) -> DataFrame:
    return symbols.select(
        F.col("id").alias("symbol_id"), F.col("currency").alias("_currency"), "is_active"
    )


def _day_rates(rates: DataFrame) -> DataFrame:
    return rates.filter(F.col("to_currency") == BASE_CURRENCY).select(
        F.col("from_currency").alias("_currency"),
        F.col("rate_date").alias("date"),
        F.col("exchange_rate").alias("_rate"),
    )


def keeps_layout(symbols: DataFrame, rates: DataFrame) -> bool:
    """Whether a conversion leaves its bars where and in the order they are: both
    sides are broadcast."""
    return is_small(_owners(symbols), SYMBOL_BYTES) and is_small(_day_rates(rates), RATE_BYTES)


def _with_day_rate(bars: DataFrame, symbols: DataFrame, rates: DataFrame) -> DataFrame:
    """Bars plus their symbol's ``is_active`` and ``_currency`` and the stored
    EUR rate of the bar's own day."""
    return bars.join(broadcast_if_small(_owners(symbols), SYMBOL_BYTES), "symbol_id", "left").join(
        broadcast_if_small(_day_rates(rates), RATE_BYTES), ["_currency", "date"], "left"
    )


def _converted(fill_base: bool) -> dict[str, Column]:
    """EUR column expressions over rows that carry ``_currency`` and ``_rate``."""
    native = F.col("_currency") == BASE_CURRENCY
    converted = {}
    for source, target in zip(PRICE_COLUMNS, EUR_COLUMNS):
        price = F.col(source)
        copied = price if fill_base else F.lit(None).cast("double")
        by_rate = F.when(price != 0, round2(price * F.col("_rate")))
        converted[target] = F.when(native, copied).otherwise(by_rate)
    return converted


def convert_batch(
    bars: DataFrame, symbols: DataFrame, rates: DataFrame, fill_base: bool = True
) -> DataFrame:
    """EUR prices of landed bars by the rate of the same day.

    Null where the day has no rate or the price is 0 or null. EUR-native rows
    copy their prices, or stay null with ``fill_base=False`` as the loader does.
    """
    out = _with_day_rate(bars, symbols, rates).withColumns(_converted(fill_base))
    kept = [c for c in bars.columns if c not in EUR_COLUMNS]
    return out.select(*kept, *EUR_COLUMNS)


def reconvert(
    bars: DataFrame, symbols: DataFrame, rates: DataFrame, only: Column
) -> DataFrame:
    """Recompute the EUR prices of the rows where ``only`` (over the symbol's
    ``is_active`` and ``_currency``) holds, in one pass without a self-join."""
    joined = _with_day_rate(bars, symbols, rates)
    replaced = {
        name: F.when(only, value).otherwise(F.col(name))
        for name, value in _converted(True).items()
    }
    return joined.withColumns(replaced).select(*bars.columns)
