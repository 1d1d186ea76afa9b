"""Returns, risk, growth and holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.calendar import month_step, years_between
from quotelake.functions.currency import BASE_CURRENCY, convert, country_currency
from quotelake.functions.numeric import exact_sum, ratio, round2
from quotelake.operators.fx import rate_of, with_source_rate
from quotelake.operators.series import carry_max, with_previous
from quotelake.operators.sizing import SYMBOL_BYTES, broadcast_if_small, broadcast_per_row
from quotelake.operators.summary import series_summaries
from quotelake.sources.storage import in_dates

# Trading days per year, growth-rate limits and fallback, growth
# rate per scenario, stress factor, gains-tax rate and taxable share by country.
TRADING_DAYS = 252.0
CAGR_CAP, CAGR_FALLBACK = 0.30, 0.10
SCENARIOS = {"conservative": 0.07, "moderate": 0.10, "aggressive": 0.12}
STRESS_FACTOR = 0.7
TAX_RATES = {"USA": 0.15, "Australia": 0.20, "Germany": 0.26375, "France": 0.30}
TAXABLE_SHARE = {"Australia": 0.5}


def daily_returns(prices: DataFrame) -> DataFrame:
    """Return against the preceding bar, where both closes are usable."""
    compared = with_previous(
        prices.select("ticker", "date", "close_eur"), ["ticker"], "close_eur", "_prev"
    )
    price, previous = F.col("close_eur"), F.col("_prev")
    usable = (previous > 0) & price.isNotNull() & (price != 0)
    change = F.when(usable, (price - previous) / F.nullif(previous, F.lit(0.0)))
    return (
        compared.withColumn("daily_return", change)
        .filter(F.col("daily_return").isNotNull())
        .select("ticker", "date", "daily_return")
    )


def volatility(returns: DataFrame) -> DataFrame:
    """Annualized population deviation of daily returns."""
    yearly = F.stddev_pop("daily_return") * F.sqrt(F.lit(TRADING_DAYS))
    return returns.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("returns"), yearly.alias("volatility")
    )


def running_drawdown(prices: DataFrame) -> DataFrame:
    """Distance of each close below the running peak; null closes are skipped."""
    known = prices.select("ticker", "date", "close_eur").filter(
        F.col("close_eur").isNotNull()
    )
    peaked = carry_max(known, ["ticker"], "close_eur", "peak")
    below = ratio(F.col("close_eur") - F.col("peak"), F.col("peak"))
    return peaked.withColumn("drawdown", below)


def worst_drawdown(drawdowns: DataFrame) -> DataFrame:
    """Deepest drawdown per ticker with its earliest date; 0 when there is none."""
    fall, day = F.col("drawdown"), F.col("date")
    falls = F.when(fall < 0, F.struct(fall, day))
    return (
        drawdowns.groupBy("ticker")
        .agg(F.min(falls).alias("_worst"))
        .select(
            "ticker",
            F.coalesce("_worst.drawdown", F.lit(0.0)).alias("max_drawdown"),
            F.col("_worst.date").alias("drawdown_date"),
            F.year("_worst.date").alias("drawdown_year"),
        )
    )


def cagr(prices: DataFrame) -> DataFrame:
    """Yearly growth from first to last close, within [0, 0.30]; 0.10 where the
    series is too short or has no usable price."""
    ends = prices.groupBy("ticker").agg(
        F.min_by("close_eur", "date").alias("first_price"),
        F.max_by("close_eur", "date").alias("last_price"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )
    first, last = F.col("first_price"), F.col("last_price")
    years = years_between(F.col("first_date"), F.col("last_date"))
    usable = (first > 0) & last.isNotNull() & (last != 0) & (years > 0)
    growth = F.pow(ratio(last, first), 1 / F.nullif(years, F.lit(0.0))) - 1
    limited = F.greatest(F.lit(0.0), F.least(F.lit(CAGR_CAP), growth))
    value = F.when(usable, limited).otherwise(F.lit(CAGR_FALLBACK))
    return ends.withColumn("years", years).withColumn("cagr", value)


def growth_of_amount(
    prices: DataFrame,
    amount: float,
    years: int,
    end: Column,
    rates: DataFrame,
    target: str = BASE_CURRENCY,
) -> DataFrame:
    """Value in ``target`` of an amount in the symbol's own currency, invested at the
    first close in [end - years, end]. One rate holds for the whole range, so it
    cancels out of the price ratio and only the amount is converted."""
    start = month_step(end, F.lit(-12 * years))
    zero = F.lit(0.0)
    some = F.coalesce(F.nullif(F.col("close_eur"), zero), F.nullif(F.col("close"), zero))
    ranged = in_dates(prices, "date", start, end).select(
        "ticker", "native_currency", "date", some.alias("_price")
    )
    base = ranged.groupBy("ticker").agg(
        F.coalesce(F.min_by("_price", "date"), F.lit(1.0)).alias("_base"),
        F.max("native_currency").alias("native_currency"),
    )
    invested = planned_amounts(base, amount, rates, target)
    value = F.col("amount") * (F.coalesce(F.col("_price"), zero) / F.col("_base"))
    joined = ranged.drop("native_currency").join(broadcast_if_small(invested), "ticker")
    return joined.select("ticker", "date", F.greatest(zero, value).alias("value"))


def planned_amounts(
    tickers: DataFrame, amount: float, rates: DataFrame, target: str = BASE_CURRENCY
) -> DataFrame:
    """``tickers`` (ticker, native_currency, ...) with ``amount`` converted from the
    symbol's currency into ``target``."""
    converted = convert(F.lit(amount), F.col("source_rate"), rate_of(rates, target))
    return with_source_rate(tickers, rates).withColumn("amount", converted)


def starting_values(
    planned: DataFrame, grown: DataFrame, start: Column, today: Column
) -> DataFrame:
    """(ticker, start_value) of a projection: the last value of the growth up to
    ``start``; the planned amount for a start after ``today`` and for tickers
    without growth."""
    last = grown.groupBy("ticker").agg(F.max_by("value", "date").alias("_last"))
    value = F.when(start > today, F.col("amount")).otherwise(
        F.coalesce("_last", "amount")
    )
    joined = planned.join(last, "ticker", "left")
    return joined.select("ticker", value.alias("start_value"))


def projection(
    growth: DataFrame, starting: DataFrame, years: int, start: Column
) -> DataFrame:
    """Monthly compound schedule per ticker and scenario from the ticker's
    ``start_value``; the historical scenario uses the ticker's own rate."""
    scenarios = F.array(
        *(
            F.struct(F.lit(n).alias("scenario"), F.lit(r).alias("rate"))
            for n, r in SCENARIOS.items()
        ),
        F.struct(F.lit("historical").alias("scenario"), F.col("cagr").alias("rate")),
    )
    months = F.sequence(F.lit(0), F.lit(12 * years))
    monthly = 1 + F.col("rate") / 12
    return (
        growth.join(starting, "ticker")
        .select("ticker", "start_value", F.inline(scenarios))
        .select("ticker", "start_value", "scenario", "rate", F.explode(months).alias("month"))
        .select(
            "ticker",
            "scenario",
            "month",
            month_step(start, F.col("month")).alias("date"),
            (F.col("start_value") * F.pow(monthly, F.col("month"))).alias("value"),
        )
    )


# Holdings ---------------------------------------------------------------------


def priced_holdings(
    holdings: DataFrame, symbols: DataFrame, newest: DataFrame, rates: DataFrame
) -> DataFrame:
    """Holdings with the symbol's newest price and both sides' EUR rates.

    Symbol, price and rate are joined first, one row per symbol; the holdings
    then join once. The bound is put to the symbols, of which each gives one row.
    Beyond it that join shuffles on symbol_id and adaptive execution splits a
    much-held symbol.
    """
    priced = symbols.select(
        F.col("id").alias("symbol_id"),
        "ticker",
        F.col("currency").alias("native_currency"),
    ).join(newest.select("ticker", "latest_close", "latest_close_eur"), "ticker", "left")
    per_symbol = with_source_rate(priced, rates)
    target = F.when(
        country_currency(F.col("country")) == BASE_CURRENCY,
        rate_of(rates, BASE_CURRENCY),
    ).otherwise(rate_of(rates, "USD"))
    side = broadcast_per_row(per_symbol, symbols, SYMBOL_BYTES)
    joined = holdings.join(side, "symbol_id")
    return joined.withColumn("target_rate", target)


def _in_home_currency(value: Column) -> Column:
    return convert(value, F.col("source_rate"), F.col("target_rate"))


def holdings_value(priced: DataFrame) -> DataFrame:
    """Current value of each holding, native, EUR and in the holder's currency."""
    units = F.col("units")
    native, eur = units * F.col("latest_close"), units * F.col("latest_close_eur")
    return priced.select(
        "holder",
        "symbol_id",
        "ticker",
        "country",
        units,
        native.alias("value_native"),
        eur.alias("value_eur"),
        _in_home_currency(native).alias("value_home"),
    )


def holdings_total(priced: DataFrame) -> DataFrame:
    """Invested amount per holder in the holder's currency."""
    invested = _in_home_currency(F.col("cost"))
    return priced.groupBy("holder", "country").agg(
        exact_sum(invested).alias("total_invested")
    )


def affordable_units(priced: DataFrame) -> DataFrame:
    """Whole units the invested amount buys at the newest EUR price, and their
    value; the price is converted once."""
    invested = _in_home_currency(F.col("cost"))
    price = F.col("latest_close_eur") / F.col("target_rate")
    units = F.coalesce(
        F.when(price > 0, F.floor(invested / F.nullif(price, F.lit(0.0)))), F.lit(0)
    )
    return priced.select(
        "holder",
        "symbol_id",
        invested.alias("invested"),
        price.alias("price"),
        units.cast("long").alias("units_affordable"),
        F.coalesce(units * price, F.lit(0.0)).alias("current_value"),
    )


def symbol_risk(prices: DataFrame) -> DataFrame:
    """Volatility and worst drawdown per ticker, of the EUR price (``in_eur``) and of
    the native one, both summed up in one pass by ``series_summaries``."""
    found = series_summaries(prices, ["ticker"], ["close_eur", "close"])
    both = F.array(
        F.struct(F.lit(True).alias("in_eur"), F.col("close_eur").alias("_s")),
        F.struct(F.lit(False).alias("in_eur"), F.col("close").alias("_s")),
    )
    return found.select("ticker", F.inline(both)).select("ticker", "in_eur", "_s.*")


def portfolio_risk(priced: DataFrame, risk: DataFrame) -> DataFrame:
    """Per holder: invested amount in the holder's currency, weighted volatility,
    the single worst drawdown and its year, and the value left after a 30 percent
    fall. Holders at home in EUR are measured by EUR prices, others by native ones.

    The weighted mean is written as sum(amount * vol) / sum(amount), so one
    aggregate does, with no second join of the totals on the holder.
    """
    home = country_currency(F.col("country"))
    held = (
        priced.filter(F.col("cost") > 0)
        .withColumns({"cost": _in_home_currency(F.col("cost")), "in_eur": home == BASE_CURRENCY})
        .join(risk, ["ticker", "in_eur"], "left")
    )
    cost, vol = F.col("cost"), F.coalesce("volatility", F.lit(0.0))
    fall = F.col("max_drawdown")
    deepest = F.when(fall < 0, F.struct(fall, F.col("symbol_id"), F.col("drawdown_year")))
    summed = held.groupBy("holder").agg(
        exact_sum(cost).alias("total_invested"),
        exact_sum(cost * vol).alias("_weighted"),
        F.min(deepest).alias("_worst"),
    )
    total = F.col("total_invested")
    return summed.select(
        "holder",
        "total_invested",
        ratio(F.col("_weighted"), total).alias("volatility"),
        F.coalesce("_worst.max_drawdown", F.lit(0.0)).alias("worst_drawdown"),
        F.col("_worst.drawdown_year").alias("worst_year"),
        (total * STRESS_FACTOR).alias("stress_value"),
    )


def _by_country(values: dict[str, float], default: float) -> Column:
    chain = F
    for country, value in values.items():
        chain = chain.when(F.col("country") == country, F.lit(value))
    return chain.otherwise(F.lit(default))


def tax_estimate(valued: DataFrame) -> DataFrame:
    """Tax on each holder's gain, from ``cost`` and ``value`` in one currency."""
    totals = valued.groupBy("holder", "country").agg(
        exact_sum(F.col("cost")).alias("total_cost"),
        exact_sum(F.col("value")).alias("total_value"),
    )
    gain = F.greatest(F.lit(0.0), F.col("total_value") - F.col("total_cost"))
    taxable = gain * _by_country(TAXABLE_SHARE, 1.0)
    return totals.withColumn("gain", gain).withColumn(
        "tax", round2(taxable * _by_country(TAX_RATES, 0.0))
    )
