"""Reporting operators over the marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions import calendar
from quotelake.functions.currency import (
    BASE_CURRENCY,
    convert,
    convert_at_latest_ratio,
    money_text,
    plain_money_text,
    signed_pct_text,
)
from quotelake.operators.fx import convert_columns, rate_of
from quotelake.operators.latest import latest_per_key, top_n_per_key
from quotelake.operators.metrics import newest_date, unpivot_levels
from quotelake.operators.series import position_slice
from quotelake.operators.sizing import broadcast_if_small
from quotelake.sources.schemas import LEVELS
from quotelake.sources.storage import in_dates

# Sparkline length, bars shown when a range is empty, slider window,
# profit targets in percent.
SPARK_POINTS = 30
RECENT_ROWS = 100
SLICE_ROWS = 50
PROFIT_TARGETS = (10, 20, 50, 100)


# Row order in which listings and marts are shown; "-" descends.
SHOWN_ORDER = {
    "mart_price_history": ("ticker", "date"),
    "mart_52week_metrics": ("ticker",),
    "mart_entry_thresholds": ("ticker", "pct_below"),
    "active_symbols": ("name",),
    "symbol_status": ("id",),
    "rows_per_symbol": ("id",),
    "eur_coverage": ("id",),
    "bars_in_range": ("date",),
    "ordered_tickers": ("rank",),
    "metric_history": ("name", "-calculation_date"),
    "threshold_history": ("name", "-calculation_date"),
    "price_pivot": ("time",),
}


def shown(df: DataFrame, listing: str) -> DataFrame:
    """``df`` in the listing's row order. A presentation step: plans, loads and
    stored tables do without it, since a global order costs a range shuffle."""
    return df.orderBy(
        *(
            F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc()
            for c in SHOWN_ORDER[listing]
        )
    )


# Listings and lookups ---------------------------------------------------------


def symbol_by_isin(symbols: DataFrame, isin: str) -> DataFrame:
    columns = [c for c in symbols.columns if c != "created_at"]
    return symbols.filter(F.col("isin") == isin).select(*columns)


def bars_in_range(
    bars: DataFrame, start, end, symbol_id: int | None = None
) -> DataFrame:
    """Bars in an inclusive range, for one symbol or for all."""
    picked = bars if symbol_id is None else bars.filter(F.col("symbol_id") == symbol_id)
    return in_dates(picked, "date", start, end)


def symbol_status(symbols: DataFrame) -> DataFrame:
    status = F.when(F.col("is_active"), "ACTIVE").otherwise("INACTIVE")
    return symbols.select("id", "name", "ticker", "currency", status.alias("status"))


def symbol_search(symbols: DataFrame, term: str) -> DataFrame:
    """Substring match over ticker and name, ignoring case."""
    text = F.lower(F.concat_ws(" ", "ticker", "name"))
    return symbols.filter(text.contains(term.lower())).select("ticker", "name", "isin")


def in_display_order(df: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Tickers of ``df`` that are on the display list, with their rank."""
    shown = F.array(*(F.lit(t) for t in tickers))
    rank = F.array_position(shown, F.col("ticker"))
    present = df.filter(F.col("ticker").isin(*tickers)).select("ticker").distinct()
    return present.withColumn("rank", rank)


def metric_history(snapshots: DataFrame, symbols: DataFrame, columns: list[str]) -> DataFrame:
    """All snapshots under the symbol's name, for ordering by name and date."""
    names = symbols.select(F.col("id").alias("symbol_id"), "name")
    joined = snapshots.join(broadcast_if_small(names), "symbol_id")
    return joined.select("name", "calculation_date", *columns)


# Coverage counts --------------------------------------------------------------


def _per_symbol(bars: DataFrame, symbols: DataFrame, counts: dict[str, Column]) -> DataFrame:
    """Left join of symbols to per-symbol counts; symbols without bars count 0.
    Counting first means the join moves one row per symbol."""
    counted = bars.groupBy("symbol_id").agg(*(c.alias(n) for n, c in counts.items()))
    described = symbols.select("id", "name", "ticker", "currency")
    joined = described.join(counted, described.id == counted.symbol_id, "left")
    return joined.select(
        *described.columns,
        *(F.coalesce(F.col(n), F.lit(0)).alias(n) for n in counts),
    )


def rows_per_symbol(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    return _per_symbol(bars, symbols, {"record_count": F.count("id")})


def eur_coverage(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    return _per_symbol(
        bars,
        symbols,
        {
            "total_records": F.count("id"),
            "with_eur_records": F.count("open_eur"),
        },
    ).withColumn(
        "null_eur_records",
        # a symbol without bars counts once: its joined row has a null price
        F.when(F.col("total_records") == 0, F.lit(1).cast("long")).otherwise(
            F.col("total_records") - F.col("with_eur_records")
        ),
    )


def eur_coverage_total(bars: DataFrame) -> DataFrame:
    total, filled = F.count(F.lit(1)), F.count("open_eur")
    return bars.agg(
        total.alias("total"),
        filled.alias("with_eur"),
        (total - filled).alias("without_eur"),
    )


def fx_pair_counts(rates: DataFrame) -> DataFrame:
    return rates.groupBy("from_currency", "to_currency").agg(
        F.count(F.lit(1)).alias("rates")
    )


def history_span(bars: DataFrame, symbols: DataFrame) -> DataFrame:
    """Number of bars, first and last date per symbol name."""
    spans = bars.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("data_points"),
        F.min("date").alias("earliest_date"),
        F.max("date").alias("latest_date"),
    )
    names = symbols.select(F.col("id").alias("symbol_id"), "name")
    return spans.join(names, "symbol_id").drop("symbol_id")


def unconverted_sample(bars: DataFrame, symbols: DataFrame, rows: int = 5) -> DataFrame:
    """A few bars without an EUR price, lowest ids first."""
    sides = symbols.select(F.col("id").alias("symbol_id"), "ticker", "currency")
    missing = bars.filter(F.col("open_eur").isNull())
    return (
        missing.join(broadcast_if_small(sides), "symbol_id")
        .select("id", "symbol_id", "date", "close", "close_eur", "ticker", "currency")
        .orderBy("id")
        .limit(rows)
    )


# Date ranges ------------------------------------------------------------------


def in_preset(prices: DataFrame, preset: str = "1Y") -> DataFrame:
    """Rows in a preset ending at the newest date of the table."""
    newest = newest_date(prices)
    return in_dates(prices, "date", calendar.range_start(preset, newest), newest)


def in_custom_range(prices: DataFrame, start: str, end: str) -> DataFrame:
    return in_dates(prices, "date", start, end)


def in_calendar_preset(prices: DataFrame, preset: str, today: Column) -> DataFrame:
    """Rows from a calendar preset's start on."""
    return in_dates(prices, "date", calendar.calendar_start(preset, today))


def or_recent(ranged: DataFrame, prices: DataFrame, rows: int = RECENT_ROWS) -> DataFrame:
    """``ranged``, plus the newest bars of every ticker that has none in it."""
    shown = ranged.select("ticker").distinct()
    absent = prices.join(shown, "ticker", "left_anti")
    return ranged.unionByName(top_n_per_key(absent, ["ticker"], "date", rows))


def row_slice(
    prices: DataFrame, slider: float, rows: int = SLICE_ROWS
) -> DataFrame:
    """Bars around the slider position (0-100) of each ticker's series."""
    total = F.col("_total")
    width = F.least(F.lit(rows), total)
    index = F.floor(F.lit(slider / 100) * (total - 1))
    start = F.greatest(F.lit(0), index - F.floor(width / 2))
    end = F.least(total - 1, start + width)
    first = F.when(end == total - 1, F.greatest(F.lit(0), end - width + 1))
    return position_slice(prices, ["ticker"], first.otherwise(start), end).select(
        "ticker", "date", "close_eur", F.col("position").cast("long").alias("position")
    )


# Prices in a chosen currency --------------------------------------------------


def indexed_to_100(ranged: DataFrame) -> DataFrame:
    """EUR close as percent of the ticker's first close in the range."""
    base = ranged.groupBy("ticker").agg(F.min_by("close_eur", "date").alias("_base"))
    value = F.col("close_eur") / F.nullif(F.col("_base"), F.lit(0.0)) * 100.0
    joined = ranged.join(broadcast_if_small(base), "ticker")
    return joined.select("ticker", "date", value.alias("indexed"))


def price_in_currency(prices: DataFrame, rates: DataFrame, target: str) -> DataFrame:
    """EUR close over the target's rate; an unknown target leaves EUR."""
    rate = F.coalesce(rate_of(rates, target), F.lit(1.0))
    value = F.col("close_eur") / rate
    return prices.select("ticker", "date", value.alias("price"))


def sparkline(prices: DataFrame, points: int = SPARK_POINTS) -> DataFrame:
    """Array of the newest closes per ticker, oldest first."""
    newest = top_n_per_key(
        prices.select("ticker", "date", "close_eur"), ["ticker"], "date", points
    )
    ordered = F.sort_array(F.collect_list(F.struct("date", "close_eur")))
    return newest.groupBy("ticker").agg(
        F.transform(ordered, lambda p: p["close_eur"]).alias("spark")
    )


def kpi_cards(prices: DataFrame, rates: DataFrame, target: str) -> DataFrame:
    """Newest price in the chosen currency, day change and its direction."""
    last = latest_per_key(prices, ["ticker"], "date", ["close_eur", "daily_change_pct"])
    price = convert(
        F.col("close_eur"), rate_of(rates, BASE_CURRENCY), rate_of(rates, target)
    )
    change = F.col("daily_change_pct")
    return last.select(
        "ticker",
        price.alias("price"),
        change,
        F.coalesce(change >= 0, F.lit(False)).alias("is_up"),
    )


def summary_in_currency(week52: DataFrame, rates: DataFrame, target: str) -> DataFrame:
    """52-week summary in the chosen currency with the signed distance."""
    columns = ["high_52week", "low_52week", "latest_close"]
    distance = F.coalesce(-F.col("pct_below_52w_high"), F.lit(0.0))
    return convert_columns(week52, rates, columns, target).select(
        "ticker",
        "etf_name",
        *columns,
        distance.alias("distance"),
        signed_pct_text(distance).alias("distance_text"),
        money_text(F.col("latest_close"), F.lit(target)).alias("current_text"),
    )


def threshold_ladder(
    thresholds: DataFrame, rates: DataFrame, target: str, ticker: str | None = None
) -> DataFrame:
    """Entry prices in the chosen currency beside the current price."""
    picked = thresholds if ticker is None else thresholds.filter(F.col("ticker") == ticker)
    columns = ["threshold_price", "latest_close"]
    label = F.concat(F.col("pct_below").cast("string"), F.lit("% Below High"))
    return convert_columns(picked, rates, columns, target).select(
        "ticker",
        "pct_below",
        label.alias("label"),
        "threshold_price",
        F.col("latest_close").alias("current_price"),
    )


def formatted_prices(week52: DataFrame) -> DataFrame:
    """Money, percent and date text of each ticker's newest price."""
    return week52.select(
        "ticker",
        money_text(F.col("latest_close"), F.col("native_currency")).alias("price_text"),
        plain_money_text(F.col("high_52week"), F.col("native_currency")).alias("high_text"),
        money_text(F.col("latest_close_eur"), F.lit("EUR")).alias("eur_text"),
        signed_pct_text(F.col("daily_change_eur_pct")).alias("change_text"),
        calendar.display_date(F.col("latest_price_date")).alias("date_text"),
    )


def current_price(bars: DataFrame) -> DataFrame:
    """Newest bar's price: native, and EUR with fallback to native. Zero counts
    as missing in the ``or_zero`` columns."""
    last = latest_per_key(bars, ["symbol_id"], "date", ["date", "close", "close_eur"])
    close, close_eur = F.col("close"), F.col("close_eur")
    some, some_eur = F.nullif(close, F.lit(0.0)), F.nullif(close_eur, F.lit(0.0))
    zero = F.lit(0.0)
    return last.select(
        "symbol_id",
        "date",
        close.alias("price"),
        F.coalesce(close_eur, close).alias("price_eur"),
        F.coalesce(some, some_eur, zero).alias("price_or_zero"),
        F.coalesce(some_eur, some, zero).alias("price_eur_or_zero"),
    )


# Panels -----------------------------------------------------------------------


def report_52week(week52: DataFrame) -> DataFrame:
    return week52.select(
        F.col("ticker").alias("Ticker"),
        F.col("etf_name").alias("ETF Name"),
        F.col("latest_close_eur").alias("Price (EUR)"),
        F.col("daily_change_eur_pct").alias("Daily Change %"),
        F.col("high_52week").alias("52w High"),
        F.col("low_52week").alias("52w Low"),
        F.col("pct_below_52w_high").alias("% Below High"),
        F.col("pct_above_52w_low").alias("% Above Low"),
        F.col("latest_price_date").alias("Last Updated"),
    )


def report_thresholds(thresholds: DataFrame) -> DataFrame:
    signal = F.when(F.col("is_at_or_below_threshold"), "Signal").otherwise("Not Yet")
    return thresholds.select(
        F.col("ticker").alias("Ticker"),
        F.col("pct_below").alias("% Below 52w High"),
        F.col("threshold_price").alias("Threshold Price"),
        F.col("latest_close").alias("Current Price"),
        F.col("gap_to_threshold_pct").alias("Gap to Threshold %"),
        signal.alias("Buy Signal"),
    )


def _step(value: Column, *steps: tuple[float, str], below: str) -> Column:
    """Label of the highest step reached; ``below`` under the first."""
    chain = F
    for limit, label in reversed(steps):
        chain = chain.when(value >= limit, F.lit(label))
    return F.when(value.isNotNull(), chain.otherwise(F.lit(below)))


def severity(week52: DataFrame) -> DataFrame:
    """Colour bucket of the drop below the high and of the day's change."""
    below, change = F.col("pct_below_52w_high"), F.col("daily_change_eur_pct")
    return week52.select(
        "ticker",
        below,
        _step(below, (5, "yellow"), (15, "red"), below="green").alias("below_high"),
        change,
        _step(change, (0, "green"), below="red").alias("change_sign"),
    )


def gap_severity(thresholds: DataFrame) -> DataFrame:
    gap = F.col("gap_to_threshold_pct")
    label = _step(gap, (0, "red"), below="green")
    return thresholds.select("ticker", "pct_below", gap, label.alias("gap_sign"))


def price_pivot(
    prices: DataFrame, tickers: Sequence[str], start=None, end=None
) -> DataFrame:
    """One column of EUR closes per listed ticker, one row per date of the
    inclusive range."""
    stamped = F.col("date").cast("timestamp_ntz").alias("time")
    columns = [
        F.max(F.when(F.col("ticker") == t, F.col("close_eur"))).alias(t)
        for t in tickers
    ]
    return in_dates(prices, "date", start, end).groupBy(stamped).agg(*columns)


def series_stats(prices: DataFrame) -> DataFrame:
    """Last non-null, lowest and highest EUR close per ticker."""
    value = F.col("close_eur")
    known = F.when(value.isNotNull(), F.col("date"))
    return prices.groupBy("ticker").agg(
        F.max_by(value, known).alias("last_value"),
        F.min(value).alias("min_value"),
        F.max(value).alias("max_value"),
    )


# Levels against history -------------------------------------------------------


def thresholds_reached(
    bars: DataFrame, thresholds: DataFrame, in_eur: bool = True
) -> DataFrame:
    """Whether each entry level was ever reached, and the first date.

    ``thresholds`` has one wide row per symbol. The levels are attached to the
    bars as columns and all six are tested in one aggregate, so rows are never
    multiplied and a long series is combined before the shuffle.
    """
    levels = {n: f"decrease_{n}_price" for n in LEVELS}
    newest = latest_per_key(bars, ["symbol_id"], "date", ["close", "close_eur"])
    wide = thresholds.join(
        newest.withColumnsRenamed({"close": "_close", "close_eur": "_close_eur"}),
        "symbol_id",
    )

    def in_currency(column: str) -> Column:
        if not in_eur:
            return F.col(column)
        return convert_at_latest_ratio(F.col(column), F.col("_close"), F.col("_close_eur"))

    wide = wide.select(
        "symbol_id",
        *(in_currency(c).alias(f"_level_{n}") for n, c in levels.items()),
    )
    price = F.col("close_eur" if in_eur else "close")
    joined = bars.select("symbol_id", "date", price.alias("_price")).join(
        broadcast_if_small(wide), "symbol_id"
    )
    day, low = F.col("date"), F.col("_price")
    found = joined.groupBy("symbol_id").agg(
        F.min(low).alias("min_price"),
        *(F.max(f"_level_{n}").alias(f"_level_{n}") for n in levels),
        *(F.min(F.when(low <= F.col(f"_level_{n}"), day)).alias(f"_on_{n}") for n in levels),
    )
    pairs = F.array(
        *(
            F.struct(
                F.lit(n).alias("pct_below"),
                F.col(f"_level_{n}").alias("threshold_price"),
                F.col(f"_on_{n}").alias("reached_date"),
            )
            for n in levels
        )
    )
    reached = F.coalesce(F.col("min_price") <= F.col("threshold_price"), F.lit(False))
    return found.select("symbol_id", "min_price", F.inline(pairs)).withColumn(
        "is_reached", reached
    )


def profit_targets(
    thresholds: DataFrame, bars: DataFrame, in_eur: bool = True
) -> DataFrame:
    """Target prices above every entry level and whether the current price is
    there. Levels and targets are constants expanded within the row."""
    newest = latest_per_key(bars, ["symbol_id"], "date", ["close", "close_eur"])
    levels = unpivot_levels(thresholds, ["symbol_id"]).filter(
        F.col("threshold_price").isNotNull() & (F.col("threshold_price") != 0)
    )
    joined = levels.join(newest, "symbol_id")
    entry, current = F.col("threshold_price"), F.col("close")
    if in_eur:
        entry = convert_at_latest_ratio(entry, F.col("close"), F.col("close_eur"))
        current = F.coalesce("close_eur", "close")
    targets = F.array(*(F.lit(t) for t in PROFIT_TARGETS))
    price = F.col("entry_price") * (1 + F.col("profit_pct") / 100)
    return (
        joined.select(
            "symbol_id",
            "pct_below",
            entry.alias("entry_price"),
            current.alias("current_price"),
            F.explode(targets).alias("profit_pct"),
        )
        .withColumn("target_price", price)
        .withColumn(
            "is_reached",
            F.coalesce(F.col("current_price") >= F.col("target_price"), F.lit(False)),
        )
    )


def levels_in_eur(thresholds: DataFrame, bars: DataFrame) -> DataFrame:
    """Newest high of each symbol in EUR by the latest bar's ratio."""
    newest = latest_per_key(bars, ["symbol_id"], "date", ["close", "close_eur"])
    high = convert_at_latest_ratio(
        F.col("high_52week_price"), F.col("close"), F.col("close_eur")
    )
    return thresholds.join(newest, "symbol_id", "left").select(
        "symbol_id", "high_52week_price", high.alias("high_eur")
    )
