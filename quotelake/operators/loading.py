"""Incremental loading of bars, rates, metrics and symbols."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.currency import BASE_CURRENCY
from quotelake.operators.fx import convert_batch, reconvert
from quotelake.operators.ids import next_id, number_rows
from quotelake.operators.metrics import entry_levels
from quotelake.operators.quality import file_problems
from quotelake.operators.upsert import update_where, upsert
from quotelake.sources.schemas import (
    EUR_COLUMNS,
    LEVELS,
    PRICE_COLUMNS,
    SYMBOL_FILE,
)

HISTORY_START = "2021-12-01"
BAR_KEY = ["symbol_id", "date"]
BAR_VALUES = [*PRICE_COLUMNS, "volume", *EUR_COLUMNS]
RATE_KEY = ["from_currency", "to_currency", "rate_date"]
SNAPSHOT_KEY = ["symbol_id", "calculation_date"]
METRIC_VALUES = ["high_52week", "low_52week", "high_date", "low_date"]
LEVEL_VALUES = ["high_52week_price", *(f"decrease_{n}_price" for n in LEVELS)]


def latest_dates(bars: DataFrame) -> DataFrame:
    """High-water mark: newest loaded date per symbol."""
    return bars.groupBy("symbol_id").agg(F.max("date").alias("latest_date"))


def only_newer(
    landed: DataFrame, bars: DataFrame, start: str = HISTORY_START
) -> DataFrame:
    """Landed bars past the symbol's high-water mark, or from ``start`` on for
    a symbol that has none."""
    marks = latest_dates(bars).join(
        landed.select("symbol_id").distinct(), "symbol_id", "left_semi"
    )
    day, mark = F.col("date"), F.col("latest_date")
    newer = F.when(mark.isNull(), day >= F.lit(start).cast("date")).otherwise(day > mark)
    return landed.join(marks, "symbol_id", "left").filter(newer).drop("latest_date")


def load_bars(
    current: DataFrame,
    landed: DataFrame,
    symbols: DataFrame,
    rates: DataFrame,
    loaded_at: Column,
    ordinal: str = "seq",
    first_new_id: Column | None = None,
) -> DataFrame:
    """Convert landed bars to EUR and upsert them. EUR-native bars load without
    EUR prices; the intermediate model fills them."""
    converted = convert_batch(landed, symbols, rates, fill_base=False)
    return upsert(
        current, converted, BAR_KEY, BAR_VALUES, ordinal, loaded_at, first_new_id
    )


def load_rates(
    current: DataFrame, landed: DataFrame, loaded_at: Column, ordinal: str = "seq"
) -> DataFrame:
    return upsert(current, landed, RATE_KEY, ["exchange_rate"], ordinal, loaded_at)


def load_metrics(
    current: DataFrame,
    computed: DataFrame,
    loaded_at: Column,
    first_new_id: Column | None = None,
) -> DataFrame:
    batch = computed.withColumn("seq", F.lit(1))
    return upsert(
        current, batch, SNAPSHOT_KEY, METRIC_VALUES, "seq", loaded_at, first_new_id
    )


def load_thresholds(
    current: DataFrame,
    computed: DataFrame,
    loaded_at: Column,
    first_new_id: Column | None = None,
) -> DataFrame:
    """Entry levels of freshly computed metrics."""
    batch = entry_levels(computed).withColumn("seq", F.lit(1))
    return upsert(
        current, batch, SNAPSHOT_KEY, LEVEL_VALUES, "seq", loaded_at, first_new_id
    )


def assign_symbol_ids(landed: DataFrame, start: Column) -> DataFrame:
    """Number new symbols from ``start``; ISINs are unique."""
    return number_rows(landed, ["isin"], start)


def add_symbols(
    current: DataFrame, landed: DataFrame, loaded_at: Column
) -> DataFrame:
    """Insert symbols with the next ids, active and stamped."""
    numbered = assign_symbol_ids(landed, next_id(current))
    added = numbered.withColumns(
        {"created_at": loaded_at, "is_active": F.lit(True)}
    )
    return current.unionByName(added.select(*current.columns))


def reload_symbols(
    landed: DataFrame, first_id: Column, loaded_at: Column
) -> DataFrame:
    """Content that replaces the symbols table. All or nothing: with any
    duplicate or invalid row the result is empty."""
    fields = SYMBOL_FILE.fieldNames()
    problems = file_problems(landed).agg(F.count(F.lit(1))).scalar()
    clean = landed.filter(problems == 0).select(*fields)
    return assign_symbol_ids(clean, first_id).select(
        "id",
        *fields,
        loaded_at.alias("created_at"),
        F.lit(True).alias("is_active"),
    )


def update_eur_prices(
    current: DataFrame, symbols: DataFrame, rates: DataFrame
) -> DataFrame:
    """Recompute EUR prices of all foreign bars of active symbols. A bar whose
    day has no rate loses its EUR prices."""
    foreign = F.col("is_active") & (F.col("_currency") != BASE_CURRENCY)
    return reconvert(current, symbols, rates, foreign)


def fill_native_eur(current: DataFrame, symbols: DataFrame) -> DataFrame:
    """EUR-native bars of active symbols with any missing EUR price take their
    native prices."""
    native = symbols.filter("is_active AND currency = 'EUR'").select(
        F.col("id").alias("symbol_id"), F.lit(True).alias("_native")
    )
    gap = F.lit(False)
    for column in EUR_COLUMNS:
        gap = gap | F.col(column).isNull()
    assignments = {t: F.col(s) for s, t in zip(PRICE_COLUMNS, EUR_COLUMNS)}
    joined = current.join(native, "symbol_id", "left")
    return update_where(joined, F.col("_native") & gap, assignments).select(
        *current.columns
    )
