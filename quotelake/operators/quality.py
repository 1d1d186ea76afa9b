"""Data-quality operators: each returns a frame of findings or counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.functions.checks import symbol_errors
from quotelake.functions.currency import BASE_CURRENCY
from quotelake.functions.numeric import ratio
from quotelake.operators.series import with_previous
from quotelake.sources.schemas import PRICE_COLUMNS

EXTREME_MOVE = 0.5
ZERO_VOLUME_SHARE = 0.5
WARN_HOURS, ERROR_HOURS = 12, 24

# Messages of the batch gate; {n} is the count.
MISSING_MESSAGE = "Missing {n} values in {column}"
NEGATIVE_MESSAGE = "Found {n} negative prices in {column}"
EXTREME_MESSAGE = "Found {n} extreme price movements (>50%)"
ZERO_VOLUME_MESSAGE = "High number of zero volume days: {n}"
EMPTY_MESSAGE = "No data received"

# Columns that must not be null or must not repeat, by table; the
# declared tests of raw, staged and published tables and the keys of the raw ones.
NOT_NULL = {
    "symbols": ["id", "isin", "ticker", "name", "asset_type", "exchange", "currency"],
    "currency_rates": ["id", "from_currency", "to_currency", "rate_date", "exchange_rate"],
    "etf_data": ["id", "symbol_id", "date", "close"],
    "fifty_two_week_metrics": ["id", "symbol_id", "calculation_date"],
    "decrease_thresholds": ["id", "symbol_id", "calculation_date"],
    "stg_etf_data": ["id", "symbol_id", "ticker", "date", "close"],
    "stg_currency_rates": ["id", "from_currency", "to_currency", "rate_date", "exchange_rate"],
    "mart_price_history": ["ticker", "date", "close", "close_eur"],
    "mart_52week_metrics": ["ticker", "high_52week", "low_52week"],
    "mart_entry_thresholds": ["ticker", "pct_below", "threshold_price"],
}
UNIQUE = {
    "symbols": ["id", "isin", "ticker", "name"],
    "currency_rates": ["id"],
    "etf_data": ["id"],
    "fifty_two_week_metrics": ["id"],
    "decrease_thresholds": ["id"],
    "stg_etf_data": ["id"],
    "stg_currency_rates": ["id"],
    "mart_52week_metrics": ["ticker"],
}
UNIQUE_KEYS = {
    "currency_rates": ["from_currency", "to_currency", "rate_date"],
    "etf_data": ["symbol_id", "date"],
    "fifty_two_week_metrics": ["symbol_id", "calculation_date"],
    "decrease_thresholds": ["symbol_id", "calculation_date"],
}


def _count_if(condition: Column) -> Column:
    return F.coalesce(F.count_if(condition), F.lit(0))


def null_counts(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """(table_name, column_name, failures) for all columns in one pass."""
    counted = df.agg(*(_count_if(F.col(c).isNull()).alias(c) for c in columns))
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures"))
            for c in columns
        )
    )
    return counted.select(F.lit(table).alias("table_name"), F.inline(pairs))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, nulls left out. Counts combine
    before the shuffle, so one much-repeated key is no hot spot."""
    present = df.dropna(subset=list(keys))
    counts = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return counts.filter(F.col("occurrences") > 1)


def uniqueness(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """(table_name, key_columns, failures): how many key values repeat."""
    return repeated_keys(df, keys).agg(F.count(F.lit(1)).alias("failures")).select(
        F.lit(table).alias("table_name"),
        F.lit(",".join(keys)).alias("key_columns"),
        "failures",
    )


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    combined = frames[0]
    for frame in frames[1:]:
        combined = combined.unionByName(frame)
    return combined


def freshness(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """Age of the newest load per table: pass, warn past 12 h, error past 24 h."""
    frames = []
    for name, df in tables.items():
        newest = df.agg(F.max("created_at").alias("newest"))
        frames.append(newest.select(F.lit(name).alias("table_name"), "newest"))
    seconds = F.timestamp_diff("SECOND", F.col("newest"), as_of)
    age = seconds / F.lit(3600.0)
    status = (
        F.when(age > ERROR_HOURS, "error").when(age > WARN_HOURS, "warn").otherwise("pass")
    )
    return union_all(frames).select(
        "table_name", "newest", age.alias("age_hours"), status.alias("status")
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.join(known, key, "left_anti")


def orphan_counts(
    child: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """(key, orphaned): rows per key without parent. Counting first means the
    anti join moves one row per key, not the table."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias("orphaned"))
    return orphans(counts, key, parent, parent_key)


def foreign_key_failures(
    children: dict[str, DataFrame], parent: DataFrame
) -> DataFrame:
    """(table_name, failures) of ``symbol_id`` against the symbols."""
    total = F.coalesce(F.sum("orphaned"), F.lit(0)).alias("failures")
    return union_all(
        [
            orphan_counts(df, "symbol_id", parent, "id")
            .agg(total)
            .select(F.lit(name).alias("table_name"), "failures")
            for name, df in children.items()
        ]
    )


def uncovered_currencies(staged: DataFrame, staged_fx: DataFrame) -> DataFrame:
    """Rows per foreign currency that has no rate at all and so keeps its
    native price. Counting by currency first leaves a tiny anti join."""
    counts = (
        staged.filter(F.col("native_currency") != BASE_CURRENCY)
        .groupBy("native_currency")
        .agg(F.count(F.lit(1)).alias("rows_without_rate"))
    )
    covered = (
        staged_fx.filter(F.col("to_currency") == BASE_CURRENCY)
        .select(F.col("from_currency").alias("native_currency"))
        .distinct()
    )
    return counts.join(covered, "native_currency", "left_anti")


def late_starts(bars: DataFrame, start: Column) -> DataFrame:
    """Symbols whose history begins after the requested start."""
    first = bars.groupBy("symbol_id").agg(F.min("date").alias("first_date"))
    return first.filter(F.col("first_date") > start)


def _issue(
    message: str, count: str, column: str = "", unless: Column | None = None
) -> Column:
    """The message with its count, null while the count is 0 or ``unless``."""
    before, after = message.replace("{column}", column.title()).split("{n}")
    text = F.concat(F.lit(before), F.col(count).cast("string"), F.lit(after))
    fine = F.col(count) == 0 if unless is None else unless
    return F.when(~fine, text)


def batch_report(bars: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """Gate of landed bars, one row per symbol with its issues; any issue fails
    the symbol's batch. Symbols of ``expected`` (a ``symbol_id`` column) without
    any landed bar get a row of zero counts and the issue that no data came."""
    compared = with_previous(bars, ["symbol_id"], "close", "_previous")
    move = F.abs(ratio(F.col("close"), F.col("_previous")) - 1)
    jumped = (move > EXTREME_MOVE) | (
        (F.col("_previous") == 0) & (F.col("close") != 0)
    )
    fields = [*PRICE_COLUMNS, "volume"]
    counted = compared.groupBy("symbol_id").agg(
        F.count(F.lit(1)).alias("bars"),
        *(_count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in fields),
        *(_count_if(F.col(c) < 0).alias(f"negative_{c}") for c in PRICE_COLUMNS),
        _count_if(jumped).alias("extreme_moves"),
        _count_if(F.col("volume") == 0).alias("zero_volume_bars"),
    )

    zero = F.col("zero_volume_bars")
    issues = F.array_compact(
        F.array(
            *(_issue(MISSING_MESSAGE, f"missing_{c}", c) for c in fields),
            *(_issue(NEGATIVE_MESSAGE, f"negative_{c}", c) for c in PRICE_COLUMNS),
            _issue(EXTREME_MESSAGE, "extreme_moves"),
            _issue(
                ZERO_VOLUME_MESSAGE,
                "zero_volume_bars",
                unless=zero <= F.col("bars") * ZERO_VOLUME_SHARE,
            ),
        )
    )
    report = counted.withColumn("issues", issues).withColumn(
        "is_valid", F.size("issues") == 0
    )
    if expected is None:
        return report
    absent = expected.select("symbol_id").distinct().join(bars.select("symbol_id"), "symbol_id", "left_anti")
    empty = absent.select(
        "symbol_id",
        *(F.lit(0).cast(field.dataType).alias(field.name) for field in counted.schema.fields[1:]),
        F.array(F.lit(EMPTY_MESSAGE)).alias("issues"),
        F.lit(False).alias("is_valid"),
    )
    return report.unionByName(empty)


def accepted(bars: DataFrame, report: DataFrame) -> DataFrame:
    """Bars of the symbols that passed the gate."""
    passed = report.filter("is_valid").select("symbol_id")
    return bars.join(passed, "symbol_id", "left_semi")


def validated_symbols(symbols: DataFrame) -> DataFrame:
    """Symbol rows with the list of their errors."""
    return symbols.withColumn("errors", symbol_errors())


def duplicate_values(symbols: DataFrame) -> DataFrame:
    """(field, value, occurrences) of repeated isin, name and ticker values,
    all three counted in one shuffle; a repeated missing value is one too."""
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("field"), F.col(c).alias("value"))
            for c in ("isin", "name", "ticker")
        )
    )
    counts = symbols.select(F.inline(pairs)).groupBy("field", "value").agg(
        F.count(F.lit(1)).alias("occurrences")
    )
    return counts.filter(F.col("occurrences") > 1)


def file_problems(symbols: DataFrame) -> DataFrame:
    """Everything that makes a symbol file unfit to load: duplicates and invalid
    rows as (kind, item, detail). The load goes ahead only if it is empty."""
    duplicates = duplicate_values(symbols).select(
        F.concat(F.lit("duplicate "), "field").alias("kind"),
        F.col("value").alias("item"),
        F.col("occurrences").cast("string").alias("detail"),
    )
    invalid = validated_symbols(symbols).filter(F.size("errors") > 0).select(
        F.lit("invalid").alias("kind"),
        F.col("isin").alias("item"),
        F.explode("errors").alias("detail"),
    )
    return duplicates.unionByName(invalid)
