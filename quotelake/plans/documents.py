"""Nested export documents and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.latest import latest_per_key
from quotelake.operators.metrics import unpivot_levels
from quotelake.plans.marts import latest_thresholds
from quotelake.plans.staging import active_symbols
from quotelake.sources.schemas import EUR_COLUMNS, PRICE_COLUMNS
from quotelake.sources.storage import in_dates


def export_metrics(metrics: DataFrame) -> DataFrame:
    """Newest 52-week metrics per symbol under the export's names."""
    columns = ["high_52week", "low_52week", "high_date", "low_date", "calculation_date"]
    newest = latest_per_key(metrics, ["symbol_id"], "calculation_date", columns)
    names = ("high52week", "low52week", "highDate", "lowDate", "calculationDate")
    return newest.select(
        "symbol_id", *(F.col(c).alias(n) for c, n in zip(columns, names))
    )


def export_thresholds(thresholds: DataFrame) -> DataFrame:
    """Newest entry levels per symbol, null and zero prices left out."""
    levels = unpivot_levels(
        latest_thresholds(thresholds), ["symbol_id", "calculation_date"]
    )
    price = F.col("threshold_price")
    return levels.filter(price.isNotNull() & (price != 0)).select(
        "symbol_id",
        F.col("pct_below").alias("percentage"),
        price.alias("thresholdPrice"),
        F.col("calculation_date").alias("calculationDate"),
    )


def symbol_list(symbols: DataFrame) -> DataFrame:
    return active_symbols(symbols).select(
        "ticker", "name", "isin", F.col("currency").alias("nativeCurrency")
    )


def symbol_documents(
    bars: DataFrame,
    symbols: DataFrame,
    metrics: DataFrame,
    thresholds: DataFrame,
    updated_at: Column,
    start: Column | None = None,
    end: Column | None = None,
) -> DataFrame:
    """One document per active symbol with all its bars, or those between
    ``start`` and ``end`` where they are given. A symbol has one bar a day, so the
    calendar bounds the array (50 years: at most 18,300 entries) however many
    symbols there are."""
    recent = in_dates(bars, "date", start, end)
    entry = F.struct("date", *PRICE_COLUMNS, "volume", *EUR_COLUMNS)
    # moved as rows: gathering them per input split first would sort every split
    prices = recent.repartition("symbol_id").groupBy("symbol_id").agg(
        F.sort_array(F.collect_list(entry)).alias("priceData")
    )
    numbers = export_metrics(metrics)
    metric_names = [c for c in numbers.columns if c != "symbol_id"]
    nested_metrics = numbers.select("symbol_id", F.struct(*metric_names).alias("metrics"))
    levels = export_thresholds(thresholds)
    level_names = [c for c in levels.columns if c != "symbol_id"]
    nested_levels = levels.groupBy("symbol_id").agg(
        F.sort_array(F.collect_list(F.struct(*level_names))).alias("thresholds")
    )
    described = active_symbols(symbols).select(
        F.col("id").alias("symbol_id"),
        F.struct(
            "id", "name", "ticker", "isin", F.col("currency").alias("nativeCurrency")
        ).alias("symbol"),
    )
    return (
        described.join(prices, "symbol_id", "left")
        .join(nested_metrics, "symbol_id", "left")
        .join(nested_levels, "symbol_id", "left")
        .select(
            "symbol",
            F.coalesce("priceData", F.array()).alias("priceData"),
            "metrics",
            F.coalesce("thresholds", F.array()).alias("thresholds"),
            updated_at.alias("lastUpdated"),
        )
    )


def run_logs(events: DataFrame) -> DataFrame:
    """Run-log documents from an event table: run = user, step = event type. A
    step's entry is its newest event, so a run holds one entry per step type."""
    step = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("start_time"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("end_time"),
        F.col("value").alias("duration"),
        (F.col("event_type") != "error").alias("success"),
        F.when(F.col("event_type") == "error", F.col("props")).alias("error"),
    )
    newest = events.groupBy(F.col("user_id").alias("run_id"), "event_type").agg(
        F.max_by(step, F.struct("ts", "event_id")).alias("_step"),
        F.max("ts").alias("_at"),
    )
    good = F.col("_step.success")
    return newest.groupBy("run_id").agg(
        F.date_format(F.min("_at"), "yyyy-MM-dd HH:mm:ss").alias("workflow_start"),
        F.date_format(F.max("_at"), "yyyy-MM-dd HH:mm:ss").alias("workflow_end"),
        F.timestamp_diff("SECOND", F.min("_at"), F.max("_at"))
        .cast("double")
        .alias("overall_duration"),
        F.bool_and(good).alias("overall_success"),
        F.map_from_entries(
            F.sort_array(F.collect_list(F.struct("event_type", "_step")))
        ).alias("steps"),
        F.sort_array(
            F.collect_list(
                F.when(~good, F.concat_ws(": ", "event_type", F.col("_step.error")))
            )
        ).alias("errors"),
    )
