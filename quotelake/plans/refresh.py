"""Loading landed bars into stored tables, restartable at any point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators.ids import next_id
from quotelake.operators.loading import load_bars, load_metrics, load_thresholds
from quotelake.operators.metrics import metrics_52week
from quotelake.operators.latest import latest_per_key
from quotelake.operators.quality import accepted, batch_report
from quotelake.operators.state import next_bar_id
from quotelake.sources.lake import DATED, Lake
from quotelake.sources.storage import MONTH, month_of, settle, write_dated


UNKNOWN_MESSAGE = "Symbol is unknown or inactive"


def merge_months(
    lake: Lake,
    table: str,
    months: list[int],
    merge: Callable[[DataFrame, Column], DataFrame],
    staging: str,
    first_id: Column | None = None,
) -> None:
    """Replace the given month partitions of a stored table by a merge of them.

    The merge is staged completely before the table is touched. A rerun with
    the same staging folder skips a finished merge and only copies it again, so
    a job lost half way neither loses rows nor applies a batch twice.
    """
    stored = lake.raw(table)
    current = stored.filter(F.col(MONTH).isin(months)).drop(MONTH)
    merged = settle(merge(current, next_id(stored) if first_id is None else first_id), staging)
    write_dated(merged, lake.path(table), *DATED[table], replace_all=False)


def months_of(df: DataFrame, date_column: str) -> list[int]:
    """Months a batch touches: a handful of integers, bounded by the calendar."""
    rows = df.select(month_of(F.col(date_column)).alias(MONTH)).distinct().collect()
    return sorted(r[MONTH] for r in rows)


def load_batch(
    lake: Lake, landed: DataFrame, loaded_at: Column, as_of: str, staging: str
) -> DataFrame:
    """Gate landed bars per symbol, upsert those that pass, refresh metrics; the
    stored report says for every landed symbol whether it was loaded and why not.

    Only the last version of a day counts, in the gate as in the load. Symbols that
    are unknown or inactive are reported and left out. A symbol that fails stops
    no other symbol. All symbols go through one plan; nothing loops over them.
    """
    symbols, rates = lake.raw("symbols"), lake.raw("currency_rates")
    values = [c for c in landed.columns if c not in ("symbol_id", "date")]
    single = latest_per_key(landed, ["symbol_id", "date"], "seq", values, order_is_unique=False)
    active = symbols.filter("is_active").select(F.col("id").alias("symbol_id"), F.lit(True).alias("_known"))
    checked = batch_report(single.drop("seq")).join(active, "symbol_id", "left")
    unknown = F.when(F.col("_known").isNull(), F.array(F.lit(UNKNOWN_MESSAGE))).otherwise(F.array())
    report = settle(
        checked.withColumn("issues", F.concat("issues", unknown))
        .withColumn("is_valid", F.size("issues") == 0)
        .drop("_known"),
        f"{staging}/report",
    )
    passed = settle(accepted(single, report), f"{staging}/accepted")
    months = months_of(passed, "date")
    if not months:
        return report

    def bars(current: DataFrame, first_id: Column) -> DataFrame:
        return load_bars(
            current, passed, symbols, rates, loaded_at, first_new_id=first_id
        )

    # new ids follow the greatest one in the state; the state of the touched months follows the bars
    merge_months(lake, "etf_data", months, bars, f"{staging}/etf_data", next_bar_id(lake.state()))
    lake.refresh_state(months)
    refresh_metrics(lake, passed.select("symbol_id"), loaded_at, as_of, staging)
    return report


def refresh_metrics(
    lake: Lake, touched: DataFrame, loaded_at: Column, as_of: str, staging: str
) -> None:
    """Recompute 52-week metrics and entry levels of the touched symbols."""
    day = F.lit(as_of).cast("date")
    bars = lake.raw("etf_data").join(touched.distinct(), "symbol_id", "left_semi")
    computed = settle(metrics_52week(bars, day), f"{staging}/metrics")
    month = [int(as_of[:4]) * 100 + int(as_of[5:7])]
    merge_months(
        lake,
        "fifty_two_week_metrics",
        month,
        lambda current, first_id: load_metrics(current, computed, loaded_at, first_id),
        f"{staging}/fifty_two_week_metrics",
    )
    merge_months(
        lake,
        "decrease_thresholds",
        month,
        lambda current, first_id: load_thresholds(
            current, computed, loaded_at, first_id
        ),
        f"{staging}/decrease_thresholds",
    )


def copy_lake(spark: SparkSession, source: Lake, root: str) -> Lake:
    """Separate copy of a lake's loadable tables."""
    target = Lake(spark, root)
    for table in ("symbols", "currency_rates", *DATED):
        if table.startswith("mart_"):
            continue
        stored = source.raw(table)
        target.write(table, stored.drop(MONTH) if table in DATED else stored)
    return target
