"""Time the headline queries; print one JSON line.

Every query is materialized completely (``noop`` sink). The raw tables are
folded from the trading tables, and the marts published, inside the timed
``load_raw_tables`` and ``publish_marts`` entries; what a session needs once for
all queries is listed apart as ``setup``.
"""

from __future__ import annotations

import json
import os
import time

from quotelake.catalog import QUERIES
from quotelake.session import build_session
from quotelake.sources.lake import lake_for

HEADLINE = (
    "load_raw_tables",
    "publish_marts",
    "raw_bars",
    "stg_prices",
    "int_prices_eur",
    "mart_price_history",
    "mart_52week",
    "mart_thresholds",
    "metrics_52week",
    "convert_batch",
    "upsert_prices",
    "upsert_fx",
    "update_eur_prices",
    "incremental_bars",
    "assign_symbol_ids",
    "scan_symbol_docs",
    "dq_batch",
    "dq_unique_composite",
    "rows_per_symbol",
    "range_preset",
    "indexed_100",
    "row_slice",
    "sparkline",
    "kpi_cards",
    "price_pivot",
    "threshold_reached",
    "profit_targets",
    "daily_returns",
    "volatility",
    "drawdown",
    "cagr",
    "growth_of_amount",
    "projection",
    "holdings_value",
    "portfolio_risk",
    "tax_estimate",
    "run_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__driver__memory="12g",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__python__sql__dataFrameDebugging__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    began = time.perf_counter()
    lake = lake_for(spark, folder, published=True)
    for name in list(lake.pending):  # all raw tables, not only those the marts read
        lake.path(name)
    setup = time.perf_counter() - began

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        began = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - began, 3)
    rows = lake.raw("etf_data").count()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf") or 0),
                "setup": round(setup, 3),
                "bars": rows,
                "eur_conversion_rows_per_sec": round(rows / seconds["int_prices_eur"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
