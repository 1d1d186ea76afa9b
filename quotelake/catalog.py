"""Named queries: each takes (spark, data folder) and returns a DataFrame.

What a report leaves to the user (range, currency, amount) is fixed here, so that
results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.currency import convert
from quotelake.functions.numeric import round2, round_to
from quotelake.operators import (
    fx,
    loading,
    portfolio,
    quality,
    reconcile,
    reports,
    runlog,
    state,
)
from quotelake.operators.metrics import entry_levels, metrics_52week, newest_date
from quotelake.operators.latest import latest_per_key
from quotelake.operators.sizing import SYMBOL_BYTES, broadcast_per_row
from quotelake.operators.upsert import update_by_key
from quotelake.plans import documents, marts, staging
from quotelake.plans.refresh import copy_lake
from quotelake.sources import derive, files
from quotelake.sources.lake import Lake, build_raw, lake_for
from quotelake.sources.schemas import BAR_FILE, EUR_COLUMNS
from quotelake.sources.storage import MONTH, new_folder
from quotelake.streaming.bars import load_landed_files

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

LOADED_AT = "2002-01-01 21:15:00"
SHOWN_TICKERS = [
    "Supplier#000000003",
    "Supplier#000000001",
    "Supplier#000000008",
    "Supplier#999999999",
    "Supplier#000000005",
]
AMOUNT = 10000.0
PROJECTION_START = "2001-10-31"
PIVOT_RANGE = ("1996-01-01", "2000-12-31")


def query(function: Query) -> Query:
    """Register under the function's name; a trailing underscore, which keeps
    an imported operator's name free, is dropped."""
    QUERIES[function.__name__.rstrip("_")] = function
    return function


def _loaded_at():
    return F.lit(LOADED_AT).cast("timestamp_ntz")


def _plain(df: DataFrame) -> DataFrame:
    """Without the storage partition column."""
    return df.drop(MONTH)


def _bars(spark: SparkSession, folder: str) -> DataFrame:
    return lake_for(spark, folder).raw("etf_data")


def _symbols(spark: SparkSession, folder: str) -> DataFrame:
    return lake_for(spark, folder).raw("symbols")


def _rates(spark: SparkSession, folder: str) -> DataFrame:
    return lake_for(spark, folder).raw("currency_rates")


def _metrics(spark: SparkSession, folder: str) -> DataFrame:
    return lake_for(spark, folder).raw("fifty_two_week_metrics")


def _thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return lake_for(spark, folder).raw("decrease_thresholds")


def _published(spark: SparkSession, folder: str) -> Lake:
    return lake_for(spark, folder, published=True)


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).mart("mart_price_history")


def _week52(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).mart("mart_52week_metrics")


def _ladder(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).mart("mart_entry_thresholds")


def _pivot(spark: SparkSession, folder: str) -> DataFrame:
    return fx.pivot_rates(_published(spark, folder).fx_mart())


# Sources and sinks --------------------------------------------------------------


@query
def raw_bars(spark, folder):
    return _plain(_bars(spark, folder))


@query
def load_raw_tables(spark, folder):
    """A complete fresh load of all raw tables; rows per table."""
    lake = build_raw(spark, folder)
    return _row_counts(
        {
            name: lake.raw(name)
            for name in (
                "symbols",
                "currency_rates",
                "etf_data",
                "fifty_two_week_metrics",
                "decrease_thresholds",
                "holdings",
            )
        }
    )


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return quality.union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"), "row_count"
            )
            for name, df in tables.items()
        ]
    )


@query
def scan_symbols_csv(spark, folder):
    path = new_folder(spark, "symbols-csv")
    files.write_symbol_csv(_symbols(spark, folder), path)
    return files.read_symbol_csv(spark, path)


@query
def scan_bars(spark, folder):
    path = lake_for(spark, folder).path("etf_data")
    return _plain(files.read_bars(spark, path, "1998-01-01"))


@query
def scan_fx(spark, folder):
    return fx.rates_between(_rates(spark, folder), "1996-01-01", "2000-12-31")


@query
def publish_marts(spark, folder):
    source = lake_for(spark, folder)
    target = Lake(spark, source.root, new_folder(spark, "publish"))
    target.publish()
    names = [
        "mart_price_history",
        "mart_52week_metrics",
        "mart_entry_thresholds",
        "mart_fx_rates",
    ]
    return _row_counts({n: target.mart(n) for n in names})


@query
def upsert_prices(spark, folder):
    bars = _bars(spark, folder)
    return loading.load_bars(
        _plain(bars),
        derive.new_batch(bars),
        _symbols(spark, folder),
        _rates(spark, folder),
        _loaded_at(),
    )


@query
def upsert_fx(spark, folder):
    rates = _rates(spark, folder)
    return loading.load_rates(rates, derive.new_rates(rates), _loaded_at())


def _computed_metrics(spark, folder):
    bars = _bars(spark, folder)
    newest = newest_date(bars)
    restated = bars.withColumn("high", F.col("high") * 1.01)
    return metrics_52week(restated, newest).unionByName(
        metrics_52week(bars, F.date_sub(newest, 7))
    )


@query
def upsert_metrics(spark, folder):
    return loading.load_metrics(
        _plain(_metrics(spark, folder)), _computed_metrics(spark, folder), _loaded_at()
    )


@query
def upsert_thresholds(spark, folder):
    return loading.load_thresholds(
        _plain(_thresholds(spark, folder)),
        _computed_metrics(spark, folder),
        _loaded_at(),
    )


@query
def assign_symbol_ids(spark, folder):
    landed = derive.new_symbols(spark, folder)
    return loading.add_symbols(_symbols(spark, folder), landed, _loaded_at())


@query
def reload_symbols(spark, folder):
    landed = derive.new_symbols(spark, folder)
    return loading.reload_symbols(landed, F.lit(1), _loaded_at())


@query
def rejected_symbol_file(spark, folder):
    """Findings that keep a faulty symbol file from loading."""
    landed = derive.symbol_file(_symbols(spark, folder))
    return quality.file_problems(landed)


@query
def update_eur_prices(spark, folder):
    return loading.update_eur_prices(
        _plain(_bars(spark, folder)), _symbols(spark, folder), _rates(spark, folder)
    )


@query
def update_eur_keyed(spark, folder):
    """EUR prices of a landed batch written onto the bars it matches."""
    bars = _plain(_bars(spark, folder))
    landed = derive.new_batch(bars).filter("seq = 1").drop("seq")
    changes = fx.convert_batch(landed, _symbols(spark, folder), _rates(spark, folder))
    return update_by_key(bars, changes, loading.BAR_KEY, EUR_COLUMNS)


@query
def update_eur_native(spark, folder):
    return loading.fill_native_eur(
        _plain(_bars(spark, folder)), _symbols(spark, folder)
    )


def _documents(spark, folder):
    bars = _bars(spark, folder)
    built = documents.symbol_documents(
        bars,
        _symbols(spark, folder),
        _metrics(spark, folder),
        _thresholds(spark, folder),
        _loaded_at(),
    )
    path = new_folder(spark, "documents")
    files.write_documents(built, path)
    return files.read_documents(spark, path)


@query
def export_symbol_docs(spark, folder):
    return _documents(spark, folder).select(
        F.col("symbol.id").alias("id"),
        F.col("symbol.ticker").alias("ticker"),
        F.col("symbol.nativeCurrency").alias("native_currency"),
        F.size("priceData").cast("long").alias("prices"),
        F.col("metrics.high52week").alias("high52week"),
        F.col("metrics.lowDate").alias("low_date"),
        F.size("thresholds").cast("long").alias("levels"),
        F.col("lastUpdated").alias("last_updated"),
    )


@query
def scan_symbol_docs(spark, folder):
    return files.document_prices(_documents(spark, folder))


@query
def export_symbol_list(spark, folder):
    return documents.symbol_list(_symbols(spark, folder))


def _run_logs(spark, folder):
    path = new_folder(spark, "run-logs")
    events = derive.read(spark, folder, "events")
    files.write_run_logs(documents.run_logs(events), path)
    return files.read_run_logs(spark, path)


@query
def run_log_steps(spark, folder):
    return runlog.log_steps(_run_logs(spark, folder))


@query
def run_summary(spark, folder):
    return runlog.run_summary(runlog.log_steps(_run_logs(spark, folder)))


# Staging and marts --------------------------------------------------------------


@query
def stg_prices(spark, folder):
    return lake_for(spark, folder).staged_prices()


@query
def stg_fx(spark, folder):
    return lake_for(spark, folder).staged_fx()


@query
def int_prices_eur(spark, folder):
    return lake_for(spark, folder).eur_prices()


@query
def mart_price_history(spark, folder):
    return reports.shown(lake_for(spark, folder).price_history(), "mart_price_history")


@query
def mart_52week(spark, folder):
    return reports.shown(lake_for(spark, folder).week52(), "mart_52week_metrics")


@query
def mart_thresholds(spark, folder):
    return reports.shown(lake_for(spark, folder).thresholds(), "mart_entry_thresholds")


@query
def mart_fx_rates(spark, folder):
    return marts.fx_rates(lake_for(spark, folder).staged_fx())


@query
def latest_fx(spark, folder):
    return fx.latest_rates(lake_for(spark, folder).staged_fx())


@query
def latest_price(spark, folder):
    return lake_for(spark, folder).latest_price()


@query
def unpivot_thresholds(spark, folder):
    return reports.unpivot_levels(
        marts.latest_thresholds(_thresholds(spark, folder)),
        ["symbol_id", "calculation_date", "high_52week_price"],
    )


@query
def metrics_52week_(spark, folder):
    bars = _bars(spark, folder)
    return metrics_52week(bars, newest_date(bars))


@query
def entry_levels_(spark, folder):
    return entry_levels(_metrics(spark, folder))


@query
def export_metrics(spark, folder):
    return documents.export_metrics(_metrics(spark, folder))


@query
def export_thresholds(spark, folder):
    return documents.export_thresholds(_thresholds(spark, folder))


# Lookups and listings -----------------------------------------------------------


@query
def active_symbols(spark, folder):
    return reports.shown(staging.active_symbols(_symbols(spark, folder)), "active_symbols")


@query
def symbol_by_isin(spark, folder):
    return reports.symbol_by_isin(_symbols(spark, folder), "US0000000011")


@query
def symbol_status(spark, folder):
    return reports.shown(reports.symbol_status(_symbols(spark, folder)), "symbol_status")


@query
def symbol_search(spark, folder):
    return reports.symbol_search(_symbols(spark, folder), "#00000000")


@query
def ordered_tickers(spark, folder):
    shown = reports.in_display_order(_symbols(spark, folder), SHOWN_TICKERS)
    return reports.shown(shown.withColumn("rank", F.col("rank").cast("long")), "ordered_tickers")


@query
def metric_history(spark, folder):
    found = reports.metric_history(
        _metrics(spark, folder),
        _symbols(spark, folder),
        ["high_52week", "low_52week", "high_date", "low_date"],
    )
    return reports.shown(found, "metric_history")


@query
def threshold_history(spark, folder):
    found = reports.metric_history(
        _thresholds(spark, folder),
        _symbols(spark, folder),
        ["high_52week_price", "decrease_10_price", "decrease_20_price", "decrease_30_price"],
    )
    return reports.shown(found, "threshold_history")


@query
def bars_in_range(spark, folder):
    columns = [*BAR_FILE.fieldNames(), *EUR_COLUMNS]
    found = reports.bars_in_range(_bars(spark, folder), "1996-01-01", "1998-12-31")
    return reports.shown(found.select(*columns), "bars_in_range")


@query
def fx_lookup(spark, folder):
    requests = (
        lake_for(spark, folder)
        .staged_prices()
        .select(
            F.col("native_currency").alias("from_currency"),
            F.lit("EUR").alias("to_currency"),
            F.col("date").alias("rate_date"),
        )
        .distinct()
    )
    return fx.lookup_rates(requests, _rates(spark, folder))


@query
def convert_batch(spark, folder):
    landed = _bars(spark, folder).select(*BAR_FILE.fieldNames())
    return fx.convert_batch(landed, _symbols(spark, folder), _rates(spark, folder))


@query
def identity_fx(spark, folder):
    return fx.identity_rates(_bars(spark, folder))


@query
def fx_pivot(spark, folder):
    return _pivot(spark, folder)


@query
def fx_pivot_implied(spark, folder):
    """Pivot of a lake whose FX mart was never published."""
    source = _published(spark, folder)
    without_fx = Lake(spark, f"{source.root}/not-published")
    history = source.mart("mart_price_history")
    return fx.rates_to_eur(without_fx.fx_mart(), history)


@query
def convert_currency(spark, folder):
    rates = _pivot(spark, folder)
    joined = fx.with_source_rate(_week52(spark, folder), rates)
    value, source = F.col("latest_close"), F.col("source_rate")
    return joined.select(
        "ticker",
        *(
            convert(value, source, fx.rate_of(rates, c)).alias(f"in_{c.lower()}")
            for c in ("EUR", "USD", "GBP", "SEK")
        ),
    )


@query
def convert_latest_ratio(spark, folder):
    return reports.levels_in_eur(
        marts.latest_thresholds(_thresholds(spark, folder)), _bars(spark, folder)
    )


@query
def format_money(spark, folder):
    return reports.formatted_prices(_week52(spark, folder))


# Diagnostics and data quality ---------------------------------------------------


@query
def rows_per_symbol(spark, folder):
    found = reports.rows_per_symbol(_bars(spark, folder), _symbols(spark, folder))
    return reports.shown(found, "rows_per_symbol")


@query
def orphan_bars(spark, folder):
    """Bars without symbol, active or not; one symbol in seven is landed under an unknown id."""
    moved = F.when(F.col("symbol_id") % 7 == 0, F.col("symbol_id") + 1_000_000)
    landed = _bars(spark, folder).withColumn("symbol_id", F.coalesce(moved, "symbol_id"))
    return quality.orphan_counts(landed, "symbol_id", _symbols(spark, folder), "id")


@query
def unconverted_sample(spark, folder):
    return reports.unconverted_sample(_bars(spark, folder), _symbols(spark, folder))


@query
def eur_coverage(spark, folder):
    found = reports.eur_coverage(_bars(spark, folder), _symbols(spark, folder))
    return reports.shown(found, "eur_coverage")


@query
def eur_coverage_total(spark, folder):
    return reports.eur_coverage_total(_bars(spark, folder))


@query
def fx_pair_counts(spark, folder):
    return reports.fx_pair_counts(_rates(spark, folder))


@query
def history_span(spark, folder):
    return reports.history_span(_bars(spark, folder), _symbols(spark, folder))


@query
def latest_date(spark, folder):
    """High-water marks from the stored state, not from the bar table."""
    return state.marks(lake_for(spark, folder).state())


@query
def incremental_bars(spark, folder):
    """Landed bars past the marks of the stored state."""
    lake = lake_for(spark, folder)
    return state.only_newer_by_state(derive.new_batch(_bars(spark, folder)), lake.state(), loading.HISTORY_START)


@query
def symbol_state(spark, folder):
    """One state row per symbol, folded from the stored month rows."""
    return state.fold(lake_for(spark, folder).state())


@query
def reconcile_symbols(spark, folder):
    symbols = _symbols(spark, folder)
    return reconcile.reconcile(derive.symbol_file(symbols), symbols, "seq")


@query
def isin_except(spark, folder):
    symbols = _symbols(spark, folder)
    return reconcile.isins_only_in(derive.symbol_file(symbols), symbols)


@query
def isin_intersect(spark, folder):
    symbols = _symbols(spark, folder)
    return reconcile.isins_in_both(derive.symbol_file(symbols), symbols)


@query
def validate_symbols(spark, folder):
    landed = derive.symbol_file(_symbols(spark, folder))
    checked = quality.validated_symbols(landed)
    return checked.select(
        "isin",
        "ticker",
        "seq",
        F.concat_ws("; ", "errors").alias("errors"),
        (F.size("errors") == 0).alias("is_valid"),
    )


@query
def dq_duplicates(spark, folder):
    return quality.duplicate_values(derive.symbol_file(_symbols(spark, folder)))


@query
def dq_batch(spark, folder):
    report = quality.batch_report(_plain(_bars(spark, folder)))
    return report.withColumn("issues", F.concat_ws("; ", "issues"))


@query
def dq_no_data(spark, folder):
    """Gate of the newest landed batch (last version of each day) against the active
    symbols: an active symbol without landed bars is reported with no data received."""
    landed = derive.new_batch(_bars(spark, folder))
    values = [c for c in landed.columns if c not in ("symbol_id", "date")]
    single = latest_per_key(landed, ["symbol_id", "date"], "seq", values, order_is_unique=False).drop("seq")
    expected = _symbols(spark, folder).filter("is_active").select(F.col("id").alias("symbol_id"))
    report = quality.batch_report(single, expected)
    return report.withColumn("issues", F.concat_ws("; ", "issues"))


def _raw_tables(spark, folder):
    lake = lake_for(spark, folder)
    return {
        name: lake.raw(name)
        for name in (
            "symbols",
            "currency_rates",
            "etf_data",
            "fifty_two_week_metrics",
            "decrease_thresholds",
        )
    }


def _tested_tables(spark, folder):
    """Raw, staged and published tables by the names the tests use."""
    lake = _published(spark, folder)
    marts_tested = ("mart_price_history", "mart_52week_metrics", "mart_entry_thresholds")
    return {
        **_raw_tables(spark, folder),
        "stg_etf_data": lake.staged_prices(),
        "stg_currency_rates": lake.staged_fx(),
        **{name: lake.mart(name) for name in marts_tested},
    }


@query
def dq_not_null(spark, folder):
    tables = _tested_tables(spark, folder)
    return quality.union_all(
        [
            quality.null_counts(tables[name], name, columns)
            for name, columns in quality.NOT_NULL.items()
        ]
    )


@query
def dq_unique(spark, folder):
    tables = _tested_tables(spark, folder)
    return quality.union_all(
        [
            quality.uniqueness(tables[name], name, [column])
            for name, columns in quality.UNIQUE.items()
            for column in columns
        ]
    )


@query
def dq_unique_composite(spark, folder):
    tables = _raw_tables(spark, folder)
    return quality.union_all(
        [
            quality.uniqueness(tables[name], name, keys)
            for name, keys in quality.UNIQUE_KEYS.items()
        ]
    )


@query
def dq_freshness(spark, folder):
    newest = newest_date(_bars(spark, folder)).cast("timestamp_ntz")
    as_of = F.timestamp_add("HOUR", F.lit(34), newest)
    return quality.freshness(_raw_tables(spark, folder), as_of)


@query
def dq_foreign_key(spark, folder):
    tables = _raw_tables(spark, folder)
    children = {
        n: tables[n]
        for n in ("etf_data", "fifty_two_week_metrics", "decrease_thresholds")
    }
    return quality.foreign_key_failures(children, tables["symbols"])


@query
def dq_fx_coverage(spark, folder):
    lake = lake_for(spark, folder)
    return quality.uncovered_currencies(lake.staged_prices(), lake.staged_fx())


@query
def dq_late_start(spark, folder):
    return quality.late_starts(
        _bars(spark, folder), F.lit("1995-01-05").cast("date")
    )


# Reports over the marts ---------------------------------------------------------


@query
def range_preset(spark, folder):
    picked = reports.in_preset(_history(spark, folder), "1Y")
    return picked.select("ticker", "date", "close", "close_eur")


@query
def range_custom(spark, folder):
    picked = reports.in_custom_range(
        _history(spark, folder), "1997-03-01", "1999-06-30"
    )
    return picked.select("ticker", "date", "close", "close_eur")


@query
def range_calendar(spark, folder):
    history = _history(spark, folder)
    picked = reports.in_calendar_preset(history, "2y", newest_date(history))
    return picked.select("ticker", "date", "close", "close_eur")


@query
def range_or_recent(spark, folder):
    """The last month; a ticker without bars in it shows its last 100."""
    history = _history(spark, folder)
    picked = reports.in_preset(history, "1M")
    return reports.or_recent(picked, history).select("ticker", "date", "close_eur")


@query
def row_slice(spark, folder):
    return reports.row_slice(_history(spark, folder), 60)


@query
def indexed_100(spark, folder):
    ranged = reports.in_preset(_history(spark, folder), "2Y")
    indexed = reports.indexed_to_100(ranged)
    return indexed.withColumn("indexed", round_to(F.col("indexed"), 6))


@query
def price_in_currency(spark, folder):
    rates = _pivot(spark, folder)
    priced = reports.price_in_currency(_history(spark, folder), rates, "USD")
    return priced.withColumn("price", round_to(F.col("price"), 6))


@query
def sparkline(spark, folder):
    lines = reports.sparkline(_history(spark, folder))
    return lines.select(
        "ticker", F.posexplode("spark").alias("position", "close_eur")
    ).withColumn("position", F.col("position").cast("long"))


@query
def kpi_cards(spark, folder):
    return reports.kpi_cards(_history(spark, folder), _pivot(spark, folder), "USD")


@query
def summary_in_currency(spark, folder):
    return reports.summary_in_currency(
        _week52(spark, folder), _pivot(spark, folder), "GBP"
    )


@query
def threshold_ladder(spark, folder):
    return reports.threshold_ladder(
        _ladder(spark, folder), _pivot(spark, folder), "USD"
    )


@query
def current_price(spark, folder):
    return reports.current_price(_bars(spark, folder))


@query
def report_52week(spark, folder):
    return reports.report_52week(_week52(spark, folder))


@query
def report_thresholds(spark, folder):
    return reports.report_thresholds(_ladder(spark, folder))


@query
def severity_bucket(spark, folder):
    return reports.severity(_week52(spark, folder))


@query
def gap_severity(spark, folder):
    return reports.gap_severity(_ladder(spark, folder))


@query
def price_pivot(spark, folder):
    pivoted = reports.price_pivot(_history(spark, folder), SHOWN_TICKERS, *PIVOT_RANGE)
    return reports.shown(pivoted, "price_pivot")


@query
def series_stats(spark, folder):
    return reports.series_stats(_history(spark, folder))


@query
def threshold_reached(spark, folder):
    return reports.thresholds_reached(
        _bars(spark, folder), marts.latest_thresholds(_thresholds(spark, folder))
    )


@query
def threshold_reached_native(spark, folder):
    return reports.thresholds_reached(
        _bars(spark, folder),
        marts.latest_thresholds(_thresholds(spark, folder)),
        in_eur=False,
    )


@query
def profit_targets(spark, folder):
    return reports.profit_targets(
        marts.latest_thresholds(_thresholds(spark, folder)), _bars(spark, folder)
    )


# Portfolio ----------------------------------------------------------------------


@query
def daily_returns(spark, folder):
    return portfolio.daily_returns(_history(spark, folder))


@query
def volatility(spark, folder):
    found = portfolio.volatility(portfolio.daily_returns(_history(spark, folder)))
    return found.withColumn("volatility", round_to(F.col("volatility"), 6))


@query
def drawdown(spark, folder):
    return portfolio.running_drawdown(_history(spark, folder))


@query
def worst_drawdown(spark, folder):
    found = portfolio.running_drawdown(_history(spark, folder))
    return portfolio.worst_drawdown(found)


@query
def cagr(spark, folder):
    found = portfolio.cagr(_history(spark, folder))
    return found.withColumns(
        {"years": round_to(F.col("years"), 6), "cagr": round_to(F.col("cagr"), 6)}
    )


def _growth(spark, folder, end, target):
    return portfolio.growth_of_amount(
        _history(spark, folder), AMOUNT, 3, end, _pivot(spark, folder), target
    )


@query
def growth_of_amount(spark, folder):
    grown = _growth(spark, folder, newest_date(_history(spark, folder)), "EUR")
    return grown.withColumn("value", round2(F.col("value")))


@query
def growth_of_amount_usd(spark, folder):
    grown = _growth(spark, folder, newest_date(_history(spark, folder)), "USD")
    return grown.withColumn("value", round2(F.col("value")))


def _projection(spark, folder, start, years, target):
    """The newest bar's day counts as today."""
    history = _history(spark, folder)
    tickers = history.groupBy("ticker").agg(F.max("native_currency").alias("native_currency"))
    planned = portfolio.planned_amounts(tickers, AMOUNT, _pivot(spark, folder), target)
    starting = portfolio.starting_values(
        planned, _growth(spark, folder, start, target), start, newest_date(history)
    )
    schedule = portfolio.projection(portfolio.cagr(history), starting, years, start)
    return schedule.withColumns(
        {"month": F.col("month").cast("long"), "value": round2(F.col("value"))}
    )


@query
def projection(spark, folder):
    """From a past day: starts at the last historical value."""
    return _projection(spark, folder, F.lit(PROJECTION_START).cast("date"), 5, "EUR")


@query
def projection_usd(spark, folder):
    """From the day after the newest bar: starts at the converted amount."""
    tomorrow = F.date_add(newest_date(_history(spark, folder)), 1)
    return _projection(spark, folder, tomorrow, 3, "USD")


def _priced(spark, folder):
    lake = _published(spark, folder)
    newest = lake.mart("mart_52week_metrics")
    return portfolio.priced_holdings(
        lake.raw("holdings"), lake.raw("symbols"), newest, _pivot(spark, folder)
    )


@query
def holdings_value(spark, folder):
    valued = portfolio.holdings_value(_priced(spark, folder))
    return valued.withColumns(
        {c: round2(F.col(c)) for c in ("value_native", "value_eur", "value_home")}
    )


@query
def holdings_total(spark, folder):
    totals = portfolio.holdings_total(_priced(spark, folder))
    return totals.withColumn("total_invested", round2(F.col("total_invested")))


@query
def holdings_units(spark, folder):
    bought = portfolio.affordable_units(_priced(spark, folder))
    return bought.withColumns(
        {c: round_to(F.col(c), 4) for c in ("invested", "price", "current_value")}
    )


@query
def portfolio_risk(spark, folder):
    risk = portfolio.symbol_risk(_history(spark, folder))
    # two rows per symbol
    risk = broadcast_per_row(risk, _symbols(spark, folder), SYMBOL_BYTES)
    found = portfolio.portfolio_risk(_priced(spark, folder), risk)
    return found.withColumns(
        {
            "volatility": round_to(F.col("volatility"), 6),
            "total_invested": round2(F.col("total_invested")),
            "stress_value": round2(F.col("stress_value")),
        }
    )


@query
def tax_estimate(spark, folder):
    priced = _priced(spark, folder)
    valued = priced.select(
        "holder",
        "country",
        convert(F.col("cost"), F.col("source_rate"), F.col("target_rate")).alias("cost"),
        convert(
            F.col("units") * F.col("latest_close"),
            F.col("source_rate"),
            F.col("target_rate"),
        ).alias("value"),
    )
    taxed = portfolio.tax_estimate(valued)
    return taxed.withColumns(
        {c: round2(F.col(c)) for c in ("total_cost", "total_value", "gain")}
    )


# Streaming ----------------------------------------------------------------------


@query
def stream_upsert(spark, folder):
    """Two arrivals of bar files loaded by the file stream into a copy of the
    raw tables; the second run resumes from the first one's checkpoint."""
    lake = copy_lake(spark, lake_for(spark, folder), new_folder(spark, "stream"))
    landed = derive.new_batch(lake_for(spark, folder).raw("etf_data"))
    landing, work = f"{lake.root}/landing", f"{lake.root}/work"
    for arrival in (1, 2):
        landed.filter(F.col("seq") == arrival).write.mode("append").parquet(landing)
        load_landed_files(lake, landing, work, _loaded_at(), "2001-11-30")
    return _plain(lake.raw("etf_data"))
