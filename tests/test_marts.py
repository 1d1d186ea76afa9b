from datetime import date

import pytest
from pyspark.sql import functions as F

from quotelake.operators import fx, quality
from quotelake.operators.metrics import entry_levels, metrics_52week, unpivot_levels
from quotelake.plans import marts
from quotelake.plans.staging import stage_fx

D = [date(2024, 1, d) for d in range(1, 13)]
STAGED = (
    "id long, symbol_id long, ticker string, etf_name string, isin string, "
    "exchange string, native_currency string, date date, open double, high double, "
    "low double, close double, volume long, open_eur double, high_eur double, "
    "low_eur double, close_eur double"
)
RATES = (
    "id long, from_currency string, to_currency string, rate_date date, "
    "exchange_rate double, created_at timestamp_ntz"
)


def staged(spark, *entries):
    data = [
        (i, 1, ticker, "F", "I", "X", currency, day, o, max(o, c), min(o, c), c, 1, e, e, e, e)
        for i, (ticker, currency, day, o, c, e) in enumerate(entries)
    ]
    return spark.createDataFrame(data, STAGED)


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame(
        [
            (1, "USD", "EUR", D[0], 0.5, None),
            (2, "USD", "EUR", D[9], 0.8, None),
            (3, "USD", "GBP", D[11], 9.0, None),
            (4, "USD", "EUR", D[5], 0.0, None),
        ],
        RATES,
    )


def test_eur_fallback_chain(spark, rates):
    source = staged(
        spark,
        ("LOADED", "USD", D[0], 10.0, 10.0, 7.0),
        ("SAMEDAY", "USD", D[0], 10.0, 10.0, None),
        ("NEWEST", "USD", D[2], 10.0, 10.0, None),  # newest rate, though later
        ("ZERO", "USD", D[5], 10.0, 10.0, None),  # a rate of 0 is not usable
        ("NORATE", "CHF", D[0], 10.0, 10.0, None),  # keeps the native price
        ("NULLCCY", None, D[0], 10.0, 10.0, None),
        ("EURO", "EUR", D[0], 10.0, 10.0, None),
    )
    found = marts.eur_prices(source, stage_fx(rates))
    assert {r.ticker: r.close_eur for r in found.collect()} == {
        "LOADED": 7.0,
        "SAMEDAY": 5.0,
        "NEWEST": 8.0,
        "ZERO": 8.0,
        "NORATE": 10.0,
        "NULLCCY": 10.0,
        "EURO": 10.0,
    }
    uncovered = quality.uncovered_currencies(source, stage_fx(rates)).collect()
    assert [(r.native_currency, r.rows_without_rate) for r in uncovered] == [("CHF", 1)]


def test_history_daily_change_and_average(spark):
    source = staged(
        spark,
        ("A", "EUR", D[0], 0.0, 5.0, 5.0),
        *[("A", "EUR", D[i], 10.0, 10.0 + i, float(i)) for i in range(1, 9)],
    )
    found = {r.date: r for r in marts.price_history(source).collect()}
    first = found[D[0]]
    assert (first.daily_change, first.daily_change_pct) == (5.0, None)
    assert first.close_eur_7d_avg == 5.0  # partial at the start
    assert found[D[1]].daily_change == 1.0  # same day, not day over day
    assert found[D[1]].daily_change_pct == 10.0
    assert found[D[8]].close_eur_7d_avg == 5.0  # mean of 2..8: seven rows


def test_metrics_take_the_earliest_of_tied_dates(spark):
    bars = spark.createDataFrame(
        [
            (1, date(2023, 1, 1), 99.0, 1.0),  # outside the window
            (1, D[3], 20.0, 5.0),
            (1, D[1], 20.0, 5.0),
            (1, D[2], None, None),
            (2, date(2020, 1, 1), 5.0, 4.0),
        ],
        "symbol_id long, date date, high double, low double",
    )
    found = metrics_52week(bars, F.lit(date(2024, 1, 12))).collect()
    assert len(found) == 1
    r = found[0]
    assert (r.high_52week, r.low_52week, r.high_date, r.low_date) == (20.0, 5.0, D[1], D[1])
    edge = metrics_52week(bars, F.lit(date(2024, 1, 1))).collect()
    assert edge[0].high_52week == 99.0  # 365 days back, inclusive


def test_levels(spark):
    metrics = spark.createDataFrame([(1, D[0], 100.1)], "symbol_id long, calculation_date date, high_52week double")
    wide = entry_levels(metrics)
    assert wide.first().decrease_5_price == 100.1 * 0.95
    long = unpivot_levels(wide, ["symbol_id"])
    assert [r.pct_below for r in long.orderBy("pct_below").collect()] == [5, 10, 15, 20, 25, 30]
    old = unpivot_levels(wide.drop("decrease_5_price"), ["symbol_id"])
    assert old.count() == 5


def test_thresholds_without_price(spark):
    metrics = spark.createDataFrame([(1, D[0], 100.0)], "symbol_id long, calculation_date date, high_52week double")
    symbols = spark.createDataFrame(
        [(1, "I", "T", "N", "ETF", "X", "USD", True)],
        "id long, isin string, ticker string, name string, asset_type string, exchange string, currency string, is_active boolean",
    )
    none = spark.createDataFrame(
        [],
        "ticker string, latest_price_date date, latest_close double, latest_close_eur double, daily_change_eur_pct double",
    )
    found = marts.entry_thresholds(entry_levels(metrics), symbols, none).collect()
    assert len(found) == 6
    assert {r.is_at_or_below_threshold for r in found} == {False}
    assert {r.gap_to_threshold for r in found} == {None}


def test_pivot_rates(spark, rates, rows):
    pivot = fx.pivot_rates(marts.fx_rates(stage_fx(rates)))
    assert rows(pivot) == [("EUR", 1.0), ("USD", 0.8)]
    prices = spark.createDataFrame(
        [
            ("A", "USD", D[0], 10.0, 9.0),
            ("A", "USD", D[1], 10.0, 5.0),
            ("A", "USD", D[2], 10.0, None),
            ("B", "CHF", D[1], 0.0, 5.0),
        ],
        "ticker string, native_currency string, date date, close double, close_eur double",
    )
    assert rows(fx.implied_rates(prices)) == [("EUR", 1.0), ("USD", 0.5)]
    empty = spark.createDataFrame([], marts.fx_rates(stage_fx(rates)).schema)
    assert rows(fx.rates_to_eur(empty, prices)) == [("EUR", 1.0), ("USD", 0.5)]


def test_bad_batch(spark):
    prices = [10.0, 10.5, 20.0, -1.0, 10.0]
    volumes = [0, 0, 0, 5, 5]
    bars = spark.createDataFrame(
        [(1, D[i], p, 20.0, 1.0, p, v) for i, (p, v) in enumerate(zip(prices, volumes))]
        + [(2, D[i], 5.0, 5.0, 5.0, 5.0, 1) for i in range(3)]
        + [(3, D[0], None, 5.0, 5.0, 5.0, 1)],
        "symbol_id long, date date, open double, high double, low double, close double, volume long",
    )
    report = {r.symbol_id: r for r in quality.batch_report(bars).collect()}
    assert report[1].issues == [
        "Found 1 negative prices in Open",
        "Found 1 negative prices in Close",
        "Found 3 extreme price movements (>50%)",
        "High number of zero volume days: 3",
    ]
    assert report[2].is_valid and report[2].issues == []
    assert report[3].issues == ["Missing 1 values in Open"]
    kept = quality.accepted(bars, quality.batch_report(bars))
    assert {r.symbol_id for r in kept.collect()} == {2}
