from datetime import date

import pytest
from pyspark.sql import functions as F

from quotelake.operators import portfolio, reports

D = [date(2024, 1, d) for d in range(1, 31)]


def history(spark, **series):
    data = [
        (t, D[i], v, v) for t, values in series.items() for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, "ticker string, date date, close double, close_eur double")


def test_drawdown(spark):
    prices = history(spark, DROP=[100.0, 120.0, None, 60.0, 90.0, 60.0], FLAT=[5.0, 5.0])
    found = {
        r.ticker: r
        for r in portfolio.worst_drawdown(portfolio.running_drawdown(prices)).collect()
    }
    assert (found["DROP"].max_drawdown, found["DROP"].drawdown_date) == (-0.5, D[3])
    assert found["DROP"].drawdown_year == 2024
    assert (found["FLAT"].max_drawdown, found["FLAT"].drawdown_date) == (0.0, None)


def test_returns_skip_unusable_rows(spark):
    prices = history(spark, A=[100.0, 110.0, None, 120.0, 0.0, 60.0, 66.0])
    found = {r.date: r.daily_return for r in portfolio.daily_returns(prices).collect()}
    assert found == {D[1]: pytest.approx(0.1), D[6]: pytest.approx(0.1)}
    vol = portfolio.volatility(portfolio.daily_returns(prices)).first()
    assert (vol.returns, vol.volatility) == (2, pytest.approx(0.0))


@pytest.mark.parametrize(
    "first, last, expected",
    [(100.0, 110.0, 0.10), (100.0, 50.0, 0.0), (100.0, 900.0, 0.30), (0.0, 9.0, 0.10)],
)
def test_cagr_limits(spark, first, last, expected):
    prices = spark.createDataFrame(
        [("A", date(2020, 1, 1), first), ("A", date(2021, 1, 1), last)],
        "ticker string, date date, close_eur double",
    )
    assert portfolio.cagr(prices).first().cagr == pytest.approx(expected, abs=1e-3)


def test_cagr_of_one_row_is_the_fallback(spark):
    assert portfolio.cagr(history(spark, A=[5.0])).first().cagr == 0.10


def test_projection(spark):
    growth = spark.createDataFrame([("A", 0.24)], "ticker string, cagr double")
    starting = spark.createDataFrame([("A", 100.0)], "ticker string, start_value double")
    found = portfolio.projection(growth, starting, 1, F.lit(date(2023, 1, 31)))
    assert found.count() == 4 * 13
    month = {
        r.scenario: r for r in found.filter("month = 1").collect()
    }
    assert month["historical"].value == pytest.approx(102.0)
    assert month["aggressive"].date == date(2023, 3, 3)


def test_growth_starts_at_the_amount(spark):
    prices = history(spark, A=[50.0, 100.0, 0.0]).withColumn("native_currency", F.lit("EUR"))
    found = portfolio.growth_of_amount(prices, 1000.0, 1, F.lit(D[5]), pivot(spark))
    assert [r.value for r in found.orderBy("date").collect()] == [1000.0, 2000.0, 0.0]


def pivot(spark):
    return spark.createDataFrame([("EUR", 1.0), ("USD", 0.5)], "currency string, rate_to_eur double")


@pytest.mark.parametrize("own, target, invested", [("USD", "EUR", 500.0), ("EUR", "USD", 2000.0), ("USD", "USD", 1000.0), ("CHF", "USD", 1000.0)])
def test_growth_converts_the_amount(spark, own, target, invested):
    prices = history(spark, A=[50.0, 100.0]).withColumn("native_currency", F.lit(own))
    found = portfolio.growth_of_amount(prices, 1000.0, 1, F.lit(D[5]), pivot(spark), target)
    assert [r.value for r in found.orderBy("date").collect()] == [invested, 2 * invested]


def test_projection_starts_at_the_last_value_unless_in_the_future(spark):
    tickers = spark.createDataFrame([("A", "USD"), ("NONE", "USD")], "ticker string, native_currency string")
    planned = portfolio.planned_amounts(tickers, 1000.0, pivot(spark))
    grown = spark.createDataFrame([("A", D[1], 7.0), ("A", D[0], 9.0)], "ticker string, date date, value double")

    def starts(start):
        found = portfolio.starting_values(planned, grown, F.lit(start), F.lit(D[3]))
        return {r.ticker: r.start_value for r in found.collect()}

    assert starts(D[3]) == {"A": 7.0, "NONE": 500.0}
    assert starts(D[4]) == {"A": 500.0, "NONE": 500.0}


def test_rows_are_shown_in_order(spark):
    rows = [("b", D[0]), ("a", D[0]), ("a", D[2])]
    found = reports.shown(spark.createDataFrame(rows, "name string, calculation_date date"), "metric_history")
    assert [tuple(r) for r in found.collect()] == [("a", D[2]), ("a", D[0]), ("b", D[0])]


def test_pivot_keeps_its_range(spark):
    prices = history(spark, A=[1.0, 2.0, 3.0, 4.0])
    found = reports.price_pivot(prices, ["A", "B"], D[1], D[2]).collect()
    assert sorted((r.A, r.B) for r in found) == [(2.0, None), (3.0, None)]


def test_portfolio_risk_has_one_worst_symbol(spark):
    priced = spark.createDataFrame(
        [
            (1, 1, "A", "USA", 300.0, 0.5, 0.5),
            (1, 2, "B", "USA", 100.0, 0.5, 0.5),
            (2, 2, "B", "Germany", 50.0, 0.5, 1.0),
        ],
        "holder long, symbol_id long, ticker string, country string, cost double, "
        "source_rate double, target_rate double",
    )
    risk = spark.createDataFrame(
        [
            ("A", False, -0.2, 2020, 0.1),
            ("B", False, -0.5, 2022, 0.5),
            ("B", True, -0.4, 2021, 0.3),
        ],
        "ticker string, in_eur boolean, max_drawdown double, drawdown_year int, volatility double",
    )
    found = {r.holder: r for r in portfolio.portfolio_risk(priced, risk).collect()}
    assert found[1].volatility == pytest.approx(0.2)
    assert (found[1].worst_drawdown, found[1].worst_year) == (-0.5, 2022)
    assert found[1].total_invested == pytest.approx(400.0)
    assert found[1].stress_value == pytest.approx(280.0)
    assert found[2].total_invested == pytest.approx(25.0)
    assert (found[2].volatility, found[2].worst_year) == (pytest.approx(0.3), 2021)


def test_risk_uses_both_prices(spark):
    prices = spark.createDataFrame(
        [("A", "2024-01-01", 100.0, 10.0), ("A", "2024-01-02", 50.0, 9.0)],
        "ticker string, date string, close double, close_eur double",
    ).selectExpr("ticker", "cast(date AS date) AS date", "close", "close_eur")
    found = {r.in_eur: r.max_drawdown for r in portfolio.symbol_risk(prices).collect()}
    assert found == {True: pytest.approx(-0.1), False: pytest.approx(-0.5)}


def test_tax(spark):
    valued = spark.createDataFrame(
        [
            (1, "USA", 100.0, 200.0),
            (2, "Australia", 100.0, 200.0),
            (3, "Germany", 100.0, 50.0),
            (4, "France", 100.0, 110.0),
        ],
        "holder long, country string, cost double, value double",
    )
    found = {r.holder: r.tax for r in portfolio.tax_estimate(valued).collect()}
    assert found == {1: 15.0, 2: 10.0, 3: 0.0, 4: 3.0}


def test_index_starts_at_100(spark):
    prices = history(spark, A=[4.0, 5.0, 2.0], B=[10.0, 10.0])
    found = {(r.ticker, r.date): r.indexed for r in reports.indexed_to_100(prices).collect()}
    assert found["A", D[0]] == found["B", D[0]] == 100.0
    assert found["A", D[2]] == 50.0


def test_presets_end_at_the_newest_date_of_all(spark):
    prices = spark.createDataFrame(
        [("A", date(2024, 6, 30), 1.0), ("A", date(2024, 5, 31), 1.0), ("B", date(2024, 5, 30), 1.0)],
        "ticker string, date date, close_eur double",
    )
    kept = {(r.ticker, r.date.day) for r in reports.in_preset(prices, "1M").collect()}
    assert kept == {("A", 30), ("A", 31)}
    assert reports.in_preset(prices, "ALL").count() == 3


def slice_of(total, slider, rows=50):
    """The rule written out for one series."""
    width = min(rows, total)
    start = max(0, int(slider / 100 * (total - 1)) - width // 2)
    end = min(total - 1, start + width)
    if end == total - 1:
        start = max(0, end - width + 1)
    return list(range(start, end + 1))


@pytest.mark.parametrize("slider", [0, 37, 60, 100])
def test_row_slice(spark, slider):
    days = spark.range(1, 1200).select(
        F.lit("A").alias("ticker"),
        F.date_add(F.lit(date(2020, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.col("id").cast("double").alias("close_eur"),
    )
    short = days.filter("close_eur <= 20").withColumn("ticker", F.lit("B"))
    found = reports.row_slice(days.union(short), slider)
    for ticker, total in (("A", 1199), ("B", 20)):
        got = sorted(r.position for r in found.filter(F.col("ticker") == ticker).collect())
        assert got == slice_of(total, slider)


def test_thresholds_reached(spark):
    bars = spark.createDataFrame(
        [(1, D[0], 100.0, 50.0), (1, D[1], 89.0, 44.5), (1, D[2], 79.0, 39.5), (1, D[3], 98.0, 49.0)],
        "symbol_id long, date date, close double, close_eur double",
    )
    levels = {n: 100.0 * (1 - n / 100) for n in (5, 10, 15, 20, 25, 30)}
    wide = spark.createDataFrame(
        [(1, *levels.values())],
        "symbol_id long, " + ", ".join(f"decrease_{n}_price double" for n in levels),
    )
    for in_eur in (True, False):
        found = {
            r.pct_below: r.reached_date
            for r in reports.thresholds_reached(bars, wide, in_eur).collect()
        }
        assert found == {5: D[1], 10: D[1], 15: D[2], 20: D[2], 25: None, 30: None}


def test_current_price_fallbacks(spark):
    bars = spark.createDataFrame(
        [(1, D[0], 9.0, 8.0), (1, D[1], 10.0, None), (2, D[0], 0.0, 3.0)],
        "symbol_id long, date date, close double, close_eur double",
    )
    found = {r.symbol_id: r for r in reports.current_price(bars).collect()}
    assert (found[1].price, found[1].price_eur, found[1].price_eur_or_zero) == (10.0, 10.0, 10.0)
    assert (found[2].price, found[2].price_or_zero) == (0.0, 3.0)


def test_distance_is_negative_or_zero(spark):
    week52 = spark.createDataFrame(
        [("A", "FA", "EUR", 10.0, 5.0, 8.0, 20.0), ("B", "FB", "EUR", 10.0, 5.0, None, None)],
        "ticker string, etf_name string, native_currency string, high_52week double, "
        "low_52week double, latest_close double, pct_below_52w_high double",
    )
    rates = spark.createDataFrame(
        [("EUR", 1.0), ("USD", 0.5)], "currency string, rate_to_eur double"
    )
    found = {r.ticker: r for r in reports.summary_in_currency(week52, rates, "USD").collect()}
    assert (found["A"].distance, found["A"].high_52week) == (-20.0, 20.0)
    assert (found["A"].distance_text, found["A"].current_text) == ("-20.00%", "$16.00")
    assert (found["B"].distance, found["B"].current_text) == (0.0, "—")
    unknown = reports.summary_in_currency(week52, rates, "SEK").filter("ticker = 'A'")
    assert unknown.first().high_52week == 10.0


def test_unknown_currency_leaves_eur(spark):
    rates = spark.createDataFrame(
        [("EUR", 1.0), ("USD", 0.5)], "currency string, rate_to_eur double"
    )
    prices = history(spark, A=[4.0])
    assert reports.price_in_currency(prices, rates, "USD").first().price == 8.0
    assert reports.price_in_currency(prices, rates, "SEK").first().price == 4.0


def test_coverage_counts_symbols_without_bars(spark):
    symbols = spark.createDataFrame(
        [(1, "N1", "T1", "USD"), (2, "N2", "T2", "USD")],
        "id long, name string, ticker string, currency string",
    )
    bars = spark.createDataFrame(
        [(10, 1, 5.0), (11, 1, None)], "id long, symbol_id long, open_eur double"
    )
    found = {
        r.id: (r.total_records, r.with_eur_records, r.null_eur_records)
        for r in reports.eur_coverage(bars, symbols).collect()
    }
    assert found == {1: (2, 1, 1), 2: (0, 0, 1)}


def test_recent_bars_stand_in_for_an_empty_range(spark):
    days = spark.range(150).select(
        F.lit("OLD").alias("ticker"),
        F.date_add(F.lit(date(2023, 1, 1)), F.col("id").cast("int")).alias("date"),
        F.lit(1.0).alias("close"),
        F.lit(1.0).alias("close_eur"),
    )
    prices = days.unionByName(history(spark, NEW=[1.0, 2.0]))
    shown = reports.or_recent(reports.in_preset(prices, "1M"), prices)
    counts = {r.ticker: r["count"] for r in shown.groupBy("ticker").count().collect()}
    assert counts == {"OLD": 100, "NEW": 2}
