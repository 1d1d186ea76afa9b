from datetime import date

import pytest
from pyspark.sql import functions as F

from quotelake.functions import calendar, checks, currency
from quotelake.functions.numeric import exact_sum, pct, ratio, round2


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'date' if isinstance(v, date) else 'string' if isinstance(v, str) else 'double'}"
        for k, v in values.items()
    )
    source = spark.createDataFrame([tuple(values.values())], schema or "x int")
    return source.select(column.alias("v")).first().v


@pytest.mark.parametrize(
    "value, expected",
    [(1.005, 1.0), (0.285, 0.28), (2.675, 2.68), (-1.239, -1.24), (None, None)],
)
def test_round2_scales_first(spark, value, expected):
    assert one(spark, round2(F.col("x")), x=value) == expected


def test_division_by_zero_is_null(spark):
    assert one(spark, pct(F.col("a"), F.col("b")), a=5.0, b=0.0) is None
    assert one(spark, ratio(F.col("a"), F.col("b")), a=5.0, b=2.0) == 2.5


def test_exact_sum_ignores_order(spark):
    values = [0.1, 1e6, 0.2, -1e6, 0.3] * 50
    sums = {
        spark.createDataFrame([(v,) for v in order], "v double")
        .repartition(parts)
        .agg(exact_sum(F.col("v")).alias("s"))
        .first()
        .s
        for order in (values, values[::-1], sorted(values))
        for parts in (1, 3, 7)
    }
    assert sums == {30.0}


def test_convert_needs_both_rates(spark):
    column = currency.convert(F.col("v"), F.col("s"), F.col("t"))
    assert one(spark, column, v=10.0, s=0.5, t=2.0) == 2.5
    assert one(spark, column, v=10.0, s=None, t=2.0) == 10.0
    assert one(spark, column, v=10.0, s=0.5, t=None) == 10.0
    assert one(spark, column, v=None, s=0.5, t=2.0) is None


def test_convert_round_trips(spark):
    there = currency.convert(F.col("v"), F.col("s"), F.col("t"))
    back = currency.convert(there, F.col("t"), F.col("s"))
    assert one(spark, back, v=123.45, s=0.91, t=1.17) == pytest.approx(123.45)


def test_latest_ratio_and_stand_in(spark):
    column = currency.convert_at_latest_ratio(F.col("v"), F.col("c"), F.col("e"))
    assert one(spark, column, v=10.0, c=4.0, e=2.0) == 5.0
    assert one(spark, column, v=10.0, c=4.0, e=None) == 8.5
    assert one(spark, column, v=0.0, c=4.0, e=2.0) == 0.0


def test_money_text(spark):
    text = currency.money_text(F.col("v"), F.col("c"))
    assert one(spark, text, v=1234.5, c="EUR") == "€1,234.50"
    assert one(spark, text, v=1234.5, c="CHF") == "1,234.50"
    assert one(spark, text, v=None, c="USD") == "—"
    plain = currency.plain_money_text(F.col("v"), F.col("c"))
    assert one(spark, plain, v=1234.5, c="SEK") == "kr1234.50"
    assert one(spark, plain, v=None, c="SEK") == "N/A"
    assert one(spark, currency.signed_pct_text(F.col("v")), v=-3.25) == "-3.25%"
    assert one(spark, currency.signed_pct_text(F.col("v")), v=3.0) == "+3.00%"
    assert one(spark, currency.currency_symbol(F.col("c")), c="SEK") == "kr"
    assert one(spark, currency.currency_symbol(F.col("c")), c="JPY") == "JPY"
    assert one(spark, currency.country_currency(F.col("c")), c="France") == "EUR"
    assert one(spark, currency.country_currency(F.col("c")), c="Chile") == "USD"


@pytest.mark.parametrize(
    "start, months, expected",
    [
        (date(2023, 1, 31), 1, date(2023, 3, 3)),
        (date(2024, 1, 31), 1, date(2024, 3, 2)),
        (date(2023, 1, 31), 12, date(2024, 1, 31)),
        (date(2023, 11, 15), 2, date(2024, 1, 15)),
    ],
)
def test_month_step_runs_over(spark, start, months, expected):
    assert one(spark, calendar.month_step(F.col("d"), F.lit(months)), d=start) == expected


@pytest.mark.parametrize(
    "preset, expected",
    [
        ("1m", date(2024, 5, 16)),
        ("3m", date(2024, 3, 17)),
        ("1y", date(2023, 1, 1)),
        ("3y", date(2021, 1, 1)),
        ("other", date(2024, 5, 1)),
    ],
)
def test_calendar_presets(spark, preset, expected):
    column = calendar.calendar_start(preset, F.col("d"))
    assert one(spark, column, d=date(2024, 6, 15)) == expected


def test_preset_without_start(spark):
    assert (calendar.range_name("2y"), calendar.range_name("?")) == ("2 Years", "1 Month")
    assert calendar.calendar_start("all", F.col("d")) is None
    assert calendar.range_start("ALL", F.col("d")) is None
    assert one(spark, calendar.range_start("3M", F.col("d")), d=date(2024, 6, 15)) == date(
        2024, 3, 16
    )
    assert one(spark, calendar.display_date(F.col("d")), d=date(2024, 6, 5)) == "Jun 05, 2024"


GOOD = ("IE00B53SZB19", "AAA.L", "Fund A", "ETF", "LSE", "GBP")


@pytest.mark.parametrize(
    "changes, expected",
    [
        ({}, []),
        ({"isin": "ie00B53SZB19"}, [checks.ISIN_FORMAT_MESSAGE]),
        ({"isin": "IE00B53SZB1X"}, [checks.ISIN_FORMAT_MESSAGE]),
        ({"isin": "DE00B53SZB19"}, [checks.ISIN_COUNTRY_MESSAGE]),
        ({"exchange": "NYSE"}, [checks.IRISH_EXCHANGE_MESSAGE]),
        ({"isin": "US9229083632"}, [checks.US_EXCHANGE_MESSAGE]),
        ({"asset_type": "BOND"}, ["Invalid asset_type. Must be one of: ['ETF', 'STOCK']"]),
        ({"currency": "CHF"}, ["Invalid currency. Must be one of: ['USD', 'GBP', 'EUR']"]),
        (
            {"name": "", "ticker": None, "isin": "bad"},
            [
                "Missing or empty required field: ticker",
                "Missing or empty required field: name",
            ],
        ),
        (
            {"exchange": "XETRA"},
            [
                "Invalid exchange. Must be one of: ['LSE', 'NYSE', 'NASDAQ']",
                checks.IRISH_EXCHANGE_MESSAGE,
            ],
        ),
    ],
)
def test_symbol_errors(spark, changes, expected):
    values = dict(zip(checks.REQUIRED_FIELDS, GOOD)) | changes
    schema = ", ".join(f"{c} string" for c in checks.REQUIRED_FIELDS)
    df = spark.createDataFrame([tuple(values.values())], schema)
    assert df.select(checks.symbol_errors().alias("e")).first().e == expected
