from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quotelake.operators import loading, quality, reconcile
from quotelake.operators.upsert import update_by_key, update_where
from quotelake.sources.schemas import ETF_DATA, SYMBOL_FILE, SYMBOLS
from quotelake.streaming.bars import LANDED_BARS

D1, D2, D3 = date(2024, 1, 2), date(2024, 1, 3), date(2024, 1, 4)
OLD = datetime(2024, 1, 1, 21, 15)
RATE_SCHEMA = "id long, from_currency string, to_currency string, rate_date date, exchange_rate double"


@pytest.fixture(scope="module")
def symbols(spark):
    def symbol(i, currency, active=True):
        return (i, f"US{i:010d}", f"T{i}", f"N{i}", "ETF", "NYSE", currency, OLD, active)

    return spark.createDataFrame(
        [symbol(1, "USD"), symbol(2, "EUR"), symbol(3, "CHF"), symbol(4, "EUR", False)],
        SYMBOLS,
    )


@pytest.fixture(scope="module")
def rates(spark):
    return spark.createDataFrame(
        [(1, "USD", "EUR", D1, 0.5), (2, "USD", "EUR", D3, 0.0)], RATE_SCHEMA
    )


def now():
    return F.lit("2024-01-05 21:15:00").cast("timestamp_ntz")


def bar(i, symbol, day, price, eur=None):
    return (i, symbol, day, *[price] * 4, 10, *[eur] * 4, OLD)


@pytest.fixture(scope="module")
def current(spark):
    return spark.createDataFrame(
        [bar(1, 1, D1, 10.0, 4.0), bar(2, 1, D2, 11.0), bar(3, 2, D1, 20.0)], ETF_DATA
    )


def landed(spark, *entries):
    data = [(s, d, p, p, p, p, 5, seq) for s, d, p, seq in entries]
    return spark.createDataFrame(data, LANDED_BARS)


def test_upsert_updates_inserts_and_last_wins(spark, current, symbols, rates):
    batch = landed(
        spark, (1, D1, 12.0, 2), (1, D1, 99.0, 1), (1, D3, 13.0, 1), (2, D2, 21.0, 1)
    )
    after = loading.load_bars(current, batch, symbols, rates, now())
    found = {(r.symbol_id, r.date): r for r in after.collect()}
    assert len(found) == 5
    updated = found[1, D1]
    assert (updated.id, updated.close, updated.close_eur) == (1, 12.0, 6.0)
    assert updated.created_at == OLD
    assert found[1, D2].close == 11.0
    inserted = found[1, D3]
    assert inserted.close_eur == 0.0  # a stored rate of 0 is applied by the loader
    assert inserted.created_at == datetime(2024, 1, 5, 21, 15)
    assert found[2, D2].close_eur is None  # EUR-native loads without EUR prices
    assert sorted(r.id for r in found.values()) == [1, 2, 3, 4, 5]


def test_upsert_is_idempotent(spark, current, symbols, rates, rows):
    batch = landed(spark, (1, D1, 12.0, 1), (2, D3, 30.0, 1))
    once = loading.load_bars(current, batch, symbols, rates, now())
    twice = loading.load_bars(once, batch, symbols, rates, now())
    assert rows(once) == rows(twice)


def test_upsert_survives_many_copies_of_one_key(spark, current, symbols, rates):
    copies = spark.range(20000).select(
        F.lit(1).cast("long").alias("symbol_id"),
        F.lit(D2).alias("date"),
        *(F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")),
        F.lit(1).cast("long").alias("volume"),
        F.col("id").alias("seq"),
    )
    after = loading.load_bars(current, copies, symbols, rates, now())
    assert after.count() == 3
    assert after.filter(F.col("id") == 2).first().close == 19999.0


def test_zero_price_is_treated_as_missing(spark, symbols, rates, current):
    after = loading.load_bars(current, landed(spark, (1, D1, 0.0, 1)), symbols, rates, now())
    assert after.filter("id = 1").first().close_eur is None


def test_incremental_filter(spark, current):
    batch = landed(
        spark,
        (1, D2, 1.0, 1),
        (1, D3, 1.0, 1),
        (9, date(2021, 11, 30), 1.0, 1),
        (9, date(2021, 12, 1), 1.0, 1),
    )
    kept = {(r.symbol_id, r.date) for r in loading.only_newer(batch, current).collect()}
    assert kept == {(1, D3), (9, date(2021, 12, 1))}


def test_updates(spark, current, symbols, rates):
    changes = spark.createDataFrame(
        [(1, D1, 7.0, None), (8, D1, 1.0, 1.0)],
        "symbol_id long, date date, close_eur double, open_eur double",
    )
    after = update_by_key(current, changes, ["symbol_id", "date"], ["open_eur", "close_eur"])
    changed = after.filter("id = 1").first()
    assert after.count() == 3
    assert (changed.open_eur, changed.close_eur, changed.high_eur) == (None, 7.0, 4.0)

    native = {r.id: r.close_eur for r in loading.fill_native_eur(current, symbols).collect()}
    assert native == {1: 4.0, 2: None, 3: 20.0}

    full = {
        r.id: r.close_eur
        for r in loading.update_eur_prices(current, symbols, rates).collect()
    }
    assert full == {1: 5.0, 2: None, 3: None}

    unknown = update_where(current, F.col("close_eur") > 3, {"volume": F.lit(0).cast("long")})
    assert {r.id: r.volume for r in unknown.collect()} == {1: 0, 2: 10, 3: 10}


GOOD = [
    ("IE0000000001", "A.L", "Fund A", "ETF", "LSE", "EUR"),
    ("US0000000002", "B", "Fund B", "STOCK", "NYSE", "USD"),
]


def test_symbol_reload_is_all_or_nothing(spark):
    clean = spark.createDataFrame(GOOD, SYMBOL_FILE)
    loaded = loading.reload_symbols(clean, F.lit(1), now())
    assert sorted(r.id for r in loaded.collect()) == [1, 2]
    repeated = spark.createDataFrame([*GOOD, GOOD[0]], SYMBOL_FILE)
    assert loading.reload_symbols(repeated, F.lit(1), now()).count() == 0
    invalid = spark.createDataFrame(
        [GOOD[0], ("US0000000002", "B", "Fund B", "BOND", "NYSE", "USD")], SYMBOL_FILE
    )
    assert loading.reload_symbols(invalid, F.lit(1), now()).count() == 0
    problems = {(r.kind, r.item) for r in quality.file_problems(repeated).collect()}
    assert problems == {
        ("duplicate isin", "IE0000000001"),
        ("duplicate name", "Fund A"),
        ("duplicate ticker", "A.L"),
    }


def test_added_symbols_continue_the_ids(spark, symbols):
    landed_symbols = spark.createDataFrame(GOOD, SYMBOL_FILE)
    after = loading.add_symbols(symbols, landed_symbols, now())
    assert sorted(r.id for r in after.collect()) == [1, 2, 3, 4, 5, 6]


def test_reconcile(spark, rows):
    fields = ", ".join(f"{c} string" for c in SYMBOL_FILE.names) + ", seq int"
    landed_symbols = spark.createDataFrame(
        [
            (*GOOD[0], 1),
            (*GOOD[1], 1),
            ("US0000000002", "B", "Fund C", "STOCK", "NYSE", "USD", 2),
        ],
        fields,
    )
    stored = spark.createDataFrame(
        [GOOD[1], ("US0000000009", "Z", "Fund Z", "ETF", "NYSE", "USD")], SYMBOL_FILE
    )
    found = rows(reconcile.reconcile(landed_symbols, stored, "seq"))
    assert found == [
        ("IE0000000001", "missing_in_db", None, None),
        ("US0000000002", "name", "Fund C", "Fund B"),
        ("US0000000009", "extra_in_db", None, None),
    ]
    assert rows(reconcile.isins_only_in(landed_symbols, stored)) == [("IE0000000001",)]
    assert rows(reconcile.isins_in_both(landed_symbols, stored)) == [("US0000000002",)]


def test_repeated_change_adds_no_rows(spark):
    from quotelake.operators.upsert import update_by_key

    current = spark.createDataFrame([(1, 5.0), (2, 6.0)], "k long, v double")
    changes = spark.createDataFrame([(1, 7.0), (1, 8.0)], "k long, v double")
    assert sorted(map(tuple, update_by_key(current, changes, ["k"], ["v"]).collect())) == [(1, 8.0), (2, 6.0)]


def test_expected_symbol_without_bars_reports_no_data(spark):
    from datetime import date

    from quotelake.operators import quality

    bars = spark.createDataFrame(
        [(1, date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, 10)],
        "symbol_id long, date date, open double, high double, low double, close double, volume long",
    )
    expected = spark.createDataFrame([(1,), (2,), (2,)], "symbol_id long")
    rows = {r.symbol_id: r for r in quality.batch_report(bars, expected).collect()}
    assert rows[1].is_valid and rows[1].bars == 1
    assert rows[2].issues == ["No data received"] and not rows[2].is_valid and rows[2].bars == 0
