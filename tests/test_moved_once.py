"""Large tables are moved once, unsorted, on their way into storage and reports."""

import math
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quotelake.operators import portfolio
from quotelake.operators.summary import series_summaries, series_summary
from quotelake.plans import documents
from quotelake.sources import derive, files, lake as lakes
from quotelake.sources.lake import build_raw, lake_for, raw_lake

LINES = [
    # order, part, supplier, line, quantity, price, day
    (5, 1, 1, 1, 3.0, 1000.0, datetime(1996, 3, 1, 9)),
    (2, 1, 1, 2, 2.0, 3000.0, datetime(1996, 3, 1, 17)),
    (2, 1, 1, 2, 2.0, 3000.0, datetime(1996, 3, 1, 17)),
    (9, 1, 1, 1, 1.0, None, datetime(1996, 3, 1, 8)),
    (2, 7, 1, 3, 4.0, 500.0, datetime(1996, 4, 2)),
    (5, 1, 2, 1, 5.0, 800.0, None),
    (9, 2, None, 1, 6.0, 900.0, datetime(1996, 3, 1)),
]


@pytest.fixture(scope="module")
def small_folder(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("rows"))
    tables = {
        "region": ([(1, "EUROPE"), (2, "AMERICA")], "r_regionkey int, r_name string"),
        "nation": ([(1, "A", 1), (2, "B", 2)], "n_nationkey int, n_name string, n_regionkey int"),
        "supplier": ([(1, "S1", 1, 0.0), (2, "S2", 2, 0.0), (2, "S2", 2, 0.0)],
                     "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        "customer": ([(1, 1), (1, 1), (2, None), (3, 2)], "c_custkey long, c_nationkey int"),
        "orders": ([(2, 1, 9e5, datetime(1996, 3, 1)), (5, 2, 9e5, datetime(1996, 3, 1)), (9, 8, 9e5, datetime(1996, 3, 1))],
                   "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"),
        "lineitem": (LINES, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                            "l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{where}/{name}.parquet")
    return where


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bars_are_moved_once_in_stored_order(spark, small_folder):
    lake = raw_lake(spark, small_folder)
    bars = derive.etf_data(spark, small_folder, lake.raw("symbols"), lake.raw("currency_rates"))
    plan = plan_of(bars.sortWithinPartitions("month", "symbol_id", "date"))
    assert plan.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in plan
    assert plan.count("Sort [") == 1


def test_bars_of_repeated_and_null_rows(spark, small_folder):
    lake = raw_lake(spark, small_folder)
    found = {
        (r.symbol_id, r.date): (r.open, r.high, r.low, r.close, r.volume)
        for r in lake.raw("etf_data").collect()
    }
    assert found == {
        (1, date(1996, 3, 1)): (61.5, 61.5, 60.5, None, 8),
        (1, date(1996, 4, 2)): (60.25, 60.25, 60.25, 60.25, 4),
        (2, None): (60.4, 60.4, 60.4, 60.4, 5),
        (None, date(1996, 3, 1)): (60.45, 60.45, 60.45, 60.45, 6),
    }
    # a supplier listed twice gives its bars twice, as before
    assert lake.raw("etf_data").filter("symbol_id = 2").count() == 2


def test_a_read_builds_only_what_it_needs(spark, small_folder):
    lake = raw_lake(spark, small_folder)
    lake.raw("etf_data").count()
    assert set(lake.pending) == {
        "symbol_state", "fifty_two_week_metrics", "decrease_thresholds", "holdings"
    }
    assert not os.path.exists(f"{lake.root}/holdings")
    assert not build_raw(spark, small_folder).pending


def test_a_failed_build_is_tried_again(spark, small_folder, monkeypatch):
    lake = raw_lake(spark, small_folder)

    def fails(*args):
        raise OSError("disk")

    with monkeypatch.context() as broken:
        broken.setattr(derive, "holdings", fails)
        with pytest.raises(OSError):
            lake.raw("holdings")
    assert lake.raw("holdings").count() > 0


def test_holdings_of_repeated_customers(spark, small_folder):
    found = derive.holdings(spark, small_folder)
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    assert rows == sorted(
        [
            (1, 1, "Australia", 8, 2 * 2 * 61.5 + 4 * 60.25),
            (1, 1, "Australia", 8, 2 * 2 * 61.5 + 4 * 60.25),
            # a customer without nation counts as the last country
            (2, 1, "France", 3, 3 * 60.5),
            (2, 2, "France", 5, 5 * 60.4),
        ],
        key=repr,
    )
    plan = plan_of(found)
    # the holdings themselves join nothing any more
    assert plan.index("HashAggregate(keys=[holder") < plan.index("Join")


def test_publish_moves_prices_once(spark, folder, monkeypatch):
    source = lake_for(spark, folder)
    target = lakes.Lake(spark, source.root, f"{source.root}/moved-once")
    seen = {}
    real = lakes.write_dated

    def spy(df, path, *layout, **options):
        seen[path.rsplit("/", 1)[1]] = (df, options)
        real(df, path, *layout, **options)

    monkeypatch.setattr(lakes, "write_dated", spy)
    target.publish()
    df, options = seen["mart_price_history"]
    assert options == {"in_layout": True}
    plan = plan_of(df)
    assert plan.count("Exchange rangepartitioning(ticker") == 1
    assert "Exchange hashpartitioning(ticker" not in plan
    stored = target.mart("mart_price_history")
    assert stored.select("month").distinct().count() > 80
    plain = source.price_history()
    assert stored.select(*plain.columns).exceptAll(plain).count() == 0
    assert stored.count() == plain.count()


def test_documents_move_rows_and_are_compressed(spark, folder, tmp_path):
    lake = lake_for(spark, folder)
    names = ("etf_data", "symbols", "fifty_two_week_metrics", "decrease_thresholds")
    built = documents.symbol_documents(*map(lake.raw, names), F.lit("2002-01-01").cast("timestamp_ntz"))
    plan = plan_of(built)
    gathered = plan.index("partial_collect_list(struct(date")
    assert plan.index("Exchange hashpartitioning(symbol_id", gathered) > gathered
    path = str(tmp_path / "documents")
    files.write_documents(built, path)
    parts = [f for _, _, found in os.walk(path) for f in found if f.startswith("part-")]
    assert parts and all(f.endswith(".json.gz") for f in parts)
    assert files.read_documents(spark, path).count() == built.count()


def test_symbol_side_of_holdings_is_broadcast(spark, tmp_path):
    symbols = [(i, f"T{i}", "USD") for i in range(50)]
    newest = [(f"T{i}", 2.0, 1.0) for i in range(50)]
    held = [(1, i, "USA", 1, 5.0) for i in range(50)]
    for name, rows, schema in (
        ("symbols", symbols, "id long, ticker string, currency string"),
        ("newest", newest, "ticker string, latest_close double, latest_close_eur double"),
        ("held", held, "holder long, symbol_id long, country string, units long, cost double"),
        ("rates", [("USD", 0.5)], "currency string, rate_to_eur double"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    read = {n: spark.read.parquet(f"{tmp_path}/{n}") for n in ("held", "symbols", "newest", "rates")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        priced = portfolio.priced_holdings(*read.values())
        first = next(x for x in plan_of(priced).splitlines() if "Join" in x)
        assert "BroadcastHashJoin [symbol_id" in first
        assert priced.count() == 50
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_both_series_in_one_pass(spark):
    rows = [
        ("A", date(2019, 12, 30), 10.0, 5.0), ("A", date(2019, 12, 31), 8.0, None),
        ("A", date(2020, 1, 2), 4.0, 6.0), ("A", date(2020, 1, 3), None, 3.0),
        ("A", date(2022, 1, 3), 5.0, 0.0), (None, date(2020, 1, 1), 2.0, 2.0),
        ("B", None, 9.0, 9.0),
    ]
    prices = spark.createDataFrame(rows, "ticker string, date date, close double, close_eur double")
    df = series_summaries(prices, ["ticker"], ["close", "close_eur"])
    # returns: -0.2, -0.5 across the year's end; 5.0 follows a null
    r = {x.ticker: x for x in df.collect()}
    assert set(r) == {"A", None}
    assert r["A"].close.returns == 2
    assert r["A"].close.volatility == pytest.approx(0.15 * math.sqrt(252))
    assert (r["A"].close.max_drawdown, r["A"].close.drawdown_date) == (-0.6, date(2020, 1, 2))
    # the previous close of 6.0 is null, so only 3.0 after 6.0 counts; zero gives a fall, no return
    assert r["A"].close_eur.returns == 1
    assert (r["A"].close_eur.max_drawdown, r["A"].close_eur.drawdown_year) == (-1.0, 2022)
    one = series_summary(prices, ["ticker"], "close_eur").filter("ticker = 'A'").first()
    assert one.asDict() == {"ticker": "A", **r["A"].close_eur.asDict()}
    assert "aggregate(" not in plan_of(df)
