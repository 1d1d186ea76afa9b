"""Series operators against brute force, with one series far longer than the
others, empty years and years with fewer rows than the look-back."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from quotelake.operators import series
from quotelake.operators.ids import HASH_DIGITS, number_rows
from quotelake.operators.latest import latest_per_key, top_n_per_key


def _series():
    """(ticker, date, value): HOT has most rows; GAPS skips years and has one or
    two rows in some; ONE has a single row."""
    rng = random.Random(7)
    data = []
    day = date(1999, 11, 20)
    for _ in range(2500):
        day += timedelta(days=rng.choice([1, 1, 1, 3]))
        data.append(("HOT", day, round(rng.uniform(50, 150), 2)))
    for text in (
        "2000-12-30 2001-06-01 2003-01-01 2003-12-31 2004-01-01 2004-01-02 "
        "2007-05-05 2008-05-05 2009-05-05 2009-05-06 2010-01-01 2010-01-02"
    ).split():
        data.append(("GAPS", date.fromisoformat(text), round(rng.uniform(1, 9), 2)))
    data.append(("ONE", date(2005, 5, 5), 4.0))
    return data


DATA = _series()


@pytest.fixture(scope="module")
def frame(spark):
    shuffled = DATA[:]
    random.Random(1).shuffle(shuffled)
    return spark.createDataFrame(shuffled, "ticker string, date date, v double").repartition(5)


def by_ticker():
    groups = {}
    for ticker, day, value in sorted(DATA):
        groups.setdefault(ticker, []).append((day, value))
    return groups


def as_map(df, column):
    return {(r.ticker, r.date): r[column] for r in df.collect()}


@pytest.mark.parametrize("width", [2, 7, 12])
def test_moving_average(frame, width):
    got = as_map(series.moving_average(frame, ["ticker"], "v", width, "avg"), "avg")
    assert len(got) == len(DATA)
    for ticker, points in by_ticker().items():
        for i, (day, _) in enumerate(points):
            window = [v for _, v in points[max(0, i - width + 1) : i + 1]]
            assert got[ticker, day] == pytest.approx(sum(window) / len(window), abs=1e-9)


def test_previous(frame):
    got = as_map(series.with_previous(frame, ["ticker"], "v", "prev"), "prev")
    for ticker, points in by_ticker().items():
        for i, (day, _) in enumerate(points):
            assert got[ticker, day] == (points[i - 1][1] if i else None)


def test_running_maximum(frame):
    got = as_map(series.carry_max(frame, ["ticker"], "v", "peak"), "peak")
    for ticker, points in by_ticker().items():
        peak = 0.0
        for day, value in points:
            peak = max(peak, value)
            assert got[ticker, day] == peak


def test_positions(frame):
    found = series.position_slice(
        frame, ["ticker"], F.lit(3), F.least(F.lit(700), F.col("_total") - 2)
    )
    got = as_map(found, "position")
    expected = {
        (ticker, day): i
        for ticker, points in by_ticker().items()
        for i, (day, _) in enumerate(points)
        if 3 <= i <= min(700, len(points) - 2)
    }
    assert got == expected


def test_no_window_spans_a_series(frame):
    """Row windows are partitioned by year as well as by key."""
    df = series.moving_average(frame, ["ticker"], "v", 7, "avg")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "avg(v" in plan and "_chunk" in plan


def test_latest_and_top(frame):
    newest = latest_per_key(frame, ["ticker"], "date", ["date", "v"])
    top = top_n_per_key(frame, ["ticker"], "date", 5)
    for ticker, points in by_ticker().items():
        assert (points[-1]) in [
            (r.date, r.v) for r in newest.filter(F.col("ticker") == ticker).collect()
        ]
        picked = sorted(r.date for r in top.filter(F.col("ticker") == ticker).collect())
        assert picked == [d for d, _ in points[-5:]]


def test_top_n_limits_before_the_shuffle(frame):
    plan = top_n_per_key(frame, ["ticker"], "date", 5)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_numbering_is_dense_and_repeatable(spark):
    keys = spark.range(3000).select((F.col("id") * 7).alias("k"))
    runs = [
        {
            r.k: r.id
            for r in number_rows(keys.repartition(n), ["k"], F.lit(101)).collect()
        }
        for n in (2, 9)
    ]
    assert runs[0] == runs[1]
    assert sorted(runs[0].values()) == list(range(101, 3101))
    assert HASH_DIGITS == 3


def test_series_summary_equals_window_operators(spark):
    import random
    from datetime import date, timedelta

    from quotelake.operators import portfolio
    from quotelake.operators.summary import series_summary

    rnd = random.Random(9)
    rows = []
    for ticker, n in (("HOT", 1500), ("A", 40), ("Z", 3), ("N", 5)):
        day, price = date(2019, 12, 20), 10.0
        for i in range(n):
            day += timedelta(days=rnd.choice([1, 1, 1, 3]))
            price = max(0.0, price * (1 + rnd.uniform(-0.08, 0.07)))
            close = None if rnd.random() < 0.05 or ticker == "N" else rnd.choice([price] * 20 + [0.0])
            rows.append((ticker, day, close))
    prices = spark.createDataFrame(rows, "ticker string, date date, close_eur double").repartition(5)
    got = {r.ticker: r for r in series_summary(prices, ["ticker"], "close_eur").collect()}
    vol = {r.ticker: r for r in portfolio.volatility(portfolio.daily_returns(prices)).collect()}
    dd = {r.ticker: r for r in portfolio.worst_drawdown(portfolio.running_drawdown(prices)).collect()}
    for ticker, row in got.items():
        if ticker in vol:
            assert row.returns == vol[ticker].returns
            assert abs(row.volatility - vol[ticker].volatility) < 1e-9
        else:
            assert row.returns is None and row.volatility is None
        if ticker in dd:
            assert abs(row.max_drawdown - dd[ticker].max_drawdown) < 1e-12
            assert row.drawdown_date == dd[ticker].drawdown_date
        else:
            assert row.max_drawdown == 0.0 and row.drawdown_date is None
