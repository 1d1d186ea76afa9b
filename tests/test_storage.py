"""Files, documents, stored tables and the file stream."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from quotelake.operators.sizing import broadcast_if_small
from quotelake.operators import state
from quotelake.plans import documents, refresh
from quotelake.sources import files
from quotelake.sources.lake import Lake, lake_for
from quotelake.sources.schemas import (
    CURRENCY_RATES,
    ETF_DATA,
    METRICS,
    MART_FX_RATES,
    SYMBOLS,
    THRESHOLDS,
)
from quotelake.sources.storage import MONTH, in_dates, read_optional, settle, shared_folder
from quotelake.streaming.bars import LANDED_BARS, load_landed_files

OLD = datetime(2024, 1, 1, 21, 15)
AS_OF = "2024-01-31"


def now():
    return F.lit("2024-01-05 21:15:00").cast("timestamp_ntz")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_csv_requires_six_columns(spark, tmp_path):
    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text("isin,ticker,name,asset_type,exchange,currency,extra\nI,T,N,ETF,LSE,EUR,1\n")
    bad.write_text("isin,ticker,name\nI,T,N\n")
    assert files.read_symbol_csv(spark, str(good)).collect()[0].currency == "EUR"
    with pytest.raises(ValueError, match="asset_type"):
        files.read_symbol_csv(spark, str(bad))


def test_optional_table(spark, tmp_path):
    missing = read_optional(spark, str(tmp_path / "none"), MART_FX_RATES)
    assert missing.isEmpty() and missing.schema == MART_FX_RATES


def test_settle_runs_once(spark, tmp_path):
    path = str(tmp_path / "step")
    settle(spark.range(3), path)
    again = settle(spark.range(99), path)  # the finished step is reused
    assert again.count() == 3


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_date_filters_prune_months_and_reach_the_scan(spark, folder):
    bars = lake_for(spark, folder).raw("etf_data")
    plan = plan_of(in_dates(bars, "date", "1998-01-01", "1998-06-30").select("close"))
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "GreaterThanOrEqual(date,1998-01-01)" in plan
    scan = plan.split("ReadSchema: ")[1]
    assert scan.startswith("struct<date:date,close:double>")


def test_broadcast_needs_a_small_plan(spark):
    small, large = spark.range(10), spark.range(10_000_000)
    side = large.join(broadcast_if_small(small, 1000), "id")
    assert "BroadcastHashJoin" in plan_of(side)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in plan_of(small.join(broadcast_if_small(large), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def lake(spark, tmp_path):
    """Small stored tables: symbols 1 (USD) and 2 (EUR)."""
    lake = Lake(spark, str(tmp_path / "lake"))
    symbols = [
        (i, f"US{i:010d}", f"T{i}.L", f"N{i}", "ETF", "NYSE", c, OLD, True)
        for i, c in ((1, "USD"), (2, "EUR"))
    ]
    bars = [
        (i, s, day, *[10.0] * 4, 5, *[None] * 4, OLD)
        for i, (s, day) in enumerate(
            [(1, date(2023, 6, 1)), (1, date(2024, 1, 2)), (2, date(2024, 1, 2))], 1
        )
    ]
    rates = [(1, "USD", "EUR", date(2024, 1, 3), 0.5, OLD)]
    lake.write("symbols", spark.createDataFrame(symbols, SYMBOLS))
    lake.write("etf_data", spark.createDataFrame(bars, ETF_DATA))
    lake.write("currency_rates", spark.createDataFrame(rates, CURRENCY_RATES))
    lake.write("fifty_two_week_metrics", spark.createDataFrame([], METRICS))
    lake.write("decrease_thresholds", spark.createDataFrame([], THRESHOLDS))
    lake.write("symbol_state", state.month_state(lake.raw("etf_data")))
    return lake


def land(spark, lake, *entries):
    data = [(s, d, p, p, p, p, 7, seq) for s, d, p, seq in entries]
    spark.createDataFrame(data, LANDED_BARS).write.mode("append").parquet(
        f"{lake.root}/landing"
    )


def closes(lake):
    return {(r.symbol_id, r.date.isoformat()): r.close for r in lake.raw("etf_data").collect()}


def test_stream_loads_each_file_once(spark, lake):
    landing, work = f"{lake.root}/landing", f"{lake.root}/work"
    jan2, jan3 = date(2024, 1, 2), date(2024, 1, 3)
    # symbol 2 fails the gate (a fall of more than half) and is left out alone
    land(spark, lake, (1, jan2, 11.0, 1), (1, jan3, 12.0, 1), (2, jan2, 10.0, 1), (2, jan3, 1.0, 1))
    load_landed_files(lake, landing, work, now(), AS_OF)
    expected = {
        (1, "2023-06-01"): 10.0,
        (1, "2024-01-02"): 11.0,
        (1, "2024-01-03"): 12.0,
        (2, "2024-01-02"): 10.0,
    }
    assert closes(lake) == expected
    metrics = {r.symbol_id: r.high_52week for r in lake.raw("fifty_two_week_metrics").collect()}
    assert metrics == {1: 12.0}
    levels = lake.raw("decrease_thresholds").first()
    assert (levels.high_52week_price, levels.decrease_10_price) == (12.0, 12.0 * 0.90)

    load_landed_files(lake, landing, work, now(), AS_OF)  # nothing new
    assert closes(lake) == expected

    land(spark, lake, (1, jan3, 13.0, 2))
    load_landed_files(lake, landing, work, now(), AS_OF)
    assert closes(lake) == expected | {(1, "2024-01-03"): 13.0}
    ids = sorted(r.id for r in lake.raw("etf_data").collect())
    assert ids == [1, 2, 3, 4]
    assert lake.raw("fifty_two_week_metrics").first().high_52week == 13.0


def test_batch_repeated_after_a_failure_applies_once(spark, lake, monkeypatch):
    landed = spark.createDataFrame(
        [(1, date(2024, 1, 9), 12.0, 12.0, 12.0, 12.0, 7, 1)], LANDED_BARS
    )
    staging = f"{lake.root}/staging"
    real = refresh.write_dated

    def fails(*args, **kwargs):
        raise OSError("lost")

    monkeypatch.setattr(refresh, "write_dated", fails)
    with pytest.raises(OSError):
        refresh.load_batch(lake, landed, now(), AS_OF, staging)
    monkeypatch.setattr(refresh, "write_dated", real)
    for _ in range(2):
        refresh.load_batch(lake, landed, now(), AS_OF, staging)
    assert len(closes(lake)) == 4
    assert sorted(r.id for r in lake.raw("etf_data").collect()) == [1, 2, 3, 4]


def test_documents_round_trip(spark, lake, tmp_path):
    bars = lake.raw("etf_data")
    refresh.refresh_metrics(
        lake, bars.select("symbol_id"), now(), AS_OF, f"{lake.root}/staging"
    )
    built = documents.symbol_documents(
        bars,
        lake.raw("symbols"),
        lake.raw("fifty_two_week_metrics"),
        lake.raw("decrease_thresholds"),
        now(),
        start=F.lit(date(2023, 10, 31)),
        end=F.lit(date(2024, 1, 31)),
    )
    path = str(tmp_path / "documents")
    files.write_documents(built, path)
    everything = files.read_documents(spark, path)
    assert everything.count() == 2
    one = files.read_documents(spark, path, "t1.l")
    document = one.first()
    assert document.symbol.ticker == "T1.L"
    assert [p.date for p in document.priceData] == [date(2024, 1, 2)]
    assert document.metrics.high52week == 10.0
    assert [t.percentage for t in document.thresholds] == [5, 10, 15, 20, 25, 30]
    assert "PartitionFilters: [isnotnull(bucket" in plan_of(one)
    assert files.document_prices(everything).count() == 2


def test_run_log_round_trip(spark, folder, tmp_path):
    events = spark.createDataFrame(
        [
            (1, datetime(2024, 1, 1, 10), 7, "load", 2.0, "{}"),
            (2, datetime(2024, 1, 1, 11), 7, "load", 3.0, "{}"),
            (3, datetime(2024, 1, 1, 12), 7, "error", 1.0, '{"k": 1}'),
            (4, datetime(2024, 1, 1, 12), 8, "load", 1.5, "{}"),
        ],
        "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    )
    path = str(tmp_path / "logs")
    files.write_run_logs(documents.run_logs(events), path)
    logs = {r.run_id: r for r in files.read_run_logs(spark, path).collect()}
    assert logs[7].steps["load"].duration == 3.0  # the newest entry of a step
    assert logs[7].errors == ['error: {"k": 1}']
    assert (logs[7].overall_success, logs[8].overall_success) == (False, True)
    assert logs[7].overall_duration == 3600.0


def _folded(df):
    return sorted(tuple(r) for r in state.fold(df).collect())


def test_load_keeps_the_state_equal_to_a_recount(spark, lake):
    landed = spark.createDataFrame(
        [(1, date(2024, 1, 9), 12.0, 12.0, 12.0, 12.0, 7, 1), (1, date(2024, 2, 1), 13.0, 13.0, 13.0, 13.0, 7, 1)],
        LANDED_BARS,
    )
    refresh.load_batch(lake, landed, now(), AS_OF, f"{lake.root}/staging")
    recount = state.month_state(lake.raw("etf_data"))
    assert _folded(lake.state()) == _folded(recount)
    ids = [r.id for r in lake.raw("etf_data").collect()]
    assert sorted(ids) == list(range(1, len(ids) + 1))


def test_state_fold_is_associative_over_any_split(spark, lake):
    bars = lake.raw("etf_data").drop(MONTH)
    whole = _folded(state.month_state(bars))
    days = sorted({r.date for r in bars.select("date").collect()})
    for cut in days:
        before, after = bars.filter(F.col("date") < cut), bars.filter(F.col("date") >= cut)
        parts = state.month_state(before).unionByName(state.month_state(after))
        assert _folded(parts) == whole
        # folding folded parts again changes nothing
        assert _folded(state.fold(parts).withColumn("x", F.lit(1)).drop("x")) == whole


def test_marks_read_the_state_not_the_bars(spark, lake):
    landed = spark.createDataFrame([(1, date(2024, 1, 9), 12.0)], "symbol_id long, date date, close double")
    files = state.only_newer_by_state(landed, lake.state(), "2021-12-01").inputFiles()
    assert files and all("symbol_state" in f for f in files)


MART_NAMES = ("mart_price_history", "mart_52week_metrics", "mart_entry_thresholds", "mart_fx_rates")


def _mart_contents(lake):
    return {name: sorted(map(repr, lake.mart(name).collect())) for name in MART_NAMES}


def test_publish_is_all_or_nothing(spark, lake, monkeypatch):
    lake.publish()
    first = lake.version()
    before = _mart_contents(lake)
    assert before["mart_price_history"] and before["mart_fx_rates"]

    def lost(*args, **kwargs):
        raise OSError("executor lost")

    # the third mart fails: the new version has two marts and no marker
    monkeypatch.setattr(Lake, "thresholds", lost)
    with pytest.raises(OSError):
        lake.publish()
    reader = Lake(spark, lake.root)
    assert reader.version() == first
    assert _mart_contents(reader) == before
    monkeypatch.undo()
    lake.publish()
    assert Lake(spark, lake.root).version() > first
    # a reader keeps the version it took, while another publishes
    assert reader.version() == first and _mart_contents(reader) == before


def test_nothing_published_reads_an_empty_fx_mart(spark, lake):
    assert Lake(spark, lake.root).fx_mart().count() == 0
