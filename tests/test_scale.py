"""Hot keys, and joins whose sides are past the broadcast bound."""

import duckdb
import pytest
from check import TABLES, connect, difference

import __spark_entry__ as entry
from quotelake.operators import sizing
from quotelake.operators.metrics import metrics_52week, newest_date
from quotelake.sources.lake import lake_for

SQL = entry.oracle_sql()
JOINING = [
    "fx_lookup",
    "indexed_100",
    "mart_52week",
    "mart_price_history",
    "mart_thresholds",
    "portfolio_risk",
    "threshold_reached",
    "update_eur_prices",
    "upsert_prices",
]


@pytest.fixture(scope="module")
def hot_folder(folder, tmp_path_factory):
    """The test tables with a third of all trades on one supplier, another third
    on one order, and a third of the orders on one customer."""
    target = tmp_path_factory.mktemp("hot")
    con = duckdb.connect()
    changed = {
        "orders": "CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE o_custkey END AS o_custkey",
        "lineitem": "CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS l_suppkey, "
        "CASE WHEN l_partkey % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey",
    }
    for table in TABLES:
        change = f"REPLACE ({changed[table]})" if table in changed else ""
        con.execute(
            f"COPY (SELECT * {change} FROM '{folder}/{table}.parquet') "
            f"TO '{target}/{table}.parquet'"
        )
    return str(target)


def agrees(spark, where, name):
    got = entry.queries()[name](spark, where).toPandas()
    return difference(got, connect(where).execute(SQL[name]).df()) is None


@pytest.mark.parametrize("name", ["raw_bars", "drawdown", "row_slice", "dq_batch", *JOINING])
def test_hot_keys(spark, hot_folder, name):
    assert agrees(spark, hot_folder, name)


@pytest.mark.parametrize("name", JOINING)
def test_without_any_broadcast(spark, folder, monkeypatch, name):
    lake_for(spark, folder, published=True)
    monkeypatch.setattr(sizing, "planned_bytes", lambda df: 2**62)
    keys = [
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    ]
    for key in keys:
        spark.conf.set(key, "-1")
    try:
        assert agrees(spark, folder, name)
    finally:
        for key in keys:
            spark.conf.unset(key)


def scans(plan):
    """(files read, partitions read) of every scan in an executed plan."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return scans(plan.executedPlan())
    if "QueryStage" in name:
        return scans(plan.plan())
    found = []
    if name.startswith("Scan"):
        metrics = plan.metrics()
        read = metrics.get("numPartitions")
        found.append(read.get().value() if read.isDefined() else None)
    children = plan.children()
    for i in range(children.size()):
        found += scans(children.apply(i))
    return found


def test_52_week_window_reads_thirteen_months(spark, folder):
    bars = lake_for(spark, folder).raw("etf_data")
    df = metrics_52week(bars, newest_date(bars))
    df.collect()
    assert scans(df._jdf.queryExecution().executedPlan()) == [13]
    assert bars.select("month").distinct().count() > 80
