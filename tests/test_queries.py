"""Every query against its SQL counterpart, and what its plan must not contain."""

import pytest
from check import connect, difference

import __spark_entry__ as entry
from quotelake.catalog import QUERIES

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_every_query_has_sql():
    """Those of the catalogue; of the corpus queries only the ones SQL can express have it."""
    assert set(QUERIES) <= set(SQL) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, folder, duck, name):
    df = entry.queries()[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for banned in ("CartesianProduct", "NestedLoopJoin", "EvalPython", "MapInPandas"):
        assert banned not in plan
    assert difference(df.toPandas(), duck.execute(SQL[name]).df()) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-1] == "close_eur_7d_avg"
