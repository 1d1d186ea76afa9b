"""A folder of raw tables and the marts published from them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.operators import state
from quotelake.operators.fx import keeps_layout
from quotelake.plans import marts, staging
from quotelake.session import configure
from quotelake.sources import derive
from quotelake.sources.schemas import MART_FX_RATES, RAW_TABLES
from quotelake.sources.storage import (
    MONTH,
    new_folder,
    path_exists,
    read_optional,
    read_table,
    write_dated,
)

#: Folder of the markers of committed mart versions, below the marts' root.
VERSIONS = "_versions"

#: Date column and file clustering of the tables stored by month.
DATED = {
    "etf_data": ("date", ["symbol_id", "date"]),
    "fifty_two_week_metrics": ("calculation_date", ["symbol_id"]),
    "decrease_thresholds": ("calculation_date", ["symbol_id"]),
    "mart_price_history": ("date", ["ticker", "date"]),
    "symbol_state": ("latest_date", ["symbol_id"]),
}


_PENDING: dict[str, dict[str, Callable[[], None]]] = {}


class Lake:
    """Raw tables below one root folder, marts below the same or another."""

    def __init__(self, spark: SparkSession, root: str, marts_root: str | None = None):
        self.spark, self.root = spark, root
        self.marts_root = marts_root or root
        self._version: str | None = None

    @property
    def pending(self) -> dict[str, Callable[[], None]]:
        """Steps that build raw tables not stored yet. A table's first reader runs its step,
        through whichever ``Lake`` over this root."""
        return _PENDING.setdefault(self.root, {})

    def _build(self, name: str) -> None:
        step = self.pending.pop(name, None)
        if step is None:
            return
        try:
            step()
        except BaseException:
            self.pending[name] = step
            raise

    def path(self, name: str, version: str | None = None) -> str:
        if name.startswith("mart_"):
            return f"{self.marts_root}/{version or self.version()}/{name}"
        self._build(name)
        return f"{self.root}/{name}"

    # versions of the marts ----------------------------------------------------

    def _markers(self) -> str:
        return f"{self.marts_root}/{VERSIONS}"

    def version(self) -> str:
        """The newest committed version of the marts, taken once by this lake (a session's reader
        keeps it while others publish); ``none`` where nothing was published."""
        if self._version is None:
            found = None
            if path_exists(self.spark, self._markers()):
                found = self.spark.read.text(self._markers()).agg(F.max("value")).first()[0]
            self._version = found or "none"
        return self._version

    def _commit(self, version: str) -> None:
        """Publish a version: its marker is written after all its marts, as one small file."""
        marker = self.spark.createDataFrame([(version,)], "value string").coalesce(1)
        marker.write.mode("append").text(self._markers())
        self._version = version

    def write(self, name: str, df: DataFrame, in_layout: bool = False) -> None:
        if name in DATED:
            write_dated(df, self.path(name), *DATED[name], in_layout=in_layout)
        else:
            df.write.mode("overwrite").parquet(self.path(name))

    def raw(self, name: str) -> DataFrame:
        """Raw table with its declared schema; dated ones also carry ``month``,
        on which date filters prune."""
        return read_table(self.spark, self.path(name), RAW_TABLES[name], name in DATED)

    def state(self) -> DataFrame:
        """Stored state rows, one per (symbol, month); fold them for one row per symbol."""
        return self.raw("symbol_state").drop(MONTH)

    def refresh_state(self, months: list[int]) -> None:
        """Recompute the state rows of the given months from those months of the bars only."""
        bars = self.raw("etf_data").filter(F.col(MONTH).isin(months))
        write_dated(state.month_state(bars), self.path("symbol_state"), *DATED["symbol_state"], replace_all=False)

    def mart(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def fx_mart(self) -> DataFrame:
        """The FX mart; empty where a published lake does not have it yet."""
        return read_optional(self.spark, self.path("mart_fx_rates"), MART_FX_RATES)

    # plans over the raw tables ------------------------------------------------

    def staged_prices(self) -> DataFrame:
        return staging.stage_prices(self.raw("etf_data"), self.raw("symbols"))

    def staged_fx(self) -> DataFrame:
        return staging.stage_fx(self.raw("currency_rates"))

    def eur_prices(self) -> DataFrame:
        return marts.eur_prices(self.staged_prices(), self.staged_fx())

    def price_history(self) -> DataFrame:
        return marts.price_history(self.eur_prices())

    def latest_price(self) -> DataFrame:
        """Newest price per ticker without the moving average's window."""
        return marts.latest_price(marts.with_daily_change(self.eur_prices()))

    def week52(self, newest: DataFrame | None = None) -> DataFrame:
        return marts.week52_metrics(
            self.raw("fifty_two_week_metrics"),
            self.raw("symbols"),
            self.latest_price() if newest is None else newest,
        )

    def thresholds(self, newest: DataFrame | None = None) -> DataFrame:
        return marts.entry_thresholds(
            self.raw("decrease_thresholds"),
            self.raw("symbols"),
            self.latest_price() if newest is None else newest,
        )

    def publish(self) -> None:
        """Write the four marts into a new version folder, then commit the version.

        Readers see either all four new marts or all four old ones: a publish that fails
        half way leaves no marker, and its folder is never read. The later marts read the
        stored price history of the same version, so the EUR chain is computed once.
        """
        version = f"v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

        def write(name: str, df: DataFrame) -> None:
            df.write.mode("overwrite").parquet(self.path(name, version))

        # ranges of tickers serve the average's window and the files: one exchange, no
        # second one by month; every task writes its tickers' rows of every month
        ranged = marts.price_history(self.eur_prices().repartitionByRange("ticker"))
        path = self.path("mart_price_history", version)
        write_dated(ranged, path, *DATED["mart_price_history"], in_layout=True)
        history = self.spark.read.parquet(path)
        newest = marts.latest_price(history)
        write("mart_52week_metrics", self.week52(newest))
        write("mart_entry_thresholds", self.thresholds(newest))
        write("mart_fx_rates", marts.fx_rates(self.staged_fx()))
        self._commit(version)


def raw_lake(spark: SparkSession, folder: str) -> Lake:
    """A new lake whose raw tables are folded from the trading tables of ``folder``, each
    when it is first read: a report on bars does not wait for the holdings."""
    lake = Lake(spark, new_folder(spark, "lake"))

    def bars() -> None:
        symbols, rates = lake.raw("symbols"), lake.raw("currency_rates")
        found = derive.etf_data(spark, folder, symbols, rates)
        lake.write("etf_data", found, in_layout=keeps_layout(symbols, rates))

    def thresholds() -> None:
        stored = lake.raw("fifty_two_week_metrics").drop(MONTH)
        lake.write("decrease_thresholds", derive.thresholds(stored))

    lake.pending.update({
        "symbols": lambda: lake.write("symbols", derive.symbols(spark, folder)),
        "currency_rates": lambda: lake.write("currency_rates", derive.currency_rates(spark, folder)),
        "etf_data": bars,
        "symbol_state": lambda: lake.write("symbol_state", state.month_state(lake.raw("etf_data"))),
        "fifty_two_week_metrics": lambda: lake.write(
            "fifty_two_week_metrics", derive.metrics(lake.raw("etf_data"))
        ),
        "decrease_thresholds": thresholds,
        "holdings": lambda: lake.write("holdings", derive.holdings(spark, folder)),
    })
    return lake


def build_raw(spark: SparkSession, folder: str) -> Lake:
    """Fold the trading tables of ``folder`` into all raw tables of a new lake."""
    lake = raw_lake(spark, folder)
    for name in list(lake.pending):
        lake.path(name)
    return lake


_LAKES: dict[tuple[str, str], Lake] = {}
_PUBLISHED: set[str] = set()


def lake_for(spark: SparkSession, folder: str, published: bool = False) -> Lake:
    """The session's lake for a data folder, its tables built (and published) on first use."""
    key = (spark.sparkContext.applicationId, folder.rstrip("/"))
    if key not in _LAKES:
        configure(spark)
        _LAKES[key] = raw_lake(spark, folder)
    lake = _LAKES[key]
    if published and lake.root not in _PUBLISHED:
        lake.publish()
        _PUBLISHED.add(lake.root)
    return lake
