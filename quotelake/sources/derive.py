"""Raw tables folded from the trading tables (supplier, lineitem, orders …).

One symbol per supplier and one bar per supplier and ship date, so every table
grows with the data. See FIXTURES.md for the mapping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelake.functions.numeric import exact_sum, round_to
from quotelake.operators.fx import convert_batch
from quotelake.operators.metrics import entry_levels, metrics_52week, newest_date
from quotelake.sources.schemas import EUR_COLUMNS
from quotelake.sources.storage import MONTH, clustered

# Currency per sales region, investor country per nation key % 4.
REGION_CURRENCY = {"EUROPE": "EUR", "ASIA": "GBP", "MIDDLE EAST": "CHF"}
COUNTRIES = ("USA", "Australia", "Germany", "France")
LISTED_AT = "2021-12-01 00:00:00"


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _region_currency() -> Column:
    region = F.col("r_name")
    chain = F
    for name, currency in REGION_CURRENCY.items():
        chain = chain.when(region == name, F.lit(currency))
    return chain.otherwise(F.lit("USD"))


def _nation_currency(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = read(spark, folder, "nation"), read(spark, folder, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.select("n_nationkey", _region_currency().alias("currency"))


def _stamp(text: Column) -> Column:
    return text.cast("timestamp_ntz")


def evening(day: Column) -> Column:
    """Load time of a trading day: 21:15."""
    return _stamp(F.concat(day.cast("string"), F.lit(" 21:15:00")))


def symbols(spark: SparkSession, folder: str) -> DataFrame:
    supplier = read(spark, folder, "supplier")
    nation = _nation_currency(spark, folder)
    key = F.col("s_suppkey")
    even = key % 2 == 0
    isin = F.concat(
        F.when(even, "IE").otherwise("US"),
        F.lpad(key.cast("string"), 9, "0"),
        (key % 10).cast("string"),
    )
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        key.alias("id"),
        isin.alias("isin"),
        F.col("s_name").alias("ticker"),
        F.concat(F.lit("Fund "), "s_name").alias("name"),
        F.when(key % 5 == 4, "STOCK").otherwise("ETF").alias("asset_type"),
        F.when(even, "LSE")
        .when(key % 4 == 1, "NYSE")
        .otherwise("NASDAQ")
        .alias("exchange"),
        "currency",
        _stamp(F.lit(LISTED_AT)).alias("created_at"),
        (key % 7 != 6).alias("is_active"),
    )


def currency_rates(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer = read(spark, folder, "orders"), read(spark, folder, "customer")
    buyers = customer.join(
        _nation_currency(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")
    ).select(F.col("c_custkey").alias("o_custkey"), "currency")
    day = F.to_date("o_orderdate")
    daily = (
        orders.join(buyers, "o_custkey")
        .filter(F.col("currency").isin("USD", "GBP"))
        .groupBy(F.col("currency").alias("from_currency"), day.alias("rate_date"))
        .agg(exact_sum(F.col("o_totalprice"), 2).alias("total"), F.count("*").alias("n"))
    )
    mean = round_to(F.col("total") / F.col("n") / F.lit(250000.0), 6)
    rate = F.when(F.dayofmonth("rate_date") == 13, F.lit(0.0)).otherwise(mean)
    block = F.when(F.col("from_currency") == "USD", 200000).otherwise(100000)
    return daily.select(
        (block + F.unix_date("rate_date")).cast("long").alias("id"),
        "from_currency",
        F.lit("EUR").alias("to_currency"),
        "rate_date",
        rate.alias("exchange_rate"),
        evening(F.col("rate_date")).alias("created_at"),
    )


def bars(spark: SparkSession, folder: str) -> DataFrame:
    """Open, high, low, close and volume per supplier and day, with the month.

    A supplier has hardly two trades a day, so combining them before the shuffle saves
    nothing, and the first and last trade by a struct order make it sort every input
    split. The trades are therefore moved once, as they are, into the layout the bars
    are stored in, and aggregated there in its order (supplier is constant in a group)."""
    trade_order = F.struct(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"
    )
    price = F.lit(60.0) + F.col("l_extendedprice") / F.lit(2000.0)
    trades = read(spark, folder, "lineitem").select(
        F.col("l_suppkey").alias("symbol_id"),
        F.to_date("l_shipdate").alias("date"),
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        "l_quantity",
    )
    return (
        clustered(trades, "date", ["symbol_id", "date"])
        .groupBy(MONTH, "symbol_id", "date")
        .agg(
            F.min_by(price, trade_order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, trade_order).alias("close"),
            F.sum("l_quantity").cast("long").alias("volume"),
        )
    )


def etf_data(
    spark: SparkSession, folder: str, symbols: DataFrame, rates: DataFrame
) -> DataFrame:
    """Bars as loaded, with their month: EUR prices are present on every third day of it."""
    converted = convert_batch(bars(spark, folder), symbols, rates, fill_base=False)
    loaded = F.dayofmonth("date") % 3 == 0
    kept = {c: F.when(loaded, F.col(c)) for c in EUR_COLUMNS}
    identifier = F.col("symbol_id") * 100000 + F.unix_date("date")
    return converted.withColumns(kept).select(
        identifier.cast("long").alias("id"),
        *converted.columns,
        evening(F.col("date")).alias("created_at"),
    )


def _snapshot_id() -> Column:
    key = F.col("symbol_id") * 100000 + F.unix_date("calculation_date")
    return key.cast("long").alias("id")


def metrics(etf_data: DataFrame) -> DataFrame:
    """Two snapshots, so that reading the newest one is real work."""
    newest = newest_date(etf_data)
    both = metrics_52week(etf_data, newest).unionByName(
        metrics_52week(etf_data, F.date_sub(newest, 30))
    )
    stamp = evening(F.col("calculation_date")).alias("created_at")
    return both.select(_snapshot_id(), *both.columns, stamp)


def thresholds(metrics: DataFrame) -> DataFrame:
    levels = entry_levels(metrics)
    stamp = evening(F.col("calculation_date")).alias("created_at")
    return levels.select(_snapshot_id(), *levels.columns, stamp)


def holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Units and cost per customer and symbol, with the customer's country.

    The countries of a customer (one text, a repeated customer has several) are attached
    to the orders, so the far more numerous holdings need no shuffle of their own for them."""
    orders = read(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = read(spark, folder, "lineitem")
    key = F.col("c_nationkey") % 4
    country = F.when(key.isNull(), F.lit(COUNTRIES[-1])).otherwise(
        F.element_at(F.array(*map(F.lit, COUNTRIES)), (key + 1).cast("int"))
    )
    owners = (
        read(spark, folder, "customer")
        .groupBy(F.col("c_custkey").alias("holder"))
        .agg(F.array_join(F.collect_list(country), "|").alias("_countries"))
    )
    buyers = orders.join(owners, F.col("o_custkey") == F.col("holder")).drop("o_custkey")
    paid = F.col("l_quantity") * (
        F.lit(60.0) + F.col("l_extendedprice") / F.lit(2000.0)
    )
    grouped = (
        lines.join(buyers, lines.l_orderkey == buyers.o_orderkey)
        .groupBy("holder", F.col("l_suppkey").alias("symbol_id"), "_countries")
        .agg(
            F.sum("l_quantity").cast("long").alias("units"),
            exact_sum(paid).alias("cost"),
        )
    )
    each = F.explode(F.split("_countries", "[|]")).alias("country")
    return grouped.select("holder", "symbol_id", each, "units", "cost")


def new_batch(etf_data: DataFrame) -> DataFrame:
    """Landed bars to load: the last ten days restated, five later days, and a
    correction (``seq`` 2) of the newest day."""
    newest = newest_date(etf_data)
    base = etf_data.select(
        "symbol_id", "date", "open", "high", "low", "close", "volume"
    ).filter(F.col("date") > F.date_sub(newest, 10))
    restated = base.withColumns(
        {"close": F.col("close") * 1.01, "seq": F.lit(1)}
    )
    later = base.filter(F.col("date") > F.date_sub(newest, 5)).withColumns(
        {"date": F.date_add("date", 5), "seq": F.lit(1)}
    )
    corrected = base.filter(F.col("date") == newest).withColumns(
        {"close": F.col("close") * 1.02, "seq": F.lit(2)}
    )
    return restated.unionByName(later).unionByName(corrected)


def new_rates(rates: DataFrame) -> DataFrame:
    """Landed rates of the same shape: restated, later and corrected days."""
    newest = rates.agg(F.max("rate_date")).scalar()
    base = rates.select(
        "from_currency", "to_currency", "rate_date", "exchange_rate"
    ).filter(F.col("rate_date") > F.date_sub(newest, 10))
    rate = F.col("exchange_rate")
    restated = base.withColumns({"exchange_rate": rate * 1.01, "seq": F.lit(1)})
    later = base.filter(F.col("rate_date") > F.date_sub(newest, 5)).withColumns(
        {"rate_date": F.date_add("rate_date", 5), "seq": F.lit(1)}
    )
    corrected = base.filter(F.col("rate_date") == newest).withColumns(
        {"exchange_rate": rate * 1.02, "seq": F.lit(2)}
    )
    return restated.unionByName(later).unionByName(corrected)


def new_symbols(spark: SparkSession, folder: str) -> DataFrame:
    """Valid symbols not yet listed, one per customer."""
    key = F.col("c_custkey")
    isin = F.concat(
        F.lit("US9"), F.lpad(key.cast("string"), 8, "0"), (key % 10).cast("string")
    )
    return read(spark, folder, "customer").select(
        isin.alias("isin"),
        F.col("c_name").alias("ticker"),
        F.concat(F.lit("Fund "), "c_name").alias("name"),
        F.lit("ETF").alias("asset_type"),
        F.lit("NYSE").alias("exchange"),
        F.lit("USD").alias("currency"),
    )


def symbol_file(symbols: DataFrame) -> DataFrame:
    """Symbol list as landed, with faults of every kind spread over the keys;
    ``seq`` is the position of a repeated entry."""
    key = F.col("id")

    def replaced(column: str, *cases: tuple[int, int, Column]) -> Column:
        chain = F
        for modulus, rest, value in cases:
            chain = chain.when(key % modulus == rest, value)
        return chain.otherwise(F.col(column)).alias(column)

    base = symbols.select(
        replaced(
            "isin",
            (11, 3, F.lower("isin")),
            (11, 5, F.concat(F.lit("DE"), F.substring("isin", 3, 10))),
            (11, 7, F.lit(None).cast("string")),
        ),
        "ticker",
        replaced("name", (13, 4, F.lit(""))),
        replaced("asset_type", (17, 2, F.lit("BOND"))),
        replaced("exchange", (19, 6, F.lit("XETRA")), (7, 5, F.lit("LSE"))),
        "currency",
        F.lit(1).alias("seq"),
    )
    repeated = symbols.filter(key % 10 == 0).select(
        "isin",
        F.concat("ticker", F.lit(".X")).alias("ticker"),
        "name",
        "asset_type",
        "exchange",
        "currency",
        F.lit(2).alias("seq"),
    )
    return base.unionByName(repeated)
