"""Landed files: symbol CSV, bar and rate files, nested JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotelake.sources.schemas import (
    BAR_FILE,
    RUN_LOG,
    SYMBOL_DOCUMENT,
    SYMBOL_FILE,
)
from quotelake.sources.storage import in_dates


def missing_columns(found: list[str], required: list[str]) -> list[str]:
    return [c for c in required if c not in found]


def read_symbol_csv(spark: SparkSession, path: str) -> DataFrame:
    """Symbol list; refuses a file without the six required columns."""
    landed = spark.read.option("header", True).csv(path)
    required = SYMBOL_FILE.fieldNames()
    missing = missing_columns(landed.columns, required)
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    return landed.select(*required)


def write_symbol_csv(symbols: DataFrame, path: str) -> None:
    symbols.select(*SYMBOL_FILE.fieldNames()).write.mode("overwrite").option(
        "header", True
    ).csv(path)


def read_bars(spark: SparkSession, path: str, start=None) -> DataFrame:
    """Landed bar files from a start date on; the filter reaches the scan."""
    return in_dates(spark.read.schema(BAR_FILE).parquet(path), "date", start)


def _bucket(ticker: Column) -> Column:
    """Folder of a ticker: 256 of them, however many symbols there are."""
    return F.substring(F.md5(F.lower(ticker)), 1, 2)


def write_documents(documents: DataFrame, path: str) -> None:
    """Compressed JSON lines in hashed folders. Range partitioning on (folder, ticker)
    splits a large folder over tasks."""
    (
        documents.withColumn("bucket", _bucket(F.col("symbol.ticker")))
        .repartitionByRange("bucket", "symbol.ticker")
        .write.mode("overwrite")
        .partitionBy("bucket")
        .json(path, compression="gzip")
    )


def read_documents(
    spark: SparkSession, path: str, ticker: str | None = None
) -> DataFrame:
    """Symbol documents: all, or one symbol's from its folder alone."""
    schema = T.StructType(
        [*SYMBOL_DOCUMENT.fields, T.StructField("bucket", T.StringType())]
    )
    documents = spark.read.schema(schema).json(path)
    if ticker is not None:
        wanted = F.lit(ticker)
        documents = documents.filter(F.col("bucket") == _bucket(wanted)).filter(
            F.lower("symbol.ticker") == F.lower(wanted)
        )
    return documents.drop("bucket")


def document_prices(documents: DataFrame) -> DataFrame:
    """Price rows of the documents."""
    return documents.select(
        F.col("symbol.ticker").alias("ticker"), F.inline("priceData")
    )


def write_run_logs(logs: DataFrame, path: str) -> None:
    logs.write.mode("overwrite").json(path)


def read_run_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).json(path)
