"""Stored tables in the folder every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Partition column of dated tables: year * 100 + month. A daily load then
#: rewrites a month or two, and date ranges prune closely.
MONTH = "month"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a temporary folder only on a local master."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    path = path or spark.sparkContext.getCheckpointDir()
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    path = tempfile.mkdtemp(prefix="quotelake-")
    spark.sparkContext.setCheckpointDir(path)
    return path


def new_folder(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    base = shared_folder(spark).rstrip("/")
    return f"{base}/quotelake/{app}/{label}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm_path.getFileSystem(conf).exists(jvm_path)


def month_of(day: Column) -> Column:
    return F.year(day) * 100 + F.month(day)


def with_month(df: DataFrame, date_column: str) -> DataFrame:
    return df.withColumn(MONTH, month_of(F.col(date_column)))


def settle(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result once and continue from the stored copy.

    Cuts the lineage where several later steps use the result, and lets a rerun
    after a failure pick up a finished step instead of computing it again.
    """
    spark = df.sparkSession
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clustered(df: DataFrame, date_column: str, cluster_by: list[str]) -> DataFrame:
    """``df`` with its month, range partitioned on (month, keys): the layout of a dated
    table. An aggregate on month and keys needs no further exchange and keeps it."""
    return with_month(df, date_column).repartitionByRange(MONTH, *cluster_by)


def write_dated(
    df: DataFrame,
    path: str,
    date_column: str,
    cluster_by: list[str],
    replace_all: bool = True,
    in_layout: bool = False,
) -> None:
    """Write partitioned by month. Range partitioning on (month, keys) spreads a
    hot month or key over many tasks and leaves sorted files, so that row-group
    statistics prune reads by key. ``in_layout`` says that ``df`` is range partitioned
    already, on (month, keys) or on the first key. With ``replace_all=False`` only the months
    present in ``df`` are replaced."""
    if not in_layout:
        df = clustered(df, date_column, cluster_by)
    elif MONTH not in df.columns:
        df = with_month(df, date_column)
    (
        df.sortWithinPartitions(MONTH, *cluster_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if replace_all else "dynamic")
        .partitionBy(MONTH)
        .parquet(path)
    )


def read_table(
    spark: SparkSession, path: str, schema: T.StructType, dated: bool = False
) -> DataFrame:
    if dated:
        schema = T.StructType([*schema.fields, T.StructField(MONTH, T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType
) -> DataFrame:
    """Stored table, or a typed empty frame where it was never published."""
    if path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def _day(bound) -> Column:
    return F.lit(bound).cast("date") if isinstance(bound, str) else bound


def in_dates(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Inclusive date filter that also prunes month partitions. Bounds are date
    text or date columns, scalar subqueries included."""
    dated = MONTH in df.columns
    if start is not None:
        first = _day(start)
        df = df.filter(F.col(column) >= first)
        df = df.filter(F.col(MONTH) >= month_of(first)) if dated else df
    if end is not None:
        last = _day(end)
        df = df.filter(F.col(column) <= last)
        df = df.filter(F.col(MONTH) <= month_of(last)) if dated else df
    return df
