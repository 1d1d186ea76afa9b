"""What the corpus operators share: text columns, stored steps, numbering."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from quotelake.sources.storage import new_folder

#: Executors need not have this package installed: its functions travel whole.
cloudpickle.register_pickle_by_value(sys.modules["quotelake.llm"])

#: ASCII white space, the only characters that separate words.
SPACE = r"[\x20\x09-\x0D]"

#: Translation of bytes that lower-cases A-Z and nothing else.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_remainder(divisor: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as ''."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.pmod(F.crc32(F.encode(text, "utf-8")), F.lit(divisor))



def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write a step once to the shared folder, with the writer's ``options``, and go on from the stored copy.

    The copy survives lost executors and ends the lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, f"llm-{label}")
    df.write.options(**options).parquet(path)
    return spark.read.schema(T.StructType([_nullable(f) for f in df.schema])).parquet(path)


def _nullable(field: T.StructField) -> T.StructField:
    return T.StructField(field.name, field.dataType, True)


def numbered(df: DataFrame, group: str, key: Column, name: str, cells: int = 1024) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each value of ``group``, in hash order of ``key``.

    No task sees a whole group: rows are spread over ``cells`` hash cells, counted
    per cell, and numbered within a cell from the count of the cells before it.
    Rows with equal keys are ordered arbitrarily among themselves. A null group is a group.
    """
    keyed = df.withColumn("__hash", F.xxhash64(key)).withColumn(
        "__cell", F.pmod("__hash", F.lit(cells)).cast("int")
    )
    before = Window.partitionBy("__group").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        keyed.groupBy(F.col(group).alias("__group"), F.col("__cell").alias("__at"))
        .agg(F.count(F.lit(1)).alias("__n"))
        .withColumn("__start", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        .drop("__n")
    )
    within = Window.partitionBy(group, "__cell").orderBy("__hash")
    return (
        keyed.withColumn("__row", F.row_number().over(within) - 1)
        .join(starts, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__cell") == F.col("__at")))
        .withColumn(name, F.col("__start") + F.col("__row"))
        .drop("__hash", "__cell", "__group", "__at", "__start", "__row")
    )
