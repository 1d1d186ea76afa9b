"""Daily loading of landed bar files as a file stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

from quotelake.plans.refresh import load_batch
from quotelake.sources.lake import Lake
from quotelake.sources.schemas import BAR_FILE

LANDED_BARS = T.StructType(
    [*BAR_FILE.fields, T.StructField("seq", T.IntegerType())]
)


def load_landed_files(
    lake: Lake,
    landing: str,
    work: str,
    loaded_at: Column,
    as_of: str,
    files_per_batch: int | None = None,
) -> None:
    """Load every file not yet loaded, then stop.

    The checkpoint below ``work`` remembers loaded files; a batch that is
    repeated after a failure finds its own staging folder by batch id, so each
    file takes effect exactly once.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read from files again if an executor is lost
        try:
            load_batch(lake, batch, loaded_at, as_of, f"{work}/staging/{batch_id}")
        finally:
            batch.unpersist()

    stream = lake.spark.readStream.schema(LANDED_BARS)
    if files_per_batch is not None:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    query = (
        stream.parquet(landing)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{work}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
