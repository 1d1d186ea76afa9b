"""Run logs: flattening and summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def log_steps(logs: DataFrame) -> DataFrame:
    """One row per run and step of the nested step map."""
    entries = F.explode(F.map_entries("steps")).alias("_step")
    return logs.select("run_id", entries).select(
        "run_id",
        F.col("_step.key").alias("step"),
        *(
            F.col(f"_step.value.{c}").alias(c)
            for c in ("start_time", "end_time", "duration", "success", "error")
        ),
    )


def run_summary(steps: DataFrame) -> DataFrame:
    """Totals per run. A run is complete without failures and usable when at
    least one step succeeded."""
    good = F.col("success")
    return steps.groupBy("run_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(good).alias("successful"),
        F.count_if(~good).alias("failed"),
        F.sum(F.col("duration").cast("decimal(18,2)")).cast("double").alias("duration"),
        F.bool_and(good).alias("overall_success"),
        F.bool_or(good).alias("any_success"),
    )
