"""Comparison of two symbol lists by ISIN."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.operators.latest import latest_per_key

FIELDS = ["ticker", "name", "asset_type", "exchange", "currency"]


def _one_per_isin(df: DataFrame, ordinal: str | None) -> DataFrame:
    """Last entry per ISIN. Repeats combine before the shuffle and the result
    has unique keys, so the join that follows cannot be skewed."""
    if ordinal is None:
        return df.groupBy("isin").agg(*(F.max(c).alias(c) for c in FIELDS))
    return latest_per_key(df, ["isin"], ordinal, FIELDS, order_is_unique=False)


def reconcile(
    landed: DataFrame, stored: DataFrame, ordinal: str | None = None
) -> DataFrame:
    """(isin, field, file_value, stored_value) of every difference; ``field``
    is ``missing_in_db`` or ``extra_in_db`` where a side lacks the ISIN."""

    def side(df: DataFrame, prefix: str, ordinal: str | None) -> DataFrame:
        single = _one_per_isin(df, ordinal)
        return single.select(
            F.col("isin").alias(f"{prefix}isin"),
            F.lit(True).alias(f"{prefix}present"),
            *(F.col(c).alias(f"{prefix}{c}") for c in FIELDS),
        )

    both = side(landed, "f_", ordinal).join(
        side(stored, "s_", None), F.col("f_isin").eqNullSafe(F.col("s_isin")), "full"
    )
    missing, extra = F.col("s_present").isNull(), F.col("f_present").isNull()
    text = F.lit(None).cast("string")

    def difference(field, file_value, stored_value):
        return F.struct(
            field.alias("field"),
            file_value.alias("file_value"),
            stored_value.alias("stored_value"),
        )

    unequal = [
        F.when(
            ~F.col(f"f_{c}").eqNullSafe(F.col(f"s_{c}")),
            difference(F.lit(c), F.col(f"f_{c}"), F.col(f"s_{c}")),
        )
        for c in FIELDS
    ]
    found = (
        F.when(missing, F.array(difference(F.lit("missing_in_db"), text, text)))
        .when(extra, F.array(difference(F.lit("extra_in_db"), text, text)))
        .otherwise(F.array_compact(F.array(*unequal)))
    )
    isin = F.coalesce("f_isin", "s_isin").alias("isin")
    return both.select(isin, F.inline(found))


def isins_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("isin").subtract(right.select("isin"))


def isins_in_both(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.select("isin").intersect(right.select("isin"))
