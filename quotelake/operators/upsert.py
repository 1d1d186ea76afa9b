"""Set-based insert-or-update and keyed updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelake.operators.ids import next_id, number_rows
from quotelake.operators.latest import latest_per_key


def last_wins(
    batch: DataFrame, keys: Sequence[str], values: Sequence[str], ordinal: str
) -> DataFrame:
    """One row per key: the last of the batch. Copies of a key are combined
    before the shuffle, so many copies of one key cost nothing."""
    return latest_per_key(batch, keys, ordinal, values, order_is_unique=False)


def upsert(
    current: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    ordinal: str,
    loaded_at: Column,
    first_new_id: Column | None = None,
) -> DataFrame:
    """``current`` after the batch: matched keys take the batch's values and
    keep ``id`` and ``created_at``; new keys get the next ids and ``loaded_at``.

    The big side, ``current``, is only ever the streamed side of a left or
    semi join, so a small batch is broadcast by the planner and nothing big
    moves; a big batch falls back to a shuffle join on the unique keys.
    """
    new = last_wins(batch, keys, values, ordinal)
    incoming = new.select(
        *keys,
        *(F.col(c).alias(f"_new_{c}") for c in values),
        F.lit(True).alias("_hit"),
    )
    kept = current.join(incoming, list(keys), "left")
    for column in values:
        chosen = F.when(F.col("_hit"), F.col(f"_new_{column}"))
        kept = kept.withColumn(column, chosen.otherwise(F.col(column)))
    kept = kept.select(*current.columns)

    known = current.join(new.select(*keys), list(keys), "left_semi").select(*keys)
    unseen = new.join(known, list(keys), "left_anti")
    start = next_id(current) if first_new_id is None else first_new_id
    added = number_rows(unseen, keys, start).withColumn("created_at", loaded_at)
    return kept.unionByName(added.select(*current.columns))


def update_by_key(
    current: DataFrame, changes: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Replace ``values`` where ``changes`` has the key, nulls included. Of several
    changes of one key the greatest applies; an update never adds rows."""
    single = changes.groupBy(*keys).agg(F.max(F.struct(*values)).alias("_values"))
    incoming = single.select(*keys, "_values.*").select(
        *keys,
        *(F.col(c).alias(f"_new_{c}") for c in values),
        F.lit(True).alias("_hit"),
    )
    joined = current.join(incoming, list(keys), "left")
    for column in values:
        chosen = F.when(F.col("_hit"), F.col(f"_new_{column}"))
        joined = joined.withColumn(column, chosen.otherwise(F.col(column)))
    return joined.select(*current.columns)


def update_where(
    current: DataFrame, condition: Column, assignments: dict[str, Column]
) -> DataFrame:
    """Predicated update in one projection; a null condition changes nothing."""
    columns = [
        F.when(condition, assignments[c]).otherwise(F.col(c)).alias(c)
        if c in assignments
        else F.col(c)
        for c in current.columns
    ]
    return current.select(*columns)
