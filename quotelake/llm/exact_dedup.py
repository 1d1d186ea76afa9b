"""Exact deduplication by progressive refinement.

Groups of possible copies are refined by length, then by a hash of a prefix, then
by a hash of the whole text. Only the lengths and prefix hashes of all documents are
grouped; whole texts are hashed for those documents alone whose (length, prefix)
is met more than once. Which ones those are reaches the second scan as a bit table of
fixed size, so texts of documents without copies are never shuffled. A bit shared
by accident only means one more text to hash.

Equal means equal after deleting ASCII white space. Of equal texts the longest
original (in code points) stays, then the smallest doc_id; a null id stays only where
no other is there, and of wholly repeated rows one stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quotelake.llm.common import SPACE, stored, text_of

#: Code points of the normalised text that the second refinement looks at.
PREFIX = 64

#: Bits of the table of repeated (length, prefix): 2**22 bits are 65,536 longs, 1 MB.
FILTER_BITS = 22


def normalised(text: Column | None = None) -> Column:
    return F.regexp_replace(text_of() if text is None else text, f"{SPACE}+", "")


def _keyed(docs: DataFrame, columns: list[str], prefix: int) -> DataFrame:
    plain = normalised()
    return docs.select(
        *columns,
        F.char_length(text_of()).cast("long").alias("__chars"),
        plain.alias("__plain"),
        F.char_length(plain).alias("__length"),
        F.xxhash64(F.substring(plain, 1, prefix)).alias("__prefix"),
    )


def _slot(bits: int) -> Column:
    return F.pmod(F.xxhash64("__length", "__prefix"), F.lit(1 << bits))


def repeated_keys(docs: DataFrame, prefix: int = PREFIX, bits: int = FILTER_BITS) -> DataFrame:
    """Bit table (word number, bits) of the (length, prefix hash) pairs met twice or more.

    Lengths met once drop out first; of the rest the pairs are counted. At most
    2**bits / 64 rows, however many documents there are.
    """
    keys = _keyed(docs, [], prefix).groupBy("__length", "__prefix").agg(F.count(F.lit(1)).alias("__n"))
    keys = stored(keys, "dedup-keys")
    lengths = (
        keys.groupBy("__length")
        .agg(F.sum("__n").alias("__rows"))
        .filter(F.col("__rows") > 1)
        .select("__length")
    )
    slot = _slot(bits)
    return (
        keys.filter(F.col("__n") > 1)
        .join(lengths, "__length", "left_semi")
        .groupBy((slot / 64).cast("int").alias("__word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(pmod(xxhash64(__length, __prefix), "
                             f"{1 << bits}), 64) as int))")).alias("__bits"))
    )


def exact_dedup(
    docs: DataFrame,
    carry: list[str] | None = None,
    prefix: int = PREFIX,
    bits: int = FILTER_BITS,
) -> DataFrame:
    """One row per document: the ``carry`` columns (default doc_id) as they came, and
    ``__keep_id``, ``__size`` (rows of the group), ``__kept``. An empty table gives an empty result."""
    carry = carry or ["doc_id"]
    columns = [F.struct(*carry).alias("__row"), F.col("doc_id").alias("__id")]
    flags = stored(repeated_keys(docs, prefix, bits), "dedup-filter")
    # at most 2**bits / 64 rows of 12 bytes
    probed = (
        _keyed(docs, columns, prefix)
        .withColumn("__slot", _slot(bits))
        .withColumn("__word", (F.col("__slot") / 64).cast("int"))
        .join(F.broadcast(flags), "__word", "left")
        .withColumn("__maybe", F.expr("coalesce(__bits & shiftleft(1L, cast(pmod(__slot, 64) as int)), 0) <> 0"))
    )
    alone = probed.filter(~F.col("__maybe")).select(
        "__row.*",
        F.col("__id").alias("__keep_id"),
        F.lit(1).cast("long").alias("__size"),
        F.lit(True).alias("__kept"),
    )
    full = probed.filter("__maybe").select(
        "__row", "__id", "__chars", "__length", "__prefix",
        F.unhex(F.sha2(F.encode("__plain", "utf-8"), 256)).alias("__digest"),
    )
    # the group's best row: most code points, then smallest id; nulls come last
    best = full.groupBy("__length", "__prefix", "__digest").agg(
        F.count(F.lit(1)).alias("__size"),
        F.min(F.struct((-F.col("__chars")).alias("__fewer"), F.col("__id").isNull().alias("__none"), F.col("__id").alias("__at")))
        .alias("__best"),
    ).select(
        F.col("__digest").alias("__of"), "__size",
        F.col("__best.__at").alias("__keep_id"), (-F.col("__best.__fewer")).alias("__most"),
    )
    # rows of one document in one group: several only where rows are repeated
    same = Window.partitionBy("__digest", "__id").orderBy(F.desc("__chars"))
    copies = (
        full.withColumn("__nth", F.row_number().over(same))
        .join(best, F.col("__digest") == F.col("__of"))
        .select(
            "__row.*",
            "__keep_id",
            "__size",
            (F.col("__id").eqNullSafe(F.col("__keep_id")) & (F.col("__nth") == 1)).alias("__kept"),
        )
    )
    return alone.unionByName(copies)


def deduplicated(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns, whatever their names: the row travels as one
    struct under a name that neither the input nor the helper columns use."""
    payload = "document"
    while payload in docs.columns:
        payload += "_"
    wrapped = docs.select(
        F.col("doc_id"), F.col("text"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias(payload)
    )
    return exact_dedup(wrapped, [payload]).filter("__kept").select(f"{payload}.*")
