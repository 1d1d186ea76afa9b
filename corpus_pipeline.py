"""Training corpus in stages: quality, exact copies, near copies, mixture, packing.

Every stage reads what its predecessor kept, as a stored table, and works on all of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotelake.llm import exact_dedup, packing, pfair_mixing, quality_knn, simhash
from quotelake.llm.common import stored, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the neighbours' votes reject go."""
    return quality_knn.accepted(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays."""
    return exact_dedup.deduplicated(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: 3-word shingles, 3 bits."""
    return simhash.one_per_group(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order that gives each source its weight in every stretch."""
    return pfair_mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("exact dedup", exact_copies),
    ("near dedup", near_copies),
    ("mixture", mixture),
    ("packing", packed),
]

#: Fingerprints and packing are beyond SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, over the documents of the folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
