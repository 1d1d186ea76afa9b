"""Connected components of an edge table by alternating large-star and small-star steps.

Each step links the neighbours of a node to the smallest one, first those greater than
the node, then the others. Minima are aggregates that combine before the shuffle and
meet the edges again in a join, which adaptive execution splits for hot nodes; no task gathers a node's
neighbours. Every round is stored in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelake.llm.common import stored


def _with_minimum(edges: DataFrame) -> DataFrame:
    least = edges.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
    return edges.join(least, edges.u == least.w).select("u", "v", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    linked = _with_minimum(both)
    return linked.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    linked = _with_minimum(down)
    kept = linked.select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = linked.select("u", F.col("m").alias("v"))
    return kept.unionByName(own).filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (u, v; longs) that is not its own root; the root is
    the component's smallest node. Loops and repeated edges do no harm; no edges give no rows."""
    edges = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(),
        "edges",
    )
    mark = _mark(edges)
    while mark[0]:
        edges = stored(_small_star(stored(_large_star(edges), "large-star")), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
