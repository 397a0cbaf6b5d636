"""Connected components of links between identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aerostrata.llm.common import kept_table


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every identifier in ``links`` (a, b); the component is its smallest identifier.

    Alternates two rewritings of the links until they no longer change: every node links its larger
    neighbours to its smallest one, then every node links its smaller neighbours and itself to the
    smallest. A node with very many links only ever sends them on one by one; minima are combined
    before the shuffle. Each round is written to the shared folder, with a checksum that tells
    whether the links have changed.
    """
    low, high = F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")
    edges, before = _checked(links.select(low, high).where("low < high").distinct())
    while before[0]:
        both = edges.union(edges.select(F.col("high").alias("low"), F.col("low").alias("high")))
        lowest = both.groupBy(F.col("low").alias("node")).agg(F.min("high").alias("m"))
        lowest = lowest.select("node", F.least("node", "m").alias("m"))
        # Larger neighbours of each node go to the smallest of the node and its neighbours.
        large = kept_table(
            edges.join(lowest, edges.low == lowest.node).select(F.col("m").alias("low"), "high").where("low < high"), "links"
        )
        # Smaller neighbours of each node, and the node itself, go to the smallest of them.
        least = large.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("m"))
        small = large.join(least, large.high == least.node).select(F.col("m").alias("low"), F.col("low").alias("high"))
        small = small.where("low < high").union(least.select(F.col("m").alias("low"), F.col("node").alias("high")))
        edges, after = _checked(small.distinct())
        if after == before:
            break
        before = after
    # At the fixed point every link leads from a component's smallest to another of its nodes.
    found = edges.select(F.col("high").alias("id"), F.col("low").alias("component"))
    return found.union(edges.select(F.col("low").alias("id"), F.col("low").alias("component")).distinct())


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    """Distinct links, written, and their number and checksums."""
    seen = Observation()
    sums = [F.bit_xor(F.xxhash64(F.lit(i), "low", "high")).alias(f"sum{i}") for i in range(2)]
    table = kept_table(edges.observe(seen, F.count(F.lit(1)).alias("n"), *sums), "links")
    return table, (seen.get["n"], seen.get["sum0"], seen.get["sum1"])
