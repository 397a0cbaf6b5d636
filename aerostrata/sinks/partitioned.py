"""Parquet writes partitioned by column. Each returns how many rows it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from aerostrata.schemas import PARTITION_KEYS


def balanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Gather each partition's rows in few files of a good size.

    Rebalancing lets adaptive execution join small partitions into one task and split a large one
    over several, so one day that holds a third of the rows is still written in parallel.
    """
    return df.hint("rebalance", *by)


def counted_write(df: DataFrame, write: Callable[[DataFrame], None]) -> int:
    """Write ``df`` and return its number of rows, counted on the way.

    The count stands directly under the write: anywhere below, the optimizer may replace it together with a part of
    the plan that turns out to be empty.
    """
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


def append(
    df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_KEYS, sort_by: Sequence[str] = ()
) -> int:
    """Plain append; running it twice writes the rows twice. Files sorted by a column let readers skip parts of them."""
    rows = balanced(df, partition_by)
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    return counted_write(rows, lambda r: r.write.mode("append").partitionBy(*partition_by).parquet(path))


def overwrite_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str] = PARTITION_KEYS
) -> int:
    """Replace the partitions that occur in the frame and leave all others as they are."""
    return counted_write(
        balanced(df, partition_by),
        lambda r: r.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path),
    )
