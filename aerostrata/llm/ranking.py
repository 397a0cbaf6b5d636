"""Places in a total order, found by all tasks."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from aerostrata.llm.common import kept_table


def numbered(table: DataFrame, order: Sequence[Column], name: str = "place", sum_of: str | None = None) -> DataFrame:
    """``table`` with its 0-based place in the order of ``order``, and in ``before`` the sum of a column over the rows before it.

    Rows go to tasks by ranges of the order, so no task holds more than its share, and are counted there; the rows of
    smaller ranges are added afterwards. ``table`` should be a written table, as it is read once more for the ranges. Rows
    that tie on all of ``order`` should be the same, or a repeated task may deal them otherwise.
    """
    columns = table.columns
    summed = columns.index(sum_of) if sum_of else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            values = np.zeros(n, np.int64) if summed is None else np.asarray(batch.column(summed), np.int64)
            sums = total + np.cumsum(values)
            places = [np.arange(seen, seen + n), sums - values, values, np.full(n, part, np.int32)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, places)], [*columns, *extra])
            seen, total = seen + n, int(sums[-1]) if n else total

    extra = ("_at", "_before", "_value", "_part")
    more = [StructField(c, IntegerType() if c == "_part" else LongType()) for c in extra]
    ranges = table.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = kept_table(ranges.mapInArrow(run, StructType([*table.schema.fields, *more])), "ranges")
    # One row for each shuffle partition.
    parts = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.sum("_value").alias("v")).orderBy("_part").collect()
    bases, rows, total = [], 0, 0
    for r in parts:
        bases.append((r._part, rows, total))
        rows, total = rows + r.n, total + r.v
    base = F.broadcast(table.sparkSession.createDataFrame(bases, "_part int, _rows bigint, _sum bigint"))
    found = [(F.col("_at") + F.col("_rows")).alias(name)]
    if sum_of:
        found.append((F.col("_before") + F.col("_sum")).alias("before"))
    return placed.join(base, "_part").select(*[F.col(f"`{c}`") for c in columns], *found)
