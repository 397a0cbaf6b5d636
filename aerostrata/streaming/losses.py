"""What a stream loses: rows per micro-batch that the watermark and each rule dropped.

Counts of rows that reach a point are observed on their way; the watermark's count comes from the state operators. A
listener stores them when a micro-batch has ended, one row per query and micro-batch, so a repeated
micro-batch replaces its row.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

#: Names of the points where rows are counted: all messages, after the dedupe, complete ones, valid ones.
READ, DEDUPED, COMPLETE, VALID = "rows_read", "rows_deduped", "rows_complete", "rows_valid"
LOSSES = (
    "query string, batch bigint, started string, rows_read bigint, no_time bigint, late bigint, duplicate bigint, "
    "incomplete bigint, out_of_range bigint, valid bigint"
)


def observed(df: DataFrame, point: str, **also) -> DataFrame:
    """Count the rows that pass, and those of further conditions; nothing is added to the rows or the shuffles."""
    more = [F.count_if(test).alias(name) for name, test in also.items()]
    return df.observe(point, F.count(F.lit(1)).alias("rows"), *more)


def losses_of(progress) -> tuple | None:
    """A row of ``LOSSES`` from the progress of a micro-batch; None if its query counts nothing."""
    points = progress.observedMetrics
    if not {READ, DEDUPED, COMPLETE, VALID} <= points.keys():
        return None
    late = sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
    read, deduped, complete, valid = (points[p]["rows"] for p in (READ, DEDUPED, COMPLETE, VALID))
    no_time, lacking = points[READ]["no_time"], points[READ]["lacking"]  # the latter where incomplete rows go first
    duplicate = read - no_time - lacking - late - deduped
    dropped = (no_time, late, duplicate, lacking + deduped - complete, complete - valid)
    return (progress.name or str(progress.id), progress.batchId, progress.timestamp, read, *dropped, valid)


class LossRecorder(StreamingQueryListener):
    """Stores the losses of all named or counted queries of a session below a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.ended: dict[str, threading.Event] = {}
        self.failure: Exception | None = None

    def onQueryStarted(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event())

    def onQueryProgress(self, event) -> None:
        row = losses_of(event.progress)
        if row is None or not (row[3] or row[5]):
            return  # a micro-batch without messages that only moves the watermark
        try:
            store_losses(self.spark, self.path, row)
        except Exception as error:  # a listener cannot raise into the query
            self.failure = error

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.setdefault(str(event.runId), threading.Event()).set()

    def wait(self, query, seconds: float = 60) -> None:
        """Block until everything a query that has ended reported is stored."""
        if not self.ended.setdefault(str(query.runId), threading.Event()).wait(seconds):
            raise TimeoutError("the query's last report has not come")
        if self.failure is not None:
            raise self.failure


def store_losses(spark: SparkSession, path: str, row: tuple) -> None:
    """One row in the folder of its query and micro-batch."""
    frame = spark.createDataFrame([row], LOSSES).drop("query", "batch").coalesce(1)
    frame.write.mode("overwrite").parquet(f"{path}/query={row[0]}/batch={row[1]}")
