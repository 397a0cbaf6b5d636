"""Writing streams: keyed documents per micro-batch, and raw landing."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from aerostrata.schemas import Kind
from aerostrata.session import session_setting
from aerostrata.sinks.keyed import upsert
from aerostrata.sinks.partitioned import append

# Fixed value: how often a continuous query starts a micro-batch.
TRIGGER = "120 seconds"
DOCUMENT_PARTITION = ("doc_day", "doc_hour")
#: Local property in which Spark keeps the identifier of the query whose batch is being run.
QUERY_ID = "sql.streaming.queryId"


def _triggered(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    if available_now:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=TRIGGER)


def document_part(name: str, time: str) -> Column:
    """Day or hour of a document."""
    return {"doc_day": F.to_date(time), "doc_hour": F.hour(time)}[name]


def document_writer(
    path: str,
    id_field: str | None = None,
    partition_by: Sequence[str] = DOCUMENT_PARTITION,
    time: str = "window_start",
    unique: bool = True,
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: merge by id, or append if there is none.

    A failed write raises, so the batch is not committed and runs again after a restart. The query's own identifier, which
    its checkpoint keeps, and the batch's number name the version, so a batch that had been written
    before it was committed replaces its files. Ids are unique within a batch unless ``unique`` is False.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        placed = batch.withColumns({c: document_part(c, time) for c in partition_by})
        # The stream's own session plans without adaptive execution, which its state needs; the
        # write is a batch query and needs it to spread the few touched partitions over tasks.
        with session_setting(batch.sparkSession, "spark.sql.adaptive.enabled", "true"):
            if id_field is None:
                append(placed, path, partition_by)
            else:
                query = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)
                owner = (query, batch_id) if query else None
                upsert(placed, path, [id_field], partition_by, unique=unique, owner=owner)

    return write


def start_documents(
    stream: DataFrame,
    path: str,
    id_field: str | None,
    checkpoint: str,
    available_now: bool = False,
    partition_by: Sequence[str] = DOCUMENT_PARTITION,
    name: str | None = None,
) -> StreamingQuery:
    """Start one update-mode query that keeps a document table current.

    A live stream touches the last hours only; to replay months, partition by day.
    """
    writer = (
        stream.writeStream.outputMode("update")
        .foreachBatch(document_writer(path, id_field, partition_by))
        .option("checkpointLocation", checkpoint)
    )
    return _triggered(writer if name is None else writer.queryName(name), available_now).start()


def start_landing(
    messages: DataFrame, kind: Kind, root: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Land the messages of one kind as JSON lines by UTC arrival hour.

    Each micro-batch is appended; the checkpoint records the offsets, so every message is landed at
    least once, and no log of the files grows with the history.
    """
    arrival = F.current_timestamp()
    line = F.regexp_replace(F.col("value").cast("string"), "[\\r\\n]+", " ")
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    landed = messages.select(
        line.alias("value"),
        *[F.date_format(arrival, pattern).alias(name) for name, pattern in parts.items()],
    )
    folder = f"{root.rstrip('/')}/{kind.folder}"

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("append").partitionBy(*parts).text(folder)

    writer = landed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _triggered(writer, available_now).start()


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery], until_all_end: bool = False) -> None:
    """Block while the queries run; as soon as one ends, stop the others, latest first, and raise its failure if it has one.

    Queries over all input there is end one by one: ``until_all_end`` waits for each that ends well.
    """
    running = list(queries)
    try:
        while running:
            spark.streams.resetTerminated()
            if all(q.isActive for q in running):
                spark.streams.awaitAnyTermination()
            ended = [q for q in running if not q.isActive]
            for query in ended:
                query.awaitTermination()  # raises what ended it
            running = [q for q in running if q not in ended]
            if ended and not until_all_end:
                return
    finally:
        for query in reversed(queries):
            if query.isActive:
                query.stop()
