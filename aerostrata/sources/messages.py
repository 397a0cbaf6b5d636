"""Message streams: any streaming frame with one JSON object per row in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def broker_options(servers: str, topic: str) -> dict[str, str]:
    """Options of the Kafka source: one topic from its start, going on past expired offsets."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
    }


def read_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """A topic as a stream. Needs the spark-sql-kafka package on the class path."""
    return spark.readStream.format("kafka").options(**broker_options(servers, topic)).load()


def read_message_files(
    spark: SparkSession, path: str, files_per_batch: int | None = None
) -> DataFrame:
    """Text files of JSON lines as a stream, in order of modification time."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)
