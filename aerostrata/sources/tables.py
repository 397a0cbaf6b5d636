"""Reads of the partitioned Parquet tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.logger import PySparkLogger
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
QUERY_LOGGERS = ("DataFrameQueryContextLogger", "SQLQueryContextLogger")


@contextmanager
def _quiet() -> Iterator[None]:
    """Keep Spark from logging the stack of a failed read; here absence is an ordinary answer."""
    loggers = [PySparkLogger.getLogger(name) for name in QUERY_LOGGERS]
    before = [logger.disabled for logger in loggers]
    for logger in loggers:
        logger.disabled = True
    try:
        yield
    finally:
        for logger, disabled in zip(loggers, before):
            logger.disabled = disabled


def absent_as_none(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The frame of a read, or None if its path holds nothing. Other errors are raised."""
    try:
        with _quiet():
            return read()
    except AnalysisException as error:
        if error.getCondition() in ABSENT:
            return None
        raise


def existing(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table, or None if nothing has been written there yet."""
    return absent_as_none(lambda: spark.read.parquet(path))


def read_folders(
    spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType | None = None
) -> DataFrame | None:
    """Some partition folders of a table, or None if none of them is there; no other folder is listed."""
    there = [f"{path}/{f}" for f in folders if existing(spark, f"{path}/{f}")]
    if not there:
        return None
    reader = spark.read.option("basePath", path)
    if schema is not None:
        reader = reader.schema(schema)
    return absent_as_none(lambda: reader.parquet(*there))


def day_folder(year: int, month: int, day: int) -> str:
    return f"year={year}/month={month}/day={day}"


def read_day(spark: SparkSession, path: str, year: int, month: int, day: int) -> DataFrame | None:
    """One day of a table partitioned by day, or None if it holds none."""
    return read_folders(spark, path, [day_folder(year, month, day)])


def previous_month(year: int, month: int) -> tuple[int, int]:
    return (year, month - 1) if month > 1 else (year - 1, 12)


def month_folders(year: int, month: int) -> list[str]:
    """Folders of a month and of the one before it."""
    return [f"year={y}/month={m}" for y, m in ((year, month), previous_month(year, month))]


def month_and_previous(table: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of a month and of the one before it; a month without rows adds none."""
    before_year, before_month = previous_month(year, month)
    return table.filter(
        ((F.col("year") == year) & (F.col("month") == month))
        | ((F.col("year") == before_year) & (F.col("month") == before_month))
    )


def read_two_months(spark: SparkSession, path: str, year: int, month: int) -> DataFrame | None:
    """A month and the one before it, or None if the table holds neither."""
    return read_folders(spark, path, month_folders(year, month))
