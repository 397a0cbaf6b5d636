"""Helpers the operators share: shared working tables, folds, Arrow maps over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.session import working_path

FOLDS = 5
#: Whole texts are long: what a task reads, or hands to Python, at a time is bounded, not the rows of all batches.
BATCH_SETTINGS = {
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}


def workers_import(spark: SparkSession) -> None:
    """Let Python workers on this machine import the library; on a cluster it is shipped with the job.

    Sizes of batches are set where the session leaves them open.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    for key in BATCH_SETTINGS.keys() - spark.conf.getAll.keys():
        spark.conf.set(key, BATCH_SETTINGS[key])


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{folder}/{table}.parquet")


def fold(id_column: str) -> Column:
    """crc32 of the id as text, modulo 5; null ids count as empty text."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % FOLDS


def held_out(id_column: str) -> Column:
    """Rows no label is learnt from."""
    return fold(id_column) == 0


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: later steps neither recompute it nor lose it."""
    path = working_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that shuffles and sorts, whatever size Spark takes it for.

    For rows made by an explode and for tables of numbers that files hold in few bytes: Spark counts the rows before the
    explode, or the bytes of the files, and copies to the driver and every executor what takes many times that memory.
    """
    return df.hint("merge")


def texts_of(batch: pa.RecordBatch, column: int) -> list[str]:
    """A text column as a list; null counts as empty."""
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts hold about ``size`` bytes (one row at least), whatever the lengths are."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
        part = np.cumsum(lengths, dtype=np.int64) // size
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def filter_rows(docs: DataFrame, text_column: str, keep: Callable[[list[str]], np.ndarray]) -> DataFrame:
    """The rows of ``docs`` whose text ``keep`` accepts, with all their columns; no shuffle."""
    column = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, column):
            yield batch.filter(pa.array(keep(texts_of(batch, column))))

    return docs.mapInArrow(run, docs.schema)
