"""Keyed Parquet tables: inserts of new keys, and upserts kept as versions. One writer per table at a time.

An upsert appends its rows under ``version=<number>`` below their partition and reads nothing that is stored, so its cost
follows its input and stored files stay as they are. Numbers come from a sequence in the table's folder, not from a
clock. Readers take the newest value per key and column. A version that is written again, as by a repeated micro-batch,
replaces its own folders. ``compact`` writes the newest values of a partition as one more version and removes the
versions below it once reads that may still use them have ended.

A key must determine its partition.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.operators.cleaning import first_per_key
from aerostrata.schemas import PARTITION_KEYS
from aerostrata.sinks.partitioned import append, overwrite_partitions
from aerostrata.sources.tables import absent_as_none, existing, read_folders

#: The version of a row, a partition column, and the names of the columns its writer gave.
VERSION, GIVEN = "version", "_given"
#: Folder of a table for its numbers; readers of the data pass over such names.
SEQUENCE = "_sequence"
#: Numbers a table keeps behind the last one.
KEPT_NUMBERS = 100
#: Versions of a partition that make it worth compacting, and seconds a replaced version stays for reads under way.
MANY_VERSIONS = 8
GRACE = 3600


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame for two passes. A lost block is recomputed from its source."""
    df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def touched_folders(df: DataFrame, partition_by: Sequence[str]) -> list[str]:
    """Relative folders of the partitions in a frame, as Spark names them.

    The driver lists them, as Spark does for any read of the table; days and hours are bounded by the calendar.
    """
    escape = df.sparkSession._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    found = df.select(*[F.col(c).cast("string").alias(c) for c in partition_by]).distinct()
    return ["/".join(escape(c, row[c]) for c in partition_by) for row in found.toLocalIterator()]


def insert_new(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = PARTITION_KEYS,
    prune: bool = True,
) -> int:
    """Append the rows whose key the table does not hold yet; returns their number.

    A re-run appends nothing, and one that was cut short appends what is missing. Stored files
    are never rewritten, and of the touched partitions only the columns of the key are read. ``prune=False``
    (a load of everything) compares with the whole table.
    """
    with kept(df) if prune else nullcontext(df) as incoming:
        return append(new_rows(incoming, path, keys, partition_by, prune), path, partition_by)


def new_rows(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = PARTITION_KEYS,
    prune: bool = True,
) -> DataFrame:
    """The rows of ``df`` whose key, a list of SQL expressions over its columns, the table does not hold yet."""
    spark = df.sparkSession
    if not existing(spark, path):
        return df
    if prune:
        stored = read_folders(spark, path, touched_folders(df, partition_by), df.schema)
    else:
        stored = absent_as_none(lambda: spark.read.schema(df.schema).parquet(path))
    if stored is None:
        return df
    on = [f"`{c}`" for c in partition_by] + list(keys)
    known = stored.select(*[F.expr(k).alias(f"_known{i}") for i, k in enumerate(on)])
    keyed = df.withColumns({f"_key{i}": F.expr(k) for i, k in enumerate(on)})
    same = [F.col(f"_key{i}").eqNullSafe(F.col(f"_known{i}")) for i in range(len(on))]
    return keyed.join(known, same, "left_anti").select(*[F.col(f"`{c}`") for c in df.columns])


def _files(spark: SparkSession, path: str):
    """(file system, Hadoop path) of a path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder, if it is there."""
    system, target = _files(spark, path)
    system.delete(target, True)


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in a folder; none if it is absent."""
    system, target = _files(spark, folder)
    return [s.getPath().getName() for s in system.listStatus(target)] if system.exists(target) else []


def _created(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it is there already."""
    system, target = _files(spark, path)
    system.mkdirs(target.getParent())
    try:
        if system.getUri().getScheme() == "file":  # Hadoop looks and creates in two steps there
            open(target.toUri().getPath(), "x").close()
            return True
        return system.createNewFile(target)
    except FileExistsError:
        return False
    except Exception as error:  # some file systems raise where others answer False
        if "FileAlreadyExists" in str(error):
            return False
        raise


def next_version(spark: SparkSession, path: str, owner: tuple[str, int] | None = None) -> int:
    """The next number of a table's sequence: a file that only one writer can create.

    Numbers of writes are even, so that a compaction finds an odd one after those it has read. ``owner``, the name of a
    query and the number of its micro-batch, gets the number it had before if the batch is repeated.
    """
    folder = f"{path}/{SEQUENCE}"
    names = names_in(spark, folder)
    if owner is not None:
        claim = f"batch-{owner[0]}-{owner[1]}-"
        for name in names:
            if name.startswith(claim):
                return int(name.removeprefix(claim))
    numbers = [int(n) for n in names if n.isdigit()]
    number = max(numbers, default=0) + 2
    while not _created(spark, f"{folder}/{number}"):
        number += 2
    if owner is not None:
        _created(spark, f"{folder}/{claim}{number}")
    for name in names:
        if int(name.rpartition("-")[2]) < number - 2 * KEPT_NUMBERS:
            remove(spark, f"{folder}/{name}")
    return number


def upsert(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = PARTITION_KEYS,
    order_by: Sequence[str | Column] | None = None,
    unique: bool = False,
    owner: tuple[str, int] | None = None,
) -> int:
    """Update the rows whose key is stored and insert the others, as a new version of them; returns their number.

    Columns of the frame replace stored values, nulls included; stored columns the frame lacks
    are kept. Among several rows of one key the first by ``order_by`` wins; a caller whose rows
    come from a grouping by the key says ``unique`` and saves that shuffle. Key and partition
    columns must not be null. ``owner`` names a micro-batch that may be repeated, see ``next_version``.
    """
    on = [*partition_by, *keys]
    rows = df if unique else first_per_key(df, on, order_by)
    return _write_version(rows, path, partition_by, next_version(df.sparkSession, path, owner))


def stamped(df: DataFrame, number: int) -> DataFrame:
    """The rows as those of a version."""
    return df.withColumns({GIVEN: F.array(*[F.lit(c) for c in df.columns]), VERSION: F.lit(number)})


def _write_version(df: DataFrame, path: str, partition_by: Sequence[str], number: int) -> int:
    return overwrite_partitions(stamped(df, number), path, [*partition_by, VERSION])


def _versions(spark: SparkSession, path: str, folders: Sequence[str] | None) -> DataFrame | None:
    """Rows of all versions with the columns any of them has."""
    if folders is None:
        return absent_as_none(lambda: spark.read.option("mergeSchema", True).parquet(path))
    there = [f"{path}/{f}" for f in folders if existing(spark, f"{path}/{f}")]
    if not there:
        return None
    return absent_as_none(lambda: spark.read.option("basePath", path).option("mergeSchema", True).parquet(*there))


def read_keyed(
    spark: SparkSession, path: str, on: Sequence[str], folders: Sequence[str] | None = None
) -> DataFrame | None:
    """The newest values of every key, or None if nothing is stored.

    ``on`` names the partition and key columns; ``folders`` limits the partitions read. A table that was written without
    versions is read as it is.
    """
    rows = _versions(spark, path, folders)
    if rows is None or VERSION not in rows.columns:
        return rows
    others = [c for c in rows.columns if c not in (*on, VERSION, GIVEN)]
    last = {c: F.when(F.array_contains(GIVEN, c), F.col(VERSION)) for c in others}
    newest = rows.groupBy(*[F.col(f"`{c}`") for c in on]).agg(
        *[F.max_by(F.col(f"`{c}`"), last[c]).alias(c) for c in others]
    )
    return newest.select(*[F.col(f"`{c}`") for c in rows.columns if c not in (VERSION, GIVEN)])


def compact(
    spark: SparkSession,
    path: str,
    on: Sequence[str],
    partition_by: Sequence[str] = PARTITION_KEYS,
    folders: Sequence[str] | None = None,
    many: int = MANY_VERSIONS,
    grace: float = GRACE,
) -> int:
    """Bound the history of a table, or of some partitions; returns how many partitions were written anew.

    Versions below a compacted one are removed if it is older than ``grace`` seconds. Then the newest values of each partition
    of ``many`` versions or more are written as the odd version that follows those read, in one folder, which
    Spark puts in place by one rename. Reads give the same before, between and after; one that began
    before the rename finds its files for the time of grace. A write under way has a higher number, and wins.
    """
    rows = _versions(spark, path, folders)
    if rows is None or VERSION not in rows.columns:
        return 0
    # Partitions and their versions; the calendar bounds the partitions, this job the versions.
    parts = [F.col(f"`{c}`") for c in partition_by]
    found = rows.groupBy(*parts).agg(F.sort_array(F.collect_set(VERSION)).alias("versions")).collect()
    done = 0
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    for r in found:
        folder = "/".join(escape(c, str(r[c])) for c in partition_by)
        whole = max((v for v in r.versions if v % 2), default=0)
        left = list(r.versions)
        if whole and _age(spark, f"{path}/{folder}/{VERSION}={whole}") >= grace:
            for v in [v for v in r.versions if v < whole]:
                remove(spark, f"{path}/{folder}/{VERSION}={v}")
                left.remove(v)
        if len([v for v in left if v >= whole]) >= many:
            newest = read_keyed(spark, path, on, [folder])
            _write_version(newest, path, partition_by, max(left) // 2 * 2 + 1)
            done += 1
    return done


def _age(spark: SparkSession, folder: str) -> float:
    """Seconds since a folder was put in place, by the clock of the file system's entries."""
    system, target = _files(spark, folder)
    return time.time() - system.getFileStatus(target).getModificationTime() / 1000
