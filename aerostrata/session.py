"""Session set-up and the shared folder every job writes its working files to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

TIME_ZONE = "UTC"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(app_name: str, **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", TIME_ZONE)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Window state may outgrow executor heaps: keep it off-heap and on local disk,
        # with the change log in the checkpoint so that a lost executor costs a reload only.
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config(
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
        )
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def pin_time_zone(spark: SparkSession) -> SparkSession:
    """Event times carry no zone and mean UTC, so the session must read them as UTC."""
    spark.conf.set("spark.sql.session.timeZone", TIME_ZONE)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared working folder, from ``spark.checkpoint.dir``.

    A machine-local folder is used only where the setting is absent and the master is local.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="aerostrata-")


def working_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Set one session option for the length of a block."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
