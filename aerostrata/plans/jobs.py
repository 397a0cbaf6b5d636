"""Batch and stream jobs over one storage root.

Below the root: ``collect-data/<kind folder>`` holds raw JSON, ``clean-data/<kind folder>`` the
clean tables, ``batch/hourly`` and ``batch/daily`` the facts, ``documents/<name>`` the documents.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerostrata.functions.times import EVENT_TIME_PATTERN
from aerostrata.operators import documents
from aerostrata.operators.aggregates import daily_rollup, hourly_means
from aerostrata.operators.cleaning import DEDUPE_KEY, clean
from aerostrata.operators.joins import is_small
from aerostrata.operators.quality import dq_report
from aerostrata.operators.trends import in_period, with_trend
from aerostrata.schemas import AIR, HUMIDITY, KINDS, PARTITION_KEYS, TEMPERATURE, WIND, Kind
from aerostrata.session import session_setting
from aerostrata.sinks import keyed
from aerostrata.sinks.keyed import kept, new_rows, read_keyed, upsert
from aerostrata.sinks.partitioned import append, balanced, counted_write, overwrite_partitions
from aerostrata.sources.payloads import metric_records, shape_air, weather_metrics
from aerostrata.sources.raw import HourScope, arriving_lines, read_lines, read_raw, well_formed
from aerostrata.sources.tables import day_folder, existing, month_folders, read_folders, read_table
from aerostrata.streaming.outputs import DOCUMENT_PARTITION, start_documents
from aerostrata.streaming.readings import ten_minute_categories, ten_minute_statistics

HOURLY_KEY = ("city", "hour")
DOCUMENT_KEY = ("doc_id",)
DOCUMENT_DAY = ("doc_day",)
CLEAN_ORDER = ("timestamp_utc",)
#: Partition and key columns of each document table.
DOCUMENTS = {
    "hourly": (DOCUMENT_DAY, DOCUMENT_KEY),
    "pm25": (DOCUMENT_DAY, DOCUMENT_KEY),
    "weather_pairs": (DOCUMENT_DAY, DOCUMENT_KEY),
    "statistics": (DOCUMENT_PARTITION, ("doc_id",)),
    "categories": (DOCUMENT_PARTITION, ("pivot_doc_id",)),
}
#: With more hours than this their days are computed as a whole.
MANY_HOURS = 500


@dataclass(frozen=True)
class Layout:
    """Paths below the storage root."""

    # Folder names below the root, so that stored data are found where they are.
    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/collect-data"

    def clean(self, kind: Kind) -> str:
        return f"{self.root}/clean-data/{kind.folder}"

    @property
    def hourly(self) -> str:
        return f"{self.root}/batch/hourly"

    @property
    def daily(self) -> str:
        return f"{self.root}/batch/daily"

    @property
    def pending(self) -> str:
        """Event hours whose clean rows are stored, but not yet their means and documents."""
        return f"{self.root}/pending"

    @property
    def quality(self) -> str:
        return f"{self.root}/quality"

    @property
    def losses(self) -> str:
        """What the streams dropped, by query and micro-batch."""
        return f"{self.root}/losses"

    def documents(self, name: str) -> str:
        return f"{self.root}/documents/{name}"

    def checkpoint(self, name: str) -> str:
        return f"{self.root}/checkpoints/{name}"


@dataclass(frozen=True)
class Report:
    """Outcome of a job; ``rows`` is None where the input was absent."""

    job: str
    rows: int | None = None
    parts: dict[str, int | None] = field(default_factory=dict)


def read_hourly(spark: SparkSession, layout: Layout, folders: Sequence[str] | None = None) -> DataFrame | None:
    """The newest hourly facts, of some partition folders or all; None if there are none."""
    return read_keyed(spark, layout.hourly, [*PARTITION_KEYS, *HOURLY_KEY], folders)


def read_documents(spark: SparkSession, layout: Layout, name: str) -> DataFrame | None:
    """The newest documents of a table, or None if there are none."""
    parts, key = DOCUMENTS[name]
    return read_keyed(spark, layout.documents(name), [*parts, *key])


def mark_hours(fresh: DataFrame, layout: Layout) -> None:
    """Store the event hours of rows that are about to be stored; they stay until ``hourly_run`` has computed them."""
    hour = F.substring("timestamp_utc", 12, 2).cast("int").alias("hour")
    fresh.select(*PARTITION_KEYS, hour).distinct().write.parquet(f"{layout.pending}/{uuid.uuid4().hex}")


def pending_hours(spark: SparkSession, layout: Layout) -> tuple[list[str], set[HourScope]]:
    """(folders of marks that are complete, the hours in them); the calendar bounds the hours."""
    there = [f"{layout.pending}/{name}" for name in keyed.names_in(spark, layout.pending)]
    marks = [f for f in there if existing(spark, f"{f}/_SUCCESS")]
    if not marks:
        return [], set()
    rows = spark.read.schema("year int, month int, day int, hour int").parquet(*marks).distinct().toLocalIterator()
    return marks, {HourScope(r.year, r.month, r.day, r.hour) for r in rows}


def _store_clean(raw: DataFrame, layout: Layout, kind: Kind, mode: str) -> int:
    """Store the valid rows of raw records; returns how many there are, stored before or not."""
    path = layout.clean(kind)
    with kept(clean(raw, kind)) as once:
        fresh = once if mode == "append" else new_rows(once, path, DEDUPE_KEY)
        mark_hours(fresh, layout)
        append(fresh, path, sort_by=CLEAN_ORDER)
        return once.count()


def _clean_arrived(spark: SparkSession, layout: Layout, kind: Kind, max_files: int | None) -> int | None:
    """Clean the files that have landed since the last call.

    A checkpoint keeps the names of the files it has seen. A call that stops is repeated with the
    same files, of which the rows that were stored are not stored again.
    """
    if not existing(spark, f"{layout.raw}/{kind.folder}"):
        return None
    rows = 0

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal rows
        # a stream's own session plans without adaptive execution, which its state needs; there is none here
        with session_setting(batch.sparkSession, "spark.sql.adaptive.enabled", "true"):
            rows += _store_clean(well_formed(batch, kind.schema), layout, kind, "merge")

    lines = arriving_lines(spark, layout.raw, kind, max_files)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", layout.checkpoint(f"clean-{kind.name}"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return rows


def clean_kind(
    spark: SparkSession, layout: Layout, kind: Kind, scope: HourScope | None = None, mode: str = "merge",
    max_files: int | None = None,
) -> int | None:
    """Clean one kind; returns the number of valid rows read, or None if nothing has landed.

    ``mode="append"`` writes all valid rows again on a re-run, ``"merge"`` only those whose
    city and second are not stored. Without a scope ``"merge"`` reads only files it has not read before, all of them together
    or ``max_files`` at a time; copies of a reading are resolved within what is read together, and by arrival after that.
    """
    if mode not in ("merge", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    if scope is None and mode == "merge":
        return _clean_arrived(spark, layout, kind, max_files)
    raw = read_raw(spark, layout.raw, kind, scope)
    return None if raw is None else _store_clean(raw, layout, kind, mode)


def side_by_side(spark: SparkSession, *tasks: Callable[[], object]) -> list:
    """Run independent jobs at a time; the cluster shares its cores among them."""
    with ThreadPoolExecutor(max_workers=len(tasks)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]


def _clean_all(
    spark: SparkSession, layout: Layout, scope: HourScope | None, kinds: Sequence[Kind], mode: str
) -> dict[str, int | None]:
    done = side_by_side(spark, *[lambda k=k: clean_kind(spark, layout, k, scope, mode) for k in kinds])
    return {kind.name: rows for kind, rows in zip(kinds, done)}


def _clean_report(counts: dict[str, int | None]) -> Report:
    return Report("clean", sum(n or 0 for n in counts.values()), counts)


def clean_job(
    spark: SparkSession,
    layout: Layout,
    scope: HourScope | None = None,
    kinds: Sequence[Kind] = tuple(KINDS.values()),
    mode: str = "merge",
) -> Report:
    """Clean every kind, side by side. A kind that has not landed is skipped, the others still run."""
    return _clean_report(_clean_all(spark, layout, scope, kinds, mode))


def _hour_text(scope: HourScope) -> str:
    return f"{scope.year:04d}-{scope.month:02d}-{scope.day:02d}T{scope.hour:02d}"


def _of_hours(table: DataFrame, hours: Sequence[HourScope]) -> DataFrame:
    """Rows of some hours; the bounds on the time text let the scan skip parts of the files."""
    texts = sorted(map(_hour_text, hours))
    time = F.col("timestamp_utc")
    inside = (time >= texts[0]) & (time < texts[-1] + ":~")
    return table.filter(inside & F.substring(time, 1, 13).isin(texts))


def hourly_facts(
    spark: SparkSession, layout: Layout, hours: Sequence[HourScope] | None
) -> DataFrame | None:
    """Hourly means of some hours (of their days, if they are many), or of everything; None without air readings."""

    def source(kind: Kind) -> DataFrame | None:
        path = layout.clean(kind)
        if hours is None:
            return read_table(spark, path)
        days = sorted({day_folder(h.year, h.month, h.day) for h in hours})
        table = read_folders(spark, path, days)
        return table if table is None or len(hours) > MANY_HOURS else _of_hours(table, hours)

    air = source(AIR)
    if air is None:
        return None
    # readings meet within a minute, so the hours can be picked ahead of the joins
    return hourly_means(air, source(WIND), source(TEMPERATURE), source(HUMIDITY))


def hourly_job(
    spark: SparkSession,
    layout: Layout,
    scope: HourScope | None = None,
    mode: str = "merge",
    hours: Sequence[HourScope] | None = None,
) -> Report:
    """Write hourly means of an hour, of some ``hours``, or of everything; a re-run replaces their rows unless ``mode="append"``."""
    if mode not in ("merge", "append"):
        raise ValueError(f"unknown mode {mode!r}")
    picked = hours if hours is not None else None if scope is None else [scope]
    facts = hourly_facts(spark, layout, picked)
    if facts is None:
        return Report("hourly")
    if mode == "append":
        # an hour that is written twice is stored twice, and read by its newest version
        version = keyed.stamped(facts, keyed.next_version(spark, layout.hourly))
        return Report("hourly", append(version, layout.hourly, [*PARTITION_KEYS, keyed.VERSION]))
    return Report("hourly", upsert(facts, layout.hourly, HOURLY_KEY, unique=True))


def daily_facts(hourly: DataFrame) -> DataFrame:
    """City-day rollup with trend."""
    return with_trend(daily_rollup(hourly))


def daily_job(
    spark: SparkSession, layout: Layout, year: int, month: int, day: int | None = None
) -> Report:
    """Rewrite the daily partitions of a month or a day.

    Two months are read, so that the first day of the month has its predecessor.
    """
    hourly = read_hourly(spark, layout, month_folders(year, month))
    if hourly is None:
        return Report("daily")
    return Report("daily", overwrite_partitions(in_period(daily_facts(hourly), year, month, day), layout.daily))


EXPORTS = {
    "hourly": (documents.hourly_documents, "@timestamp"),
    "pm25": (documents.pm25_documents, "timestamp"),
    "weather_pairs": (documents.weather_pair_documents, "timestamp"),
}


def export_job(
    spark: SparkSession,
    layout: Layout,
    name: str,
    year: int | None = None,
    month: int | None = None,
    day: int | None = None,
    days: Sequence[tuple[int, int, int]] | None = None,
) -> Report:
    """Merge the hourly table, one month or day of it, or some days, into a document table."""
    if days is not None:
        folders = [day_folder(*d) for d in days]
    elif year is not None and month is not None:
        folders = [f"year={year}/month={month}" + ("" if day is None else f"/day={day}")]
    elif (year, month, day) == (None, None, None):
        folders = None
    else:
        raise ValueError("give year and month, and optionally day, or none of them")
    hourly = read_hourly(spark, layout, folders)
    if hourly is None:
        return Report(f"export {name}", 0 if existing(spark, layout.hourly) else None)
    shape, time = EXPORTS[name]
    found = shape(hourly).withColumn("doc_day", F.to_date(time))
    # an hourly row gives one document, and the id follows from its key
    return Report(f"export {name}", upsert(found, layout.documents(name), DOCUMENT_KEY, DOCUMENT_DAY, unique=True))


def hourly_run(spark: SparkSession, layout: Layout, scope: HourScope | None = None) -> list[Report]:
    """Clean, then hourly means, then the two hourly exports.

    A given hour is that of arrival. Readings may belong to earlier hours, so the hours of all
    readings that were stored are computed again, with the given one. They are marked before the readings are stored and until
    the documents are, so a run after one that stopped anywhere, or after other ``clean`` jobs, computes them.
    """
    done = _clean_all(spark, layout, scope, tuple(KINDS.values()), "merge")
    marks, waiting = pending_hours(spark, layout)
    hours = days = None
    if scope is not None:
        hours = sorted({scope, *waiting}, key=_hour_text)
        days = sorted({(h.year, h.month, h.day) for h in hours})
    hourly = hourly_job(spark, layout, hours=hours)
    exports = side_by_side(
        spark, *[lambda n=n: export_job(spark, layout, n, days=days) for n in ("hourly", "weather_pairs")]
    )
    for mark in marks:
        keyed.remove(spark, mark)
    return [_clean_report(done), hourly, *exports]


def compact_job(
    spark: SparkSession, layout: Layout, many: int = keyed.MANY_VERSIONS, grace: float = keyed.GRACE
) -> Report:
    """Bound the history of the hourly and all document tables; ``rows`` is the number of partitions written anew."""
    tables = {"hourly facts": (layout.hourly, PARTITION_KEYS, HOURLY_KEY)}
    tables |= {f"{name} documents": (layout.documents(name), *of) for name, of in DOCUMENTS.items()}
    counts = {}
    for name, (path, parts, key) in tables.items():
        there = existing(spark, path)
        counts[name] = keyed.compact(spark, path, [*parts, *key], parts, many=many, grace=grace) if there else None
    return Report("compact", sum(n or 0 for n in counts.values()), counts)


def quality_job(spark: SparkSession, layout: Layout, scope: HourScope | None = None) -> Report:
    """Store the quality report of every landed kind: of everything, or of an arrival hour."""
    counts: dict[str, int | None] = {}
    for kind in KINDS.values():
        lines = read_lines(spark, layout.raw, kind, scope)
        counts[kind.name] = None
        if lines is None:
            continue
        folder = "all" if scope is None else _hour_text(scope)
        path = f"{layout.quality}/kind={kind.name}/scope={folder}"
        counts[kind.name] = counted_write(dq_report(lines, kind), lambda r: r.write.mode("overwrite").parquet(path))
    return Report("quality", sum(n or 0 for n in counts.values()), counts)


def _land_records(layout: Layout, kind: Kind, records: DataFrame) -> int:
    """Append records as JSON lines by hour of receipt; returns their number."""
    received = F.to_timestamp("timestamp_utc", EVENT_TIME_PATTERN)
    patterns = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    lines = records.select(
        F.to_json(F.struct(*records.columns)).alias("value"),
        *[F.date_format(received, p).alias(c) for c, p in patterns.items()],
    )
    folder = f"{layout.raw}/{kind.folder}"
    return counted_write(balanced(lines, tuple(patterns)), lambda r: r.write.mode("append").partitionBy(*patterns).text(folder))


def shape_job(layout: Layout, air: DataFrame, weather: DataFrame, local_zone: str = "UTC") -> Report:
    """Land the records of API payloads (city, received_at, payload) as raw JSON lines; weather payloads are parsed once."""
    counts = {AIR.name: _land_records(layout, AIR, shape_air(air, local_zone))}
    with kept(weather_metrics(weather)) as metrics:
        for kind in (WIND, TEMPERATURE, HUMIDITY):
            counts[kind.name] = _land_records(layout, kind, metric_records(metrics, kind.metric))
    return Report("shape", sum(counts.values()), counts)


def daily_run(
    spark: SparkSession, layout: Layout, year: int, month: int, day: int | None = None
) -> list[Report]:
    """Daily facts, then the PM2.5 export."""
    return [
        daily_job(spark, layout, year, month, day),
        export_job(spark, layout, "pm25", year, month, day),
    ]


def stream_job(
    messages: DataFrame, dimension: DataFrame, layout: Layout, available_now: bool = False
) -> list[StreamingQuery]:
    """Start the statistics and the category query over one message stream.

    The dimension is measured once, before the stream starts; its files are fixed then, too.
    """
    return [
        start_documents(
            ten_minute_statistics(messages, dimension, is_small(dimension)),
            layout.documents("statistics"),
            "doc_id",
            layout.checkpoint("statistics"),
            available_now,
            name="statistics",
        ),
        start_documents(
            ten_minute_categories(messages),
            layout.documents("categories"),
            "pivot_doc_id",
            layout.checkpoint("categories"),
            available_now,
            name="categories",
        ),
    ]
