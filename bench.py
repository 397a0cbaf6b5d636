"""Timings of the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query runs once to warm up
and then ``BENCH_RUNS`` times; the median counts. Results are computed in full and thrown away. A query that
fails is named under ``failed`` and does not keep the others from being timed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from aerostrata.plans import catalog, jobs  # noqa: E402
from aerostrata.plans.catalog import registered  # noqa: E402
from aerostrata.session import working_path  # noqa: E402
from aerostrata.sinks.keyed import upsert  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
CPUS = int(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "scan_raw_json",
    "clean_air",
    "dq_report",
    "join_weather_chain",
    "hourly_aggregate",
    "daily_trend",
    "window_10min",
    "pivot_category",
    "export_hourly",
    "sink_upsert",
    "stream_10min",
    "stream_pivot",
    "hourly_hour",
)
#: Queries that write tables or run streams while they are built: one timed run is enough.
ONCE = ("scan_raw_json", "sink_upsert", "stream_10min", "stream_pivot", "hourly_hour")
HISTORY_DAYS = 1000


def seconds(query, spark: SparkSession) -> float:
    start = time.perf_counter()
    query(spark, FOLDER).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def prepared(spark: SparkSession) -> dict[str, Callable[[], object]]:
    """Jobs whose input is made first and not timed: an hourly run, the same again, an upsert into a long history."""
    layout = catalog.sample_storage(spark, FOLDER)
    run = lambda: jobs.hourly_run(spark, layout)
    path = working_path(spark, "history")
    days = spark.range(HISTORY_DAYS * 100).selectExpr(
        "date_add(date'2022-01-01', cast(id % 1000 as int)) AS doc_day", "cast(id AS string) AS doc_id", "id AS value"
    )
    upsert(days, path, ["doc_id"], ["doc_day"], unique=True)
    last = days.where("doc_day = date'2024-09-26'").selectExpr("doc_day", "doc_id", "value + 1 AS value")
    return {
        "hourly_run": run,
        "hourly_rerun": run,
        "upsert_with_history": lambda: upsert(last, path, ["doc_id"], ["doc_day"], unique=True),
    }


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    timings: dict[str, float] = {}
    failed: list[str] = []

    def measured(name: str, measure: Callable[[], float]) -> None:
        try:
            timings[name] = round(measure(), 3)
            print(f"{name}: {timings[name]:.2f}", file=sys.stderr)
        except Exception as error:
            failed.append(name)
            print(f"{name}: {error}", file=sys.stderr)

    def median_of(name: str) -> float:
        seconds(queries[name], spark)
        return statistics.median([seconds(queries[name], spark) for _ in range(1 if name in ONCE else RUNS)])

    for name in HEADLINE:
        measured(name, lambda: median_of(name))
    for name, action in prepared(spark).items():
        measured(name, lambda: timed(action))
    spark.stop()
    result = {
        "metric": "headline queries, total of medians",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": Path(FOLDER).name.removeprefix("sf"),
        "cpus": CPUS,
        "failed": failed,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
