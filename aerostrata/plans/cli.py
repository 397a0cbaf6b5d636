"""Command line of the jobs, for spark-submit: ``python -m aerostrata.plans.cli JOB --root PATH``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from aerostrata.plans import jobs
from aerostrata.schemas import KINDS
from aerostrata.session import get_session
from aerostrata.sinks import keyed
from aerostrata.sources.messages import read_message_files, read_topic
from aerostrata.sources.raw import HourScope
from aerostrata.streaming.losses import LossRecorder
from aerostrata.streaming.outputs import start_landing, supervise

PERIOD = ("year", "month", "day", "hour")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="aerostrata", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, text: str, period: Sequence[str] = ()) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        sub.add_argument("--root", required=True, help="storage root all executors can reach")
        for part in period:
            sub.add_argument(f"--{part}", type=int)
        return sub

    for name, text in (
        ("clean", "raw JSON to clean tables; one arrival hour, or all files not read before"),
        ("hourly", "clean tables to hourly means; the current UTC hour by default"),
    ):
        command(name, text, PERIOD).add_argument(
            "--mode", choices=("merge", "append"), default="merge"
        )
    command("daily", "hourly means to daily facts with trend", PERIOD[:3])
    command("export", "hourly means to documents", PERIOD[:3]).add_argument(
        "--name", choices=sorted(jobs.EXPORTS), required=True
    )
    command("hourly-run", "clean, hourly and both hourly exports; the current UTC hour by default", PERIOD).add_argument(
        "--all", action="store_true", help="everything that has landed"
    )
    command("dq", "quality report of the raw lines; one arrival hour, or everything", PERIOD)
    shape = command("shape", "API payloads (Parquet: city, received_at, payload) to raw JSON lines")
    shape.add_argument("--air", required=True, help="air-quality payloads")
    shape.add_argument("--weather", required=True, help="weather payloads")
    upkeep = command("compact", "bound the history of the hourly and document tables")
    upkeep.add_argument("--many", type=int, default=keyed.MANY_VERSIONS, help="versions of a partition that are put into one")
    upkeep.add_argument("--grace", type=float, default=keyed.GRACE, help="seconds replaced files stay for reads under way")
    command("daily-run", "daily, then the PM2.5 export", PERIOD[:3])

    stream = command("stream", "ten-minute statistics and category counts")
    stream.add_argument("--dimension", required=True, help="Parquet table: city, lat, lon, country")
    landing = command("land", "land one kind of message as raw JSON")
    landing.add_argument("--kind", choices=sorted(KINDS), required=True)
    for sub in (stream, landing):
        source = sub.add_mutually_exclusive_group(required=True)
        source.add_argument("--topic", help="Kafka topic; needs --servers")
        source.add_argument("--files", help="folder of JSON-line files")
        sub.add_argument("--servers", help="Kafka bootstrap servers")
        sub.add_argument("--available-now", action="store_true", help="process what is there, then end")
    return parser


def hour_of(args: argparse.Namespace) -> HourScope | None:
    return HourScope.of(args.year, args.month, args.day, args.hour)


def this_hour() -> HourScope:
    now = datetime.now(UTC)
    return HourScope(now.year, now.month, now.day, now.hour)


def month_of(args: argparse.Namespace) -> tuple[int, int, int | None]:
    """The given month and day, or the current UTC month."""
    if args.year is None and args.month is None and args.day is None:
        now = datetime.now(UTC)
        return now.year, now.month, None
    if args.year is None or args.month is None:
        raise ValueError("give year and month, and optionally day, or none of them")
    return args.year, args.month, args.day


def _messages(spark: SparkSession, args: argparse.Namespace):
    if args.files:
        return read_message_files(spark, args.files)
    if not args.servers:
        raise ValueError("--topic needs --servers")
    return read_topic(spark, args.servers, args.topic)


def run(spark: SparkSession, args: argparse.Namespace) -> list[jobs.Report]:
    """Run one job and return its reports; streams run until they end."""
    layout = jobs.Layout(args.root.rstrip("/"))
    if args.job == "clean":
        return [jobs.clean_job(spark, layout, hour_of(args), mode=args.mode)]
    if args.job == "hourly":
        return [jobs.hourly_job(spark, layout, hour_of(args) or this_hour(), args.mode)]
    if args.job == "daily":
        return [jobs.daily_job(spark, layout, *month_of(args))]
    if args.job == "export":
        return [jobs.export_job(spark, layout, args.name, args.year, args.month, args.day)]
    if args.job == "hourly-run":
        scope = None if args.all else hour_of(args) or this_hour()
        return jobs.hourly_run(spark, layout, scope)
    if args.job == "dq":
        return [jobs.quality_job(spark, layout, hour_of(args))]
    if args.job == "shape":
        return [jobs.shape_job(layout, spark.read.parquet(args.air), spark.read.parquet(args.weather))]
    if args.job == "compact":
        return [jobs.compact_job(spark, layout, args.many, args.grace)]
    if args.job == "daily-run":
        return jobs.daily_run(spark, layout, *month_of(args))

    messages = _messages(spark, args)
    recorder = LossRecorder(spark, layout.losses)
    if args.job == "stream":
        spark.streams.addListener(recorder)
        dimension = spark.read.parquet(args.dimension)
        queries = jobs.stream_job(messages, dimension, layout, args.available_now)
    else:
        kind = KINDS[args.kind]
        checkpoint = layout.checkpoint(f"land-{kind.name}")
        queries = [start_landing(messages, kind, layout.raw, checkpoint, args.available_now)]
    try:
        supervise(spark, queries, until_all_end=args.available_now)
        if args.job == "stream":
            for query in queries:
                recorder.wait(query)
    finally:
        if args.job == "stream":
            spark.streams.removeListener(recorder)
    return []


def main(argv: Sequence[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = get_session(f"aerostrata {args.job}")
    for report in run(spark, args):
        print(f"{report.job}: {report.rows} rows {report.parts or ''}".rstrip())


if __name__ == "__main__":
    main()
