"""Joining the sources by city and minute, and readings with the city dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions import parse_event_time
from aerostrata.schemas import WEATHER_METRICS

MINUTE_KEY = ("city", "join_time")

MINUTE_HASH = "xxhash64(city, join_time)"
#: Rows of one key that a task joins without help; heavy keys that are looked for, and keys a sketch keeps.
HEAVY_ROWS = 100_000
HEAVIEST = 100
SKETCHED = 10_000
#: Weather values of one key that travel together in one array. A clean minute has no more than 60; a task holds the rows
#: that one reading gives with three arrays.
GATHERED = 64

#: Largest right side, in bytes, that may be copied to every executor.
BROADCAST_LIMIT = 64 * 1024 * 1024


def with_minute(df: DataFrame) -> DataFrame:
    """Add ``join_time``: the event time cut to the minute."""
    time = F.col("timestamp_utc")
    if df.schema["timestamp_utc"].dataType.typeName() == "string":
        time = parse_event_time(time)
    return df.withColumn("join_time", F.date_trunc("minute", time))


def join_minute_left(readings: DataFrame, source: DataFrame | None, metric: str) -> DataFrame:
    """Left join of one weather metric on (city, minute); a missing source gives typed nulls.

    The join is many-to-many: every reading meets every source row of its minute. On clean
    tables a side has one row per (city, second), hence at most 60 per key. Averages over the
    joined rows do not need them built: see ``aggregates.hourly_means``.
    """
    if source is None:
        return _absent(readings, metric)
    return readings.join(with_minute(source).select(*MINUTE_KEY, metric), [*MINUTE_KEY], "left")


def _absent(readings: DataFrame, metric: str) -> DataFrame:
    return readings.withColumn(metric, F.lit(None).cast("double"))


def _gathered(source: DataFrame, metric: str, on: list[str], parts: int, heavy: Column | None) -> DataFrame:
    """The values of each key in arrays, nulls included, of ``GATHERED`` at most; a key with more has several rows."""
    narrow = with_minute(source).select(*MINUTE_KEY, metric)
    if heavy is not None:
        every = F.when(heavy, F.sequence(F.lit(0), F.lit(parts - 1))).otherwise(F.array(F.lit(0)))
        narrow = narrow.withColumn("_part", F.explode(every))
    place = F.row_number().over(Window.partitionBy(*on).orderBy(metric))
    values = F.collect_list(F.struct(metric))[metric].alias(f"_{metric}")
    return narrow.withColumn("_row", F.floor((place - 1) / GATHERED)).groupBy(*on, "_row").agg(values).drop("_row")


def heavy_minutes(readings: DataFrame, most: int = HEAVY_ROWS) -> list[int]:
    """Hashes of the (city, minute) keys that hold more than ``most`` rows, as far as a sketch of frequent items tells.

    One aggregation, whose sketches the tasks send instead of rows. At most ``HEAVIEST`` keys; one that is missed, or whose
    hash another key shares, changes how rows are dealt to tasks and nothing else.
    """
    top = F.expr(f"approx_top_k({MINUTE_HASH}, {HEAVIEST}, {SKETCHED})")
    found = with_minute(readings).agg(top.alias("top")).select(F.inline("top")).collect()
    return [r["item"] for r in found if r["count"] > most and r["item"] is not None]


def join_weather_chain(
    air: DataFrame,
    wind: DataFrame | None = None,
    temperature: DataFrame | None = None,
    humidity: DataFrame | None = None,
    parts: int = 1,
    most: int = HEAVY_ROWS,
) -> DataFrame:
    """Air readings with up to three weather metrics of the same city and minute.

    The input is clean, with one row per city and second; every row of a minute meets every other, so
    a minute with more rows is as many times larger. All joins share one key, so the rows joined so
    far are shuffled once. The weather values of a minute travel as arrays, which are unfolded when all joins are done: a
    row of the result then costs a step of a loop and no look-up. For input with hot minutes ``parts`` splits the air rows of those that hold more than ``most`` of
    them (see ``heavy_minutes``) over so many keys and repeats their weather rows for each; all other rows are
    shuffled as they are. The result is the same.
    """
    joined, on, heavy = with_minute(air), [*MINUTE_KEY], None
    keys = heavy_minutes(air, most) if parts > 1 else []
    if keys:
        heavy = F.expr(MINUTE_HASH).isin(keys)
        spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in air.columns]), F.lit(parts)).cast("int")
        joined, on = joined.withColumn("_part", F.when(heavy, spread).otherwise(0)), [*on, "_part"]
    # A fixed number of tasks: adaptive execution goes by bytes, and makes few tasks of the few bytes of very many rows.
    tasks = int(air.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    joined = joined.repartition(tasks, *on)
    sources = dict(zip(WEATHER_METRICS, (wind, temperature, humidity)))
    for metric, source in sources.items():
        if source is not None:
            joined = joined.join(_gathered(source, metric, on, parts, heavy), on, "left")
    joined, unfolded = joined.drop("_part"), None
    for metric, source in sources.items():
        if source is None:
            joined = _absent(joined, metric)
        else:
            joined = joined.where(_interpreted(unfolded)) if unfolded else joined
            joined = joined.select("*", F.explode_outer(f"_{metric}").alias(metric)).drop(f"_{metric}")
            unfolded = metric
    return joined


def _interpreted(column: str) -> Column:
    """True for every row, by an expression that Spark does not compile.

    Spark compiles unfoldings that follow each other to one loop, which copies all rows of an input row before it hands on
    the first. With this filter between them each is a loop of its own, which holds the rows of one array.
    """
    return F.exists(F.array(F.lit(True)), lambda true: true | F.col(column).isNull())


def measured_bytes(df: DataFrame) -> int:
    """Upper estimate of the in-memory size of a frame, from one distributed aggregation."""
    text = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    fixed = 16 * len(df.columns) + 32
    width = F.lit(fixed)
    for name in text:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """Whether a frame may be copied to every executor; runs one aggregation."""
    return measured_bytes(df) <= limit


def enrich_static(df: DataFrame, dimension: DataFrame, small: bool = False) -> DataFrame:
    """Left join with the city dimension, which is broadcast if the caller has measured it to be ``small``.

    Otherwise a batch query leaves the choice to adaptive execution. A stream, whose plans run without it, shuffles
    both sides by city; there the left side is the window rows, one per city and window.
    """
    return df.join(F.broadcast(dimension) if small else dimension, "city", "left")
