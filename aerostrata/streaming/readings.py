"""From message bytes to clean, classified readings. The steps also run on batch frames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.functions import aqi_category, aqi_risk_score
from aerostrata.operators.aggregates import category_counts, window_stats
from aerostrata.operators.cleaning import (
    drop_required_nulls,
    normalize_city,
    range_filter,
    with_event_time,
)
from aerostrata.schemas import AIR, AIR_MESSAGE
from aerostrata.streaming.losses import COMPLETE, DEDUPED, READ, VALID, observed

# How late a message may come, the dedupe key and the columns that must be filled.
WATERMARK = "10 minutes"
DEDUPE_KEY = ("city", "timestamp_utc")
REQUIRED = ("city", "aqi")


def decode(messages: DataFrame) -> DataFrame:
    """Message columns from ``value``; text that is no JSON object gives a row of nulls.

    A single field of the wrong type is null and leaves its neighbours as they are.
    """
    record = F.from_json(F.col("value").cast("string"), AIR_MESSAGE)
    parsed = messages.select(F.inline(F.array(record)))
    return with_event_time(parsed, name="timestamp_utc")


def dedupe(readings: DataFrame) -> DataFrame:
    """One reading per (city, event time) among those the watermark still allows.

    The first stage keeps one copy per input partition and key, the second one per key, so a
    reading that is sent over and over does not gather in one task. Of copies in one input partition the first stays, so a
    topic keyed by what copies share decides which; between partitions there is no order. Readings without an event
    time reach no window and are left out before they can stay in the state for good.
    """
    timed = readings.filter(F.col("timestamp_utc").isNotNull())
    marked = timed.withWatermark("timestamp_utc", WATERMARK)
    by_input = marked.withColumn("_input", F.spark_partition_id())
    return (
        by_input.dropDuplicates([*DEDUPE_KEY, "_input"]).drop("_input").dropDuplicates(list(DEDUPE_KEY))
    )


def clean_readings(readings: DataFrame, normalize_first: bool = False) -> DataFrame:
    """Deduplicated, complete, valid readings with category and risk score.

    Duplicates go first: differently written names of a city both stay, and a reading without
    an index removes a later complete one of the same key. ``normalize_first`` changes both.
    The rows that reach each step are counted, see ``losses``.
    """
    no_time, lacking = F.col("timestamp_utc").isNull(), F.lit(False)
    if normalize_first:
        lacking = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in REQUIRED])
    readings = observed(readings, READ, no_time=no_time & ~lacking, lacking=lacking)
    if normalize_first:
        readings = drop_required_nulls(readings, REQUIRED).transform(normalize_city)
    return (
        dedupe(readings)
        .transform(observed, DEDUPED)
        .transform(drop_required_nulls, REQUIRED)
        .transform(normalize_city)
        .transform(observed, COMPLETE)
        .transform(range_filter, AIR.metric, AIR.low, AIR.high)
        .transform(observed, VALID)
        .withColumns(
            {
                "aqi_category": aqi_category(F.col("aqi")),
                "aqi_risk_score": aqi_risk_score(F.col("aqi")),
            }
        )
    )


def ten_minute_statistics(messages: DataFrame, dimension: DataFrame, small: bool = False) -> DataFrame:
    """Messages to windowed statistics with location and document id; a ``small`` dimension is broadcast."""
    return window_stats(clean_readings(decode(messages)), dimension, small=small)


def ten_minute_categories(messages: DataFrame) -> DataFrame:
    """Messages to windowed category counts with document id."""
    return category_counts(clean_readings(decode(messages)))
