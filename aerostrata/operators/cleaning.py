"""Cleaning steps. All but ``first_per_key`` also run on streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.functions import parse_event_time
from aerostrata.functions.times import EVENT_TIME_PATTERN
from aerostrata.schemas import Kind

EVENT_TIME = "event_time"
#: Second of a reading: its own, or that of its event time where it has none.
SECOND = f"coalesce(ts, unix_seconds(try_to_timestamp(timestamp_utc, \"{EVENT_TIME_PATTERN}\")))"
#: What two readings of one moment share, as SQL expressions.
DEDUPE_KEY = ("city", SECOND)


def with_event_time(df: DataFrame, text: str = "timestamp_utc", name: str = EVENT_TIME) -> DataFrame:
    """Add (or, under the same name, replace by) the parsed event time."""
    return df.withColumn(name, parse_event_time(F.col(text)))


def drop_required_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def city_name(city: Column) -> Column:
    return F.trim(F.upper(city))


def normalize_city(df: DataFrame) -> DataFrame:
    return df.withColumn("city", city_name(F.col("city")))


def within(value: Column, low: float | None, high: float | None) -> Column:
    """Inclusive range test with optional bounds."""
    test = F.lit(True)
    if low is not None:
        test = test & (value >= low)
    if high is not None:
        test = test & (value <= high)
    return test


def range_filter(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None
) -> DataFrame:
    return df.filter(within(F.col(column), low, high))


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column] | None = None
) -> DataFrame:
    """One row per key, of columns or SQL expressions: the first by ``order_by``, or by all other columns ascending.

    The survivor is the same on every run and after any task retry. Spark turns the rank test
    into a group limit ahead of the shuffle, so each map task ships at most one row per key and a
    key that holds a large share of the rows costs no more than any other.
    """
    order = list(order_by) if order_by else [F.col(c) for c in df.columns if c not in keys]
    if not order:
        return df.dropDuplicates(list(keys))
    by = [F.col(f"`{k}`") if k in df.columns else F.expr(k) for k in keys]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def partition_keys(df: DataFrame, time: str = EVENT_TIME) -> DataFrame:
    """Replace the time column by the year, month and day it falls on."""
    moment = F.col(time)
    return df.withColumns(
        {"year": F.year(moment), "month": F.month(moment), "day": F.dayofmonth(moment)}
    ).drop(time)


def clean(df: DataFrame, kind: Kind, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """The whole batch cleaning of one kind of reading.

    Duplicates are resolved before the range test, so an invalid first reading also removes its
    valid twin. Rows whose time text cannot be read are rejected.
    """
    columns = kind.schema.fieldNames()
    # One generated row carries the parsed time, so that no filter repeats the parsing.
    timed = df.select(F.inline(F.array(F.struct(
        *[F.col(c) for c in df.columns], parse_event_time(F.col("timestamp_utc")).alias(EVENT_TIME)
    ))))
    order = list(order_by) if order_by else [c for c in columns if c not in ("city", "ts")]
    return (
        timed.transform(drop_required_nulls, kind.required)
        .filter(F.col(EVENT_TIME).isNotNull())
        .transform(normalize_city)
        .withColumn("_second", F.coalesce("ts", F.unix_seconds(EVENT_TIME)))
        # the second first: sorting tells rows apart by it at once, by the few cities hardly ever
        .transform(first_per_key, ("_second", "city"), [*order, "ts"])
        .drop("_second")
        .transform(range_filter, kind.metric, kind.low, kind.high)
        .transform(partition_keys)
    )
