"""Data-quality report over raw text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.functions import parse_event_time
from aerostrata.operators.cleaning import city_name, within
from aerostrata.schemas import Kind
from aerostrata.sources.raw import CORRUPT, parse_lines

# The rules in the order they apply; a row counts at the first one it fails.
RULES = ("malformed", "required_null", "bad_time", "duplicate", "out_of_range")


def dq_report(lines: DataFrame, kind: Kind) -> DataFrame:
    """Rows per event day and reject reason for a frame of JSON text lines in ``value``.

    ``day`` is null for rows without a readable time. A duplicate counts on the day of the row
    that survives it. Two aggregations, both combined ahead of their shuffle: the first folds
    the copies of a (city, ts) key to a count and a survivor, so a key with many copies is cheap.
    """
    event_time = parse_event_time(F.col("timestamp_utc"))
    missing = F.lit(False)
    for column in kind.required:
        missing = missing | F.col(column).isNull()
        if kind.schema[column].dataType.typeName() == "double":
            missing = missing | F.isnan(column)
    columns = kind.schema.fieldNames()
    others = [*[c for c in columns if c not in ("city", "ts")], "ts"]

    judged = parse_lines(lines, kind.schema).withColumn("event_time", event_time)
    judged = judged.withColumn(
        "reason",
        F.when(F.col(CORRUPT).isNotNull(), "malformed")
        .when(missing, "required_null")
        .when(F.col("event_time").isNull(), "bad_time"),
    )
    passed = F.col("reason").isNull()
    keyed = judged.select(
        "reason",
        F.when(~passed, F.to_date("event_time")).alias("reject_day"),
        F.when(passed, city_name(F.col("city"))).alias("key_city"),
        F.when(passed, F.coalesce("ts", F.unix_seconds("event_time"))).alias("key_ts"),
        F.when(passed, F.struct(*others, F.to_date("event_time").alias("day"))).alias("row"),
    )
    folded = keyed.groupBy("reason", "reject_day", "key_city", "key_ts").agg(
        F.count(F.lit(1)).alias("n"), F.min("row").alias("first")
    )
    valid_first = within(F.col(f"first.{kind.metric}"), kind.low, kind.high)

    def rejected(rule: str):
        return F.sum(F.when(F.col("reason") == rule, F.col("n")).otherwise(0)).alias(rule)

    return (
        folded.groupBy(F.coalesce("reject_day", "first.day").alias("day"))
        .agg(
            F.sum("n").alias("rows_seen"),
            rejected("malformed"),
            rejected("required_null"),
            rejected("bad_time"),
            F.sum(F.when(passed, F.col("n") - 1).otherwise(0)).alias("duplicate"),
            F.count_if(passed & ~valid_first).alias("out_of_range"),
            F.count_if(passed & valid_first).alias("valid"),
        )
        .select(F.lit(kind.name).alias("kind"), "day", "rows_seen", *RULES, "valid")
    )
