"""Shaping landed API payloads into the four record kinds.

Input rows hold ``city``, ``received_at`` (timestamp of the call) and the payload text.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.functions.times import EVENT_TIME_PATTERN

# Payload fields of each record and the record columns they become.
AIR_FIELDS = {name: name for name in ("aqi", "co", "no2", "o3", "pm10", "pm25", "so2")}
WEATHER_FIELDS = {"wind_spd": "wind_speed", "temp": "temperature", "rh": "humidity"}

PAYLOAD = "data array<map<string,string>>"


def _first_entry(payloads: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """Rows whose payload has a first entry with all the fields, the entry in ``entry``.

    The entry is read as a map, which tells a missing field (no record) from a null one.
    """
    entry = F.try_element_at(F.from_json("payload", PAYLOAD)["data"], F.lit(1))
    # explode keeps the parsing in one place; the filters below then read its output
    found = payloads.select("city", "received_at", F.explode(F.array(entry)).alias("entry"))
    present = F.col("entry").isNotNull()
    for field in fields:
        present = present & F.map_contains_key("entry", field)
    return found.filter(present)


def _number(field: str, dtype: str) -> Column:
    return F.col("entry")[field].try_cast(dtype)


def _time_text(time: Column) -> Column:
    return F.date_format(time, EVENT_TIME_PATTERN)


def shape_air(payloads: DataFrame, local_zone: str = "UTC") -> DataFrame:
    """One air record per payload that has one."""
    received = F.col("received_at")
    return _first_entry(payloads, AIR_FIELDS).select(
        "city",
        *[
            _number(field, "int" if name == "aqi" else "double").alias(name)
            for field, name in AIR_FIELDS.items()
        ],
        _time_text(F.from_utc_timestamp(received, local_zone)).alias("timestamp_local"),
        _time_text(received).alias("timestamp_utc"),
        F.unix_seconds(received).alias("ts"),
    )


def weather_metrics(payloads: DataFrame) -> DataFrame:
    """(city, metric, value, timestamp_utc, ts): three rows for each weather payload that has an entry, parsed once."""
    received = F.col("received_at")
    metrics = [
        F.struct(F.lit(name).alias("metric"), _number(field, "double").alias("value"))
        for field, name in WEATHER_FIELDS.items()
    ]
    return _first_entry(payloads, WEATHER_FIELDS).select(
        "city",
        F.inline(F.array(*metrics)),
        _time_text(received).alias("timestamp_utc"),
        F.unix_seconds(received).alias("ts"),
    )


def metric_records(metrics: DataFrame, name: str) -> DataFrame:
    """The records of one weather metric, the value under its name."""
    return metrics.where(F.col("metric") == name).select("city", F.col("value").alias(name), "timestamp_utc", "ts")
