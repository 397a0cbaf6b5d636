"""Hourly facts as keyed documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerostrata.functions import document_id, hour_timestamp
from aerostrata.functions.identity import HOURLY, PM25, WEATHER_PAIRS

# Column order of the PM2.5 and of the weather-pair documents.
PM25_COLUMNS = (
    "doc_id", "city", "timestamp", "pm25", "aqi_mean", "avg_temp", "avg_hum", "avg_wind"
)
PAIR_COLUMNS = ("doc_id", "city", "timestamp", "pm25_mean", "avg_temp", "avg_hum", "avg_wind")


def _keyed(hourly: DataFrame, time: str, family: str) -> DataFrame:
    moment = hour_timestamp(*[F.col(c) for c in ("year", "month", "day", "hour")])
    return hourly.withColumn(time, moment).withColumn(
        "doc_id", document_id(F.col("city"), F.col(time), family)
    )


def hourly_documents(hourly: DataFrame) -> DataFrame:
    """Every hourly column, the hour as ``@timestamp``, and the id."""
    return _keyed(hourly, "@timestamp", HOURLY)


def pm25_documents(hourly: DataFrame) -> DataFrame:
    """The hourly pollution and weather means under their short names."""
    keyed = _keyed(hourly, "timestamp", PM25).withColumnRenamed("pm25_mean", "pm25")
    return keyed.select(*PM25_COLUMNS)


def weather_pair_documents(hourly: DataFrame) -> DataFrame:
    """PM2.5 beside the weather means; columns the table lacks are left out."""
    keyed = _keyed(hourly, "timestamp", WEATHER_PAIRS)
    return keyed.select(*[c for c in PAIR_COLUMNS if c in keyed.columns])
