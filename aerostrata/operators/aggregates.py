"""Hourly means, daily rollup, ten-minute statistics and category counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerostrata.functions import aqi_category, day_key, document_id
from aerostrata.functions.classify import CATEGORIES
from aerostrata.functions.identity import PIVOT
from aerostrata.operators.joins import MINUTE_KEY, enrich_static, with_minute
from aerostrata.schemas import PARTITION_KEYS, WEATHER_METRICS
from aerostrata.sources.dimension import unique_cities

# Window length, percentile, and the hourly mean above which an hour is polluted.
WINDOW_LENGTH = "10 minutes"
PERCENTILE = 0.95
POLLUTED_PM25 = 50

#: Output name of each hourly mean.
HOURLY_NAMES = {
    "aqi": "aqi_mean",
    "pm25": "pm25_mean",
    "temperature": "avg_temp",
    "humidity": "avg_hum",
    "wind_speed": "avg_wind",
}
AIR_METRICS = ("aqi", "pm25")


def hourly_means(
    air: DataFrame,
    wind: DataFrame | None = None,
    temperature: DataFrame | None = None,
    humidity: DataFrame | None = None,
) -> DataFrame:
    """City-hour means over the minute join of the four sources, for all hours at once.

    The result is that of averaging ``join_weather_chain``, where a reading counts once per
    combination of weather rows of its minute. Those combinations are never built: each source is
    reduced to a sum and a count per (city, minute), and each sum is weighted by the row counts of
    the other sources. One shuffle carries all four sources, already combined by map tasks, so
    neither a busy minute nor a busy city loads a single task.
    """
    sources = dict(zip(WEATHER_METRICS, (wind, temperature, humidity)))
    parts = [with_minute(air).select(*MINUTE_KEY, F.lit("air").alias("source"), *AIR_METRICS)]
    for metric, source in sources.items():
        if source is not None:
            placed = with_minute(source).filter(F.col("city").isNotNull())
            parts.append(placed.select(*MINUTE_KEY, F.lit(metric).alias("source"), metric))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    absent = [m for m in WEATHER_METRICS if sources[m] is None]
    stacked = stacked.selectExpr("*", *[f"cast(null AS double) AS {m}" for m in absent])

    metrics = (*AIR_METRICS, *WEATHER_METRICS)
    per_minute = (
        stacked.groupBy(*MINUTE_KEY)
        .agg(
            # counting only timed rows also removes the group without a time, and unlike a test
            # of the key it is not pushed down to where it would parse every time text twice
            F.expr("count_if(source = 'air' AND join_time IS NOT NULL) AS rows_air"),
            *[F.expr(f"count_if(source = '{m}') AS rows_{m}") for m in WEATHER_METRICS],
            *[F.expr(f"cast(sum({m}) AS double) AS sum_{m}") for m in metrics],
            *[F.expr(f"count({m}) AS count_{m}") for m in metrics],
        )
        .filter("rows_air > 0")
    )

    def copies(metric: str) -> str:
        """How often the left join repeats a row of the minute because of the other sources."""
        others = [f"greatest(rows_{m}, 1D)" for m in WEATHER_METRICS if m != metric]
        return " * ".join(others if metric in AIR_METRICS else [*others, "rows_air"])

    means = [
        F.expr(
            f"try_divide(sum(sum_{m} * {copies(m)}), sum(count_{m} * {copies(m)})) AS {name}"
        )
        for m, name in HOURLY_NAMES.items()
    ]
    return (
        per_minute.groupBy("city", F.date_trunc("hour", "join_time").alias("start"))
        .agg(*means)
        .selectExpr(
            "city",
            "year(start) AS year",
            "month(start) AS month",
            "day(start) AS day",
            "hour(start) AS hour",
            *HOURLY_NAMES.values(),
        )
    )


def daily_rollup(hourly: DataFrame) -> DataFrame:
    """City-day means of hourly means, the highest hourly PM2.5 and the count of polluted hours."""
    means = hourly.groupBy("city", *PARTITION_KEYS).agg(
        F.round(F.avg("pm25_mean"), 2).alias("pm25_avg"),
        F.round(F.avg("aqi_mean"), 0).alias("aqi_avg"),
        F.round(F.avg("avg_temp"), 1).alias("temp_avg"),
        F.round(F.avg("avg_hum"), 1).alias("hum_avg"),
        F.round(F.avg("avg_wind"), 1).alias("wind_avg"),
        F.round(F.max("pm25_mean"), 2).alias("pm25_peak_hour"),
        F.count_if(F.col("pm25_mean") > POLLUTED_PM25).alias("polluted_hours_count"),
    )
    return means.withColumn("date", day_key(F.col("year"), F.col("month"), F.col("day")))


def _per_window(readings: DataFrame, time: str):
    return readings.groupBy(F.window(time, WINDOW_LENGTH), "city")


def _flat_window() -> list[Column]:
    return [
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.col("city"),
    ]


def window_stats(
    readings: DataFrame, dimension: DataFrame | None = None, time: str = "timestamp_utc", small: bool = False
) -> DataFrame:
    """Ten-minute statistics per city, for batch and stream.

    The dimension is reduced to one row per city and joined to the window rows rather than to the
    readings, which is the same result with far fewer probes and smaller state. ``small`` says that
    the caller has measured it and it may be broadcast.
    """
    stats = _per_window(readings, time).agg(
        F.avg("aqi").alias("avg_aqi"),
        F.stddev("aqi").alias("stddev_aqi"),
        F.percentile_approx("aqi", PERCENTILE).alias("p95_aqi"),
        F.count(F.lit(1)).alias("event_count"),
        F.avg("pm25").alias("avg_pm25"),
        F.avg("pm10").alias("avg_pm10"),
    )
    measures = ["avg_aqi", "stddev_aqi", "p95_aqi", "event_count", "avg_pm25", "avg_pm10"]
    flat = stats.select(*_flat_window(), *measures)
    if dimension is None:
        flat = flat.withColumns(
            {
                "lat": F.lit(None).cast("double"),
                "lon": F.lit(None).cast("double"),
                "country": F.lit(None).cast("string"),
            }
        )
    else:
        flat = enrich_static(flat, unique_cities(dimension), small)
    return flat.select(
        "window_start",
        "window_end",
        "city",
        *measures,
        "lat",
        "lon",
        "country",
        document_id(F.col("city"), F.col("window_start")).alias("doc_id"),
    )


def category_counts(readings: DataFrame, time: str = "timestamp_utc") -> DataFrame:
    """Readings per category, one column each, in ten-minute windows per city.

    Conditional counts need one pass and one state store, and give zero for an absent category.
    """
    category = aqi_category(F.col("aqi"))
    columns = {name.replace(" ", "_"): name for name in CATEGORIES}
    counts = _per_window(readings, time).agg(
        *[F.count_if(category == name).alias(column) for column, name in columns.items()]
    )
    return counts.select(
        *_flat_window(),
        *columns,
        document_id(F.col("city"), F.col("window.start"), PIVOT).alias("pivot_doc_id"),
    )
