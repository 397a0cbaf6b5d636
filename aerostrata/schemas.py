"""Record kinds, their columns and their valid ranges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

PARTITION_KEYS = ("year", "month", "day")

# Record kinds with folder, column names and types, and inclusive metric limits.
AIR_COLUMNS = (
    ("city", T.StringType()),
    ("aqi", T.IntegerType()),
    ("co", T.DoubleType()),
    ("no2", T.DoubleType()),
    ("o3", T.DoubleType()),
    ("pm10", T.DoubleType()),
    ("pm25", T.DoubleType()),
    ("so2", T.DoubleType()),
)
WEATHER_METRICS = ("wind_speed", "temperature", "humidity")
AIR_LIMITS = (0, 1000)
WIND_LIMITS = (0, 200)
TEMPERATURE_LIMITS = (-60, 60)
HUMIDITY_LIMITS = (0, 100)


def _struct(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in columns])


def _weather(metric: str) -> T.StructType:
    return _struct(
        ("city", T.StringType()),
        (metric, T.DoubleType()),
        ("timestamp_utc", T.StringType()),
        ("ts", T.LongType()),
    )


@dataclass(frozen=True)
class Kind:
    """One kind of reading: where it lands, how it looks, which values are valid."""

    name: str
    folder: str
    metric: str
    schema: T.StructType
    low: float | None
    high: float | None

    @property
    def required(self) -> list[str]:
        return ["city", "timestamp_utc", self.metric]


AIR = Kind(
    "air",
    "air_quality",
    "aqi",
    _struct(*AIR_COLUMNS, ("timestamp_utc", T.StringType()), ("ts", T.LongType())),
    *AIR_LIMITS,
)
WIND = Kind("wind", "weather_wind", "wind_speed", _weather("wind_speed"), *WIND_LIMITS)
TEMPERATURE = Kind(
    "temperature",
    "weather_temperature",
    "temperature",
    _weather("temperature"),
    *TEMPERATURE_LIMITS,
)
HUMIDITY = Kind(
    "humidity", "weather_humidity", "humidity", _weather("humidity"), *HUMIDITY_LIMITS
)
KINDS = {kind.name: kind for kind in (AIR, WIND, TEMPERATURE, HUMIDITY)}

#: Streamed air messages carry the local time text instead of the epoch second.
AIR_MESSAGE = _struct(
    *AIR_COLUMNS, ("timestamp_local", T.StringType()), ("timestamp_utc", T.StringType())
)

DIMENSION = _struct(
    ("city", T.StringType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("country", T.StringType()),
)
