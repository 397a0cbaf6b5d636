"""The sample tables seen as sensor readings.

``events`` stands for the readings of a city each (its type). The fault code ``k`` of an event
decides which defect its reading carries, so every cleaning rule meets valid and invalid rows.
``orders`` stands for hourly facts over several years, to cross month and year ends.
No row of either table is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.functions.times import EVENT_TIME_PATTERN
from aerostrata.schemas import AIR, HUMIDITY, TEMPERATURE, WIND, Kind

LOCATIONS = (
    ("CLICK", 21.0, 105.5, "North"),
    ("VIEW", 10.75, 106.5, "South"),
    ("SIGNUP", 16.0, 108.25, "Centre"),
    ("PURCHASE", 20.75, 106.75, "North"),
)


def with_fault_code(events: DataFrame) -> DataFrame:
    """Events with ``k`` from the properties and their time, to the second, as a zoned timestamp.

    Values are cut to sixteenths, so that their sums do not depend on the order of summing.
    """
    return events.selectExpr(
        "event_id",
        "event_type",
        "floor(value * 16) / 16D AS value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "date_trunc('second', cast(ts AS timestamp)) AS time",
    )


CITY = "CASE WHEN k = 29 THEN null WHEN k < 25 THEN concat(' ', event_type, ' ') ELSE event_type END"


#: Readings without a second of their own; those of code 99 are sent twice.
NO_SECOND = "k IN (31, 99)"


def _time_text(time: str) -> str:
    return f"CASE WHEN k = 23 THEN 'bad' ELSE date_format({time}, \"{EVENT_TIME_PATTERN}\") END"


def _sent(events: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Readings with the given columns; fault codes from 98 on are sent twice.

    Making whole rows in one generator evaluates the fault code once per event.
    """
    fields = ", ".join(f"{sql} AS {name}" for name, sql in columns.items())
    copies = "CASE WHEN k >= 98 THEN 2 ELSE 1 END"
    return with_fault_code(events).selectExpr(f"inline(array_repeat(struct({fields}), {copies}))")


def air_readings(events: DataFrame) -> DataFrame:
    """Air readings with ``event_id`` as tie break and ``timestamp_local`` beside the UTC text."""
    return _sent(
        events,
        {
            "event_id": "event_id",
            "k": "k",
            "city": CITY,
            "aqi": """cast(CASE WHEN k = 11 THEN null WHEN k = 97 THEN 1001 WHEN k = 83 THEN -1
                           ELSE floor(value) END AS int)""",
            "co": "k * 4D",
            "no2": "k * 0.5D",
            "o3": "value * 0.5D",
            "pm10": "value + k",
            "pm25": "value",
            "so2": "k * 0.25D",
            "timestamp_local": _time_text("time + interval 7 hours"),
            "timestamp_utc": _time_text("time"),
            "ts": f"CASE WHEN NOT {NO_SECOND} THEN unix_seconds(time) END",
            "sent": "unix_seconds(time)",
        },
    )


def _weather(events: DataFrame, metric: str, value: str) -> DataFrame:
    """Weather readings come ``k`` seconds after the air reading, so some minutes have no match."""
    later = "timestamp_seconds(unix_seconds(time) + k)"
    return _sent(
        events,
        {
            "event_id": "event_id",
            "k": "k",
            "city": CITY,
            metric: value,
            "timestamp_utc": _time_text(later),
            "ts": f"CASE WHEN NOT {NO_SECOND} THEN unix_seconds(time) + k END",
            "sent": "unix_seconds(time) + k",
        },
    )


def wind_readings(events: DataFrame) -> DataFrame:
    return _weather(events, "wind_speed", "k * 2.5D")


def temperature_readings(events: DataFrame) -> DataFrame:
    return _weather(events, "temperature", "k * 1.25D - 61.25D")


def humidity_readings(events: DataFrame) -> DataFrame:
    return _weather(events, "humidity", "k * 1.0625D - 2D")


READINGS = {
    AIR.name: air_readings,
    WIND.name: wind_readings,
    TEMPERATURE.name: temperature_readings,
    HUMIDITY.name: humidity_readings,
}


def as_lines(readings: DataFrame, columns: list[str], metric: str) -> DataFrame:
    """Readings as JSON text and the second they were sent; fault codes 41 and 42 give broken text and a wrong field type."""
    record = f"to_json(struct({', '.join(columns)}))"
    mistyped = ", ".join(f"'n/a' AS {c}" if c == metric else c for c in columns)
    return readings.selectExpr(
        "event_id",
        "sent",
        f"""CASE WHEN k = 41 THEN concat('{{', {record})
                 WHEN k = 42 THEN to_json(struct({mistyped})) ELSE {record} END AS value""",
    )


def raw_lines(events: DataFrame, kind: Kind) -> DataFrame:
    return as_lines(READINGS[kind.name](events), kind.schema.fieldNames(), kind.metric)


def air_message_lines(events: DataFrame) -> DataFrame:
    """Event, second and text of the messages a producer sends: local and UTC time text and epoch second."""
    columns = [*AIR.schema.fieldNames(), "timestamp_local"]
    return as_lines(air_readings(events), columns, AIR.metric)


def air_messages(events: DataFrame) -> DataFrame:
    """The messages as bytes, in no order."""
    return air_message_lines(events).select(F.encode("value", "UTF-8").alias("value"))


def payloads(events: DataFrame, weather: bool) -> DataFrame:
    """API answers: fault codes give a missing ``data``, an empty one, a missing field, a null."""
    if weather:
        partial = "k * 2.5D AS wind_spd"
        entry = f"{partial}, k * 1.25D - 61.25D AS temp, k * 1.0625D - 2D AS rh"
    else:
        partial = "cast(floor(value) AS int) AS aqi"
        entry = f"""{partial}, k * 4D AS co, k * 0.5D AS no2, value * 0.5D AS o3, value + k AS pm10,
                    CASE WHEN k <> 11 THEN value END AS pm25, k * 0.25D AS so2"""

    def answer(fields: str) -> str:
        body = f"named_struct('data', array(struct({fields})))"
        return f"to_json({body}, map('ignoreNullFields', 'false'))"

    return with_fault_code(events).selectExpr(
        "event_type AS city",
        "time AS received_at",
        f"""CASE WHEN k = 5 THEN '{{"error":"quota"}}' WHEN k = 6 THEN '{{"data":[]}}'
                 WHEN k = 7 THEN {answer(partial)} ELSE {answer(entry)} END AS payload""",
    )


def hourly_from_orders(orders: DataFrame) -> DataFrame:
    """Hourly facts: priority as city, order date as day, customer number giving the hour."""
    hours = orders.selectExpr(
        "o_orderpriority AS city",
        "year(o_orderdate) AS year",
        "month(o_orderdate) AS month",
        "day(o_orderdate) AS day",
        "cast(o_custkey % 24 AS int) AS hour",
        "o_totalprice",
        "o_custkey",
    )
    return hours.groupBy("city", "year", "month", "day", "hour").agg(
        F.expr("floor(max(o_totalprice)) / 2048D AS aqi_mean"),
        F.expr("floor(min(o_totalprice)) / 4096D AS pm25_mean"),
        F.expr("floor(max(o_totalprice)) / 16384D AS avg_temp"),
        F.expr("floor(min(o_totalprice)) / 8192D AS avg_hum"),
        F.expr("max(o_custkey) / 64D AS avg_wind"),
    )


def events_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def orders_table(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/orders.parquet")
