"""The registered queries as DuckDB SQL over the same tables, stated without the library's code.

The hourly means below average the joined rows one by one, the way the join is defined.
"""

from __future__ import annotations

COMMON = {
    "coded": """
        SELECT event_id, event_type, floor(value * 16) / 16 AS value, date_trunc('second', ts) AS time,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
        FROM events""",
    "sent": """
        SELECT * FROM coded UNION ALL SELECT * FROM coded WHERE k >= 98""",
    "named": """
        SELECT *, CASE WHEN k = 29 THEN NULL WHEN k < 25 THEN ' ' || event_type || ' '
                       ELSE event_type END AS city
        FROM sent""",
    "air": """
        SELECT event_id, k, city,
               CAST(CASE WHEN k = 11 THEN NULL WHEN k = 97 THEN 1001 WHEN k = 83 THEN -1
                         ELSE floor(value) END AS INTEGER) AS aqi,
               k * 4e0 AS co, k * 0.5e0 AS no2, value * 0.5e0 AS o3,
               value + k AS pm10, value AS pm25, k * 0.25e0 AS so2,
               CASE WHEN k <> 23 THEN time END AS time,
               CASE WHEN k = 23 THEN 'bad'
                    ELSE strftime(time + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S')
               END AS timestamp_local,
               CASE WHEN k = 23 THEN 'bad' ELSE strftime(time, '%Y-%m-%dT%H:%M:%S')
               END AS timestamp_utc,
               CASE WHEN k NOT IN (31, 99) THEN CAST(epoch(time) AS BIGINT) END AS ts,
               CAST(epoch(time) AS BIGINT) AS sent
        FROM named""",
    "later": """
        SELECT event_id, k, city, time + to_seconds(k) AS time FROM named""",
    "weather": """
        SELECT event_id, k, city, k * 2.5e0 AS wind_speed, k * 1.25e0 - 61.25e0 AS temperature,
               k * 1.0625e0 - 2e0 AS humidity, CASE WHEN k <> 23 THEN time END AS time,
               CASE WHEN k = 23 THEN 'bad' ELSE strftime(time, '%Y-%m-%dT%H:%M:%S')
               END AS timestamp_utc,
               CASE WHEN k NOT IN (31, 99) THEN CAST(epoch(time) AS BIGINT) END AS ts,
               CAST(epoch(time) AS BIGINT) AS sent
        FROM later""",
}

AIR_VALUES = "aqi, co, no2, o3, pm10, pm25, so2, timestamp_utc"
LIMITS = {"aqi": (0, 1000), "wind_speed": (0, 200), "temperature": (-60, 60), "humidity": (0, 100)}
METRICS = {"air": "aqi", "wind": "wind_speed", "temperature": "temperature", "humidity": "humidity"}
DATE_PARTS = """CAST(year(time) AS INTEGER) AS year, CAST(month(time) AS INTEGER) AS month,
                CAST(day(time) AS INTEGER) AS day"""


def _values(kind: str) -> str:
    return AIR_VALUES if kind == "air" else f"{METRICS[kind]}, timestamp_utc"


def _clean(kind: str, raw: bool) -> dict[str, str]:
    """Clean readings of one kind; from raw text, broken lines go and ties break by all columns."""
    metric = METRICS[kind]
    low, high = LIMITS[metric]
    table = "air" if kind == "air" else "weather"
    values = _values(kind)
    order = ", ".join(f"{c} NULLS FIRST" for c in values.split(", ")) if raw else "event_id"
    readable = "k NOT IN (41, 42)" if raw else "true"
    return {
        f"first_{kind}": f"""
        SELECT * REPLACE (trim(upper(city)) AS city),
               row_number() OVER (PARTITION BY trim(upper(city)), sent ORDER BY {order}) AS place
        FROM {table}
        WHERE {readable} AND city IS NOT NULL AND {metric} IS NOT NULL AND time IS NOT NULL""",
        f"clean_{kind}": f"""
        SELECT city, {values}, ts, time, {DATE_PARTS}
        FROM first_{kind} WHERE place = 1 AND {metric} BETWEEN {low} AND {high}""",
    }


def _joined(raw: bool) -> dict[str, str]:
    ctes = {}
    for kind in METRICS:
        ctes.update(_clean(kind, raw))
    ctes["joined"] = """
        SELECT a.*, date_trunc('minute', a.time) AS join_time, wind_speed, temperature, humidity
        FROM clean_air a
        LEFT JOIN clean_wind w
          ON w.city = a.city AND date_trunc('minute', w.time) = date_trunc('minute', a.time)
        LEFT JOIN clean_temperature t
          ON t.city = a.city AND date_trunc('minute', t.time) = date_trunc('minute', a.time)
        LEFT JOIN clean_humidity h
          ON h.city = a.city AND date_trunc('minute', h.time) = date_trunc('minute', a.time)"""
    ctes["hourly"] = f"""
        SELECT city, {DATE_PARTS}, CAST(hour(time) AS INTEGER) AS hour, avg(aqi) AS aqi_mean,
               avg(pm25) AS pm25_mean, avg(temperature) AS avg_temp, avg(humidity) AS avg_hum,
               avg(wind_speed) AS avg_wind
        FROM (SELECT * REPLACE (date_trunc('hour', time) AS time) FROM joined)
        GROUP BY city, time"""
    return ctes


ORDER_HOURS = {
    "hourly": """
        SELECT o_orderpriority AS city, CAST(year(o_orderdate) AS INTEGER) AS year,
               CAST(month(o_orderdate) AS INTEGER) AS month,
               CAST(day(o_orderdate) AS INTEGER) AS day,
               CAST(o_custkey % 24 AS INTEGER) AS hour,
               floor(max(o_totalprice)) / 2048e0 AS aqi_mean, floor(min(o_totalprice)) / 4096e0 AS pm25_mean,
               floor(max(o_totalprice)) / 16384e0 AS avg_temp, floor(min(o_totalprice)) / 8192e0 AS avg_hum,
               max(o_custkey) / 64e0 AS avg_wind
        FROM orders GROUP BY ALL"""
}
HOURLY_MEANS = ("aqi_mean", "pm25_mean", "avg_temp", "avg_hum", "avg_wind")
TWO_MONTHS = "(year = 1998 AND month = 1) OR (year = 1997 AND month = 12)"


def _rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(24,9)), {digits}) AS DOUBLE)"


def _six(*names: str) -> str:
    """Columns rounded to six digits under their own names."""
    return ", ".join(f"{_rounded(n, 6)} AS {n}" for n in names)


def _text(moment: str) -> str:
    return f"strftime({moment}, '%Y-%m-%d %H:%M:%S')"


def _nearest(value: str, digits: int) -> str:
    """A double rounded half up by its shortest decimal text."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def _daily(source: str = "hourly", where: str = "true") -> dict[str, str]:
    return {
        "daily": f"""
        SELECT city, year, month, day, {_nearest("avg(pm25_mean)", 2)} AS pm25_avg,
               {_nearest("avg(aqi_mean)", 0)} AS aqi_avg, {_nearest("avg(avg_temp)", 1)} AS temp_avg,
               {_nearest("avg(avg_hum)", 1)} AS hum_avg, {_nearest("avg(avg_wind)", 1)} AS wind_avg,
               {_nearest("max(pm25_mean)", 2)} AS pm25_peak_hour,
               count(*) FILTER (pm25_mean > 50) AS polluted_hours_count,
               CAST(make_date(year, month, day) AS VARCHAR) AS date
        FROM {source} WHERE {where} GROUP BY city, year, month, day""",
        "lagged": """
        SELECT *, lag(pm25_avg) OVER (PARTITION BY city ORDER BY date) AS prev_day_pm25
        FROM daily""",
        "grown": f"""
        SELECT * EXCLUDE (prev_day_pm25),
               {_nearest("(pm25_avg - prev_day_pm25) / nullif(prev_day_pm25, 0) * 100", 2)}
               AS growth_pct
        FROM lagged""",
        "trend": """
        SELECT *, CASE WHEN growth_pct > 10 THEN 'WORSENING' WHEN growth_pct < -10 THEN 'IMPROVING'
                       ELSE 'STABLE' END AS trend_status
        FROM grown""",
    }


LOCATIONS = {
    "location": """
        SELECT * FROM (VALUES ('CLICK', 21e0, 105.5e0, 'North'), ('VIEW', 10.75e0, 106.5e0, 'South'),
                              ('SIGNUP', 16e0, 108.25e0, 'Centre'),
                              ('PURCHASE', 20.75e0, 106.75e0, 'North'))
                      AS l(city, lat, lon, country)"""
}

#: Messages as the stream sees them: broken text is a row of nulls, a mistyped field a null.
MESSAGES = {
    "message": """
        SELECT event_id, k, CASE WHEN k <> 41 THEN city END AS city,
               CASE WHEN k NOT IN (41, 42) THEN aqi END AS aqi,
               CASE WHEN k <> 41 THEN co END AS co, CASE WHEN k <> 41 THEN no2 END AS no2,
               CASE WHEN k <> 41 THEN o3 END AS o3, CASE WHEN k <> 41 THEN pm10 END AS pm10,
               CASE WHEN k <> 41 THEN pm25 END AS pm25, CASE WHEN k <> 41 THEN so2 END AS so2,
               CASE WHEN k <> 41 THEN timestamp_local END AS timestamp_local,
               CASE WHEN k <> 41 THEN time END AS time
        FROM air""",
}


def _streamed(admitted: str = "true") -> dict[str, str]:
    """Clean streamed readings; the first message of a (city, time) key survives."""
    return {
        **MESSAGES,
        "kept": f"""
        SELECT *, row_number() OVER (PARTITION BY city, time ORDER BY event_id) AS place
        FROM message WHERE time IS NOT NULL AND {admitted}""",
        "reading": """
        SELECT * REPLACE (trim(upper(city)) AS city) FROM kept
        WHERE place = 1 AND city IS NOT NULL AND aqi BETWEEN 0 AND 1000""",
    }


def _statistics(source: str) -> dict[str, str]:
    return {
        "windowed": f"""
        SELECT time_bucket(INTERVAL 10 MINUTE, time) AS start, city, avg(aqi) AS avg_aqi,
               stddev_samp(aqi) AS stddev_aqi, quantile_disc(aqi, 0.95) AS p95_aqi,
               count(*) AS event_count, avg(pm25) AS avg_pm25, avg(pm10) AS avg_pm10
        FROM {source} GROUP BY ALL"""
    }


STATISTICS = f"""
    SELECT {_text("start")} AS window_start, {_text("start + INTERVAL 10 MINUTE")} AS window_end,
           city, {_six("avg_aqi", "stddev_aqi")}, p95_aqi, event_count,
           {_six("avg_pm25", "avg_pm10")}, lat, lon, country,
           sha256(concat_ws('_', city, {_text("start")})) AS doc_id
    FROM windowed LEFT JOIN location USING (city)"""


def _categories(source: str) -> str:
    return f"""
    SELECT {_text("start")} AS window_start, {_text("start + INTERVAL 10 MINUTE")} AS window_end,
           city, count(*) FILTER (aqi <= 50) AS "Good",
           count(*) FILTER (aqi > 50 AND aqi <= 100) AS "Moderate",
           count(*) FILTER (aqi > 100 AND aqi <= 150) AS "Unhealthy",
           count(*) FILTER (aqi > 150 AND aqi <= 200) AS "Very_Unhealthy",
           count(*) FILTER (aqi > 200) AS "Hazardous",
           sha256(concat_ws('_', city, {_text("start")}, 'pivot')) AS pivot_doc_id
    FROM (SELECT *, time_bucket(INTERVAL 10 MINUTE, time) AS start FROM {source})
    GROUP BY start, city"""


def _query(select: str, *blocks: dict[str, str]) -> str:
    ctes: dict[str, str] = {}
    for block in blocks:
        ctes.update(block)
    if not ctes:
        return select
    return "WITH " + ",\n".join(f"{n} AS ({body})" for n, body in ctes.items()) + "\n" + select


def _readings(select: str, *blocks: dict[str, str]) -> str:
    return _query(select, COMMON, *blocks)


AIR_NUMBERS = _six("co", "no2", "o3", "pm10", "pm25", "so2")
CLEAN_AIR_COLUMNS = f"city, aqi, {AIR_NUMBERS}, timestamp_utc, ts, year, month, day"
HOUR_START = "make_timestamp(year, month, day, hour, 0, 0)"
HOUR_TEXT = _text(HOUR_START)


def _document_id(family: str) -> str:
    return f"sha256(concat_ws('_', city, {HOUR_TEXT}, '{family}'))"


def _quality(kind: str) -> str:
    """Rows of one kind by day and by the first rule they fail."""
    metric, table = METRICS[kind], "air" if kind == "air" else "weather"
    low, high = LIMITS[metric]
    order = ", ".join(f"{c} NULLS FIRST" for c in _values(kind).split(", "))
    return f"""
    SELECT '{kind}' AS kind, CAST(CAST(day AS DATE) AS VARCHAR) AS day, count(*) AS rows_seen,
           count(*) FILTER (fault = 'malformed') AS malformed,
           count(*) FILTER (fault = 'required_null') AS required_null,
           count(*) FILTER (fault = 'bad_time') AS bad_time,
           count(*) FILTER (fault = 'passed' AND place > 1) AS duplicate,
           count(*) FILTER (fault = 'passed' AND place = 1 AND NOT metric BETWEEN {low} AND {high})
             AS out_of_range,
           count(*) FILTER (fault = 'passed' AND place = 1 AND metric BETWEEN {low} AND {high})
             AS valid
    FROM (
      SELECT fault, {metric} AS metric, CASE WHEN fault <> 'malformed' OR k = 42 THEN time END AS day,
             row_number() OVER (PARTITION BY fault, trim(upper(city)), sent ORDER BY {order}) AS place
      FROM (SELECT *, CASE WHEN k IN (41, 42) THEN 'malformed'
                           WHEN city IS NULL OR {metric} IS NULL THEN 'required_null'
                           WHEN time IS NULL THEN 'bad_time' ELSE 'passed' END AS fault
            FROM {table}))
    GROUP BY ALL"""


def _raw_scan() -> str:
    return _readings(
        f"""SELECT city, CAST(aqi AS DOUBLE) AS aqi, {AIR_NUMBERS}, timestamp_utc, ts
            FROM air WHERE k NOT IN (41, 42)"""
    )


def _clean_query(kind: str) -> str:
    columns = CLEAN_AIR_COLUMNS
    if kind != "air":
        columns = f"city, {METRICS[kind]}, timestamp_utc, ts, year, month, day"
    return _readings(f"SELECT {columns} FROM clean_{kind}", _clean(kind, raw=False))


def oracle_queries() -> dict[str, str]:
    """SQL by query name."""
    clean_air = _clean("air", raw=False)
    joined, joined_raw = _joined(raw=False), _joined(raw=True)
    hour_columns = f"city, year, month, day, hour, {_six(*HOURLY_MEANS)}"
    shifted = f"{_rounded('pm25_mean + 1000', 6)} AS pm25_mean"
    sql = {
        "scan_raw_json": _raw_scan(),
        "land_raw": _raw_scan(),
        "scan_hour_vs_full": _readings(
            """SELECT scope, city, count(*) AS readings, max(wind_speed) AS max_wind
            FROM (SELECT 'full' AS scope, * FROM weather
                  UNION ALL
                  SELECT 'hour' AS scope, * FROM weather
                  WHERE epoch(TIMESTAMP '2024-01-15 12:00:00') <= sent
                    AND sent < epoch(TIMESTAMP '2024-01-16 00:00:00'))
            WHERE k NOT IN (41, 42) GROUP BY ALL"""
        ),
        "scan_clean_day": _readings(
            f"SELECT {CLEAN_AIR_COLUMNS} FROM clean_air WHERE year = 2024 AND month = 1 AND day = 15",
            clean_air,
        ),
        "scan_two_months": _query(f"SELECT {hour_columns} FROM hourly WHERE {TWO_MONTHS}", ORDER_HOURS),
        "shape_air": _query(
            """SELECT event_type AS city, CAST(floor(value) AS INTEGER) AS aqi, k * 4e0 AS co,
                      k * 0.5e0 AS no2, CAST(round(CAST(value * 0.5e0 AS DECIMAL(24,9)), 6) AS DOUBLE) AS o3,
                      CAST(round(CAST(value + k AS DECIMAL(24,9)), 6) AS DOUBLE) AS pm10,
                      CASE WHEN k <> 11 THEN value END AS pm25, k * 0.25e0 AS so2,
                      strftime(time + INTERVAL 7 HOUR, '%Y-%m-%dT%H:%M:%S') AS timestamp_local,
                      strftime(time, '%Y-%m-%dT%H:%M:%S') AS timestamp_utc,
                      CAST(epoch(time) AS BIGINT) AS ts
               FROM coded WHERE k NOT IN (5, 6, 7)""",
            {"coded": COMMON["coded"]},
        ),
        "split_weather": _query(
            """SELECT event_type AS city, metric, value,
                      strftime(time, '%Y-%m-%dT%H:%M:%S') AS timestamp_utc,
                      CAST(epoch(time) AS BIGINT) AS ts
               FROM (SELECT event_type, time, k, 'wind_speed' AS metric, k * 2.5e0 AS value FROM coded
                     UNION ALL
                     SELECT event_type, time, k, 'temperature', k * 1.25e0 - 61.25e0 FROM coded
                     UNION ALL
                     SELECT event_type, time, k, 'humidity', k * 1.0625e0 - 2e0 FROM coded)
               WHERE k NOT IN (5, 6, 7)""",
            {"coded": COMMON["coded"]},
        ),
        "stream_parse": _readings(
            f"""SELECT city, CAST(aqi AS DOUBLE) AS aqi, {AIR_NUMBERS}, timestamp_local,
                       {_text("time")} AS timestamp_utc
                FROM message""",
            MESSAGES,
        ),
        "parse_event_time": _readings(
            f"SELECT event_id, timestamp_utc, {_text('time')} AS event_time FROM air"
        ),
        "normalize_city": _readings("SELECT event_id, trim(upper(city)) AS city FROM air"),
        "drop_required_nulls": _readings(
            """SELECT event_id, city, aqi, timestamp_utc FROM air
               WHERE city IS NOT NULL AND aqi IS NOT NULL AND timestamp_utc IS NOT NULL"""
        ),
        "range_filter": _readings("SELECT event_id, aqi FROM air WHERE aqi BETWEEN 0 AND 1000"),
        "partition_keys": _readings(f"SELECT event_id, {DATE_PARTS} FROM air WHERE time IS NOT NULL"),
        "dedupe_batch": _readings(
            """SELECT event_id, city, ts, pm25 FROM (
                 SELECT event_id, trim(upper(city)) AS city, ts, pm25,
                        row_number() OVER (PARTITION BY trim(upper(city)), sent ORDER BY event_id) AS place
                 FROM air) WHERE place = 1"""
        ),
        **{f"clean_{kind}": _clean_query(kind) for kind in METRICS},
        "dq_report": _readings(" UNION ALL ".join(_quality(kind) for kind in METRICS)),
        "join_minute_left": _readings(
            f"""SELECT a.city, {_text("date_trunc('minute', a.time)")} AS join_time, a.ts, aqi, pm25,
                       wind_speed
                FROM clean_air a LEFT JOIN clean_wind w
                  ON w.city = a.city AND date_trunc('minute', w.time) = date_trunc('minute', a.time)""",
            clean_air,
            _clean("wind", raw=False),
        ),
        "join_weather_chain": _readings(
            f"""SELECT city, {_text("join_time")} AS join_time, ts, aqi, pm25, wind_speed, temperature,
                       humidity FROM joined""",
            joined,
        ),
        "enrich_static": _readings(
            "SELECT city, ts, aqi, lat, lon, country FROM clean_air LEFT JOIN location USING (city)",
            clean_air,
            LOCATIONS,
        ),
        "hourly_aggregate": _readings(f"SELECT {hour_columns} FROM hourly", joined),
        "daily_rollup": _query("SELECT * FROM daily", ORDER_HOURS, _daily()),
        "daily_polluted_hours": _readings(
            "SELECT city, date, polluted_hours_count FROM daily", joined, _daily()
        ),
        "daily_lag": _query(
            "SELECT city, date, pm25_avg, prev_day_pm25 FROM lagged", ORDER_HOURS, _daily()
        ),
        "daily_growth": _query(
            "SELECT city, date, pm25_avg, growth_pct, trend_status FROM trend", ORDER_HOURS, _daily()
        ),
        "daily_trend": _readings("SELECT * FROM trend", joined, _daily()),
        "daily_period": _query(
            "SELECT * FROM trend WHERE year = 1998 AND month = 1",
            ORDER_HOURS,
            _daily(where=TWO_MONTHS),
        ),
        "window_10min": _readings(STATISTICS, clean_air, LOCATIONS, _statistics("clean_air")),
        "pivot_category": _readings(_categories("clean_air"), clean_air),
        "aqi_category": _readings(
            """SELECT event_id, CASE WHEN aqi <= 50 THEN 'Good' WHEN aqi <= 100 THEN 'Moderate'
                      WHEN aqi <= 150 THEN 'Unhealthy' WHEN aqi <= 200 THEN 'Very Unhealthy'
                      ELSE 'Hazardous' END AS aqi_category FROM air"""
        ),
        "aqi_risk_score": _readings(
            """SELECT event_id, CASE WHEN aqi IS NULL THEN NULL WHEN aqi <= 50 THEN 0.1e0
                      WHEN aqi <= 100 THEN 0.3e0 WHEN aqi <= 150 THEN 0.6e0 WHEN aqi <= 200 THEN 0.8e0
                      ELSE 1e0 END AS aqi_risk_score FROM air"""
        ),
        "doc_id_window": _readings(
            f"""SELECT DISTINCT city, {_text("start")} AS window_start,
                       sha256(concat_ws('_', city, {_text("start")})) AS doc_id
                FROM (SELECT city, time_bucket(INTERVAL 10 MINUTE, time) AS start FROM clean_air)""",
            clean_air,
        ),
        "doc_id_pivot": _readings(
            f"""SELECT DISTINCT city, {_text("start")} AS window_start,
                       sha256(concat_ws('_', city, {_text("start")}, 'pivot')) AS pivot_doc_id
                FROM (SELECT city, time_bucket(INTERVAL 10 MINUTE, time) AS start FROM clean_air)""",
            clean_air,
        ),
        "doc_id_export": _query(
            f"""SELECT city, {HOUR_TEXT} AS hour_start, {_document_id("hourly")} AS id_hourly,
                       {_document_id("pm25")} AS id_pm25, {_document_id("corr")} AS id_corr
                FROM hourly""",
            ORDER_HOURS,
        ),
        "hour_timestamp": _query(
            f"SELECT city, year, month, day, hour, {HOUR_TEXT} AS hour_start FROM hourly", ORDER_HOURS
        ),
        "export_hourly": _readings(
            f"""SELECT {hour_columns}, {HOUR_TEXT} AS "@timestamp", {_document_id("hourly")} AS doc_id
                FROM hourly""",
            joined,
        ),
        "export_pm25": _readings(
            f"""SELECT {_document_id("pm25")} AS doc_id, city, {HOUR_TEXT} AS timestamp,
                       {_rounded("pm25_mean", 6)} AS pm25,
                       {_six("aqi_mean", "avg_temp", "avg_hum", "avg_wind")}
                FROM hourly""",
            joined,
        ),
        "export_weather_pairs": _query(
            f"""SELECT {_document_id("corr")} AS doc_id, city, {HOUR_TEXT} AS timestamp,
                       {_six("pm25_mean", "avg_temp", "avg_hum", "avg_wind")}
                FROM hourly""",
            ORDER_HOURS,
        ),
        "sink_partitioned_append": _readings(f"SELECT {CLEAN_AIR_COLUMNS} FROM clean_air", clean_air),
        "sink_dynamic_overwrite": _query(
            f"""SELECT {hour_columns} FROM hourly WHERE year < 1998 UNION ALL
                SELECT * REPLACE ({shifted})
                FROM (SELECT {hour_columns} FROM hourly WHERE year >= 1998)""",
            ORDER_HOURS,
        ),
        "sink_upsert": _query(
            f"""SELECT {hour_columns} FROM hourly WHERE day < 15 UNION ALL
                SELECT * REPLACE ({shifted})
                FROM (SELECT {hour_columns} FROM hourly WHERE day >= 15)""",
            ORDER_HOURS,
        ),
        "stream_dedupe": _readings(
            f"SELECT DISTINCT city, {_text('time')} AS timestamp_utc FROM message WHERE time IS NOT NULL",
            MESSAGES,
        ),
        "stream_10min": _readings(STATISTICS, _streamed(), LOCATIONS, _statistics("reading")),
        "stream_pivot": _readings(_categories("reading"), _streamed()),
        "stream_upsert": _readings(_categories("reading"), _streamed()),
        "stream_late": _readings(
            "SELECT city, count(*) AS readings FROM reading GROUP BY city",
            _streamed(
                """(k < 60 OR time > (SELECT max(time) - INTERVAL 10 MINUTE FROM message WHERE k < 60))"""
            ),
        ),
        "stream_losses": _readings(
            """SELECT delivery::INT AS delivery, count(*) AS rows_read, count(*) FILTER (time IS NULL) AS no_time,
                      count(*) FILTER (late) AS late, count(*) FILTER (place > 1) AS duplicate,
                      count(*) FILTER (place = 1 AND (city IS NULL OR aqi IS NULL)) AS incomplete,
                      count(*) FILTER (place = 1 AND city IS NOT NULL AND aqi NOT BETWEEN 0 AND 1000) AS out_of_range,
                      count(*) FILTER (place = 1 AND city IS NOT NULL AND aqi BETWEEN 0 AND 1000) AS valid
               FROM judged GROUP BY delivery""",
            MESSAGES,
            {
                "delivered": """
        SELECT *, CASE WHEN k < 60 THEN 1 ELSE 2 END AS delivery,
               k >= 60 AND time <= (SELECT max(time) - INTERVAL 10 MINUTE FROM message WHERE k < 60) AS late
        FROM message""",
                "judged": """
        SELECT *, CASE WHEN time IS NOT NULL AND NOT late THEN row_number() OVER (
                      PARTITION BY city, time, time IS NULL OR late ORDER BY delivery, event_id) END AS place
        FROM delivered""",
            },
        ),
        "hourly_run": _readings(
            f"""SELECT {hour_columns}, {HOUR_TEXT} AS "@timestamp", {_document_id("hourly")} AS doc_id
                FROM hourly""",
            joined_raw,
        ),
        "daily_run": _readings("SELECT * FROM trend", joined_raw, _daily()),
    }
    sql["hourly_run_scoped"] = sql["hourly_run"]
    sql["hourly_hour"] = _readings(
        f"SELECT {hour_columns} FROM hourly WHERE year = 2024 AND month = 1 AND day = 9 AND hour = 19", joined
    )
    return sql
