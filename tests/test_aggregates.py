import re
from contextlib import ExitStack
from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aerostrata.operators.aggregates import category_counts, daily_rollup, hourly_means, window_stats
from aerostrata.operators.joins import (
    enrich_static,
    heavy_minutes,
    is_small,
    join_minute_left,
    join_weather_chain,
    with_minute,
)
from aerostrata.operators.trends import in_period, with_trend
from aerostrata.schemas import DIMENSION
from aerostrata.session import session_setting

AIR = "city string, timestamp_utc string, aqi int, pm25 double"


def air(spark, rows):
    return spark.createDataFrame(rows, AIR)


def weather(spark, metric, rows):
    return spark.createDataFrame(rows, f"city string, timestamp_utc string, {metric} double")


def test_minute_join_is_many_to_many(spark):
    readings = air(
        spark,
        [
            ("A", "2024-01-01T00:00:01", 10, 1.0),
            ("A", "2024-01-01T00:00:59", 20, 2.0),
            ("A", "2024-01-01T00:01:00", 30, 3.0),
        ],
    )
    wind = weather(spark, "wind_speed", [("A", f"2024-01-01T00:00:{s}", float(s)) for s in (10, 20, 30)])
    joined = join_minute_left(with_minute(readings), wind, "wind_speed")
    assert joined.count() == 7
    assert joined.filter("wind_speed IS NULL").count() == 1


def test_absent_sources_give_typed_nulls(spark):
    readings = air(spark, [("A", "2024-01-01T00:00:01", 10, 1.0)])
    joined = join_weather_chain(readings)
    assert dict(joined.dtypes)["humidity"] == "double"
    means = hourly_means(readings)
    assert dict(means.dtypes)["avg_hum"] == "double"
    row = means.first()
    assert (row.aqi_mean, row.pm25_mean, row.avg_hum, row.avg_temp, row.avg_wind) == (10, 1, None, None, None)
    assert (row.year, row.month, row.day, row.hour) == (2024, 1, 1, 0)


def averaged_join(readings, wind, temperature, humidity):
    """The definition: average the joined rows."""
    joined = join_weather_chain(readings, wind, temperature, humidity)
    return (
        joined.filter("join_time IS NOT NULL")
        .groupBy("city", F.date_trunc("hour", "join_time").alias("h"))
        .agg(*[F.avg(m) for m in ("aqi", "pm25", "temperature", "humidity", "wind_speed")])
        .drop("h")
    )


CITY, MINUTE = st.sampled_from(["A", "B"]), st.sampled_from([0, 1, 59, 60])
NUMBER = st.one_of(st.none(), st.integers(-50, 50).map(float))


def at(minute, second=0):
    return f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:{second:02d}"


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(CITY, MINUTE, st.one_of(st.none(), st.integers(0, 500)), NUMBER), min_size=1, max_size=8),
    *[st.lists(st.tuples(CITY, MINUTE, NUMBER), max_size=6) for _ in range(3)],
)
def test_hourly_means_equal_averages_over_the_join(spark, readings, wind, temperature, humidity):
    frames = [air(spark, [(c, at(m), a, p) for c, m, a, p in readings])]
    for metric, data in (("wind_speed", wind), ("temperature", temperature), ("humidity", humidity)):
        frames.append(weather(spark, metric, [(c, at(m), v) for c, m, v in data]))

    def key(row):
        return [(v is None, v or 0) for v in row]

    means = hourly_means(*frames).select("city", "aqi_mean", "pm25_mean", "avg_temp", "avg_hum", "avg_wind")
    got = sorted((tuple(r) for r in means.collect()), key=key)
    expected = sorted((tuple(r) for r in averaged_join(*frames).collect()), key=key)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a == pytest.approx(b)


def test_hourly_means_do_not_build_a_busy_minute(spark):
    """Two thousand rows a side in one minute would be 1.6e13 joined rows."""
    n = 2000
    base = spark.range(n).selectExpr("'A' AS city", "'2024-01-01T00:00:30' AS timestamp_utc", "id")
    readings = base.selectExpr("*", "cast(id % 2 AS int) AS aqi", "1D AS pm25")
    sides = [base.selectExpr("*", f"cast(id AS double) AS {m}") for m in ("wind_speed", "temperature", "humidity")]
    row = hourly_means(readings, *sides).first()
    assert row.aqi_mean == pytest.approx(0.5)
    assert row.avg_wind == pytest.approx((n - 1) / 2)


def test_hourly_plan_has_no_join_and_two_shuffles(spark, capsys):
    readings = air(spark, [("A", "2024-01-01T00:00:01", 10, 1.0)])
    sides = [weather(spark, m, [("A", at(0), 1.0)]) for m in ("wind_speed", "temperature", "humidity")]
    hourly_means(readings, *sides).explain()
    plan = capsys.readouterr().out
    assert "Join" not in plan
    assert plan.count("Exchange") == 2


HOURLY = (
    "city string, year int, month int, day int, hour int, aqi_mean double, pm25_mean double, "
    "avg_temp double, avg_hum double, avg_wind double"
)


def hours(spark, values):
    """(city, day, hour, pm25) rows; a day may be a date."""
    rows = []
    for city, day, hour, pm25 in values:
        when = day if isinstance(day, date) else date(2024, 1, day)
        rows.append((city, when.year, when.month, when.day, hour, 1.0, float(pm25), 1.0, 1.0, 1.0))
    return spark.createDataFrame(rows, HOURLY)


def test_polluted_hours_are_above_the_limit(spark):
    daily = daily_rollup(hours(spark, [("A", 1, 0, 50.0), ("A", 1, 1, 50.01)])).first()
    assert daily.polluted_hours_count == 1
    assert daily.pm25_peak_hour == 50.01
    assert daily.date == date(2024, 1, 1)


def test_daily_rollup_is_a_mean_of_hourly_means_rounded(spark):
    df = spark.createDataFrame(
        [
            ("A", 2024, 1, 1, 0, 10.0, 1.111, 20.04, 50.05, 3.0),
            ("A", 2024, 1, 1, 1, 11.0, 2.222, 20.05, 50.05, None),
        ],
        HOURLY,
    )
    row = daily_rollup(df).first()
    assert (row.pm25_avg, row.aqi_avg, row.temp_avg, row.hum_avg, row.wind_avg) == (1.67, 11.0, 20.0, 50.1, 3.0)


def test_trend(spark):
    values = [100, 110, 121.5, 100, 0, 5]
    daily = with_trend(daily_rollup(hours(spark, [("A", d + 1, 0, v) for d, v in enumerate(values)])))
    got = [(r.growth_pct, r.trend_status) for r in daily.orderBy("date").collect()]
    assert got == [
        (None, "STABLE"),
        (10.0, "STABLE"),
        (10.45, "WORSENING"),
        (-17.7, "IMPROVING"),
        (-100.0, "IMPROVING"),
        (None, "STABLE"),
    ]


def test_trend_edges(spark):
    values = [("A", 1, 0, 100), ("A", 2, 0, 90), ("B", 1, 0, 100), ("B", 2, 0, 89.99)]
    daily = with_trend(daily_rollup(hours(spark, values))).filter("day = 2")
    assert [(r.city, r.trend_status) for r in daily.orderBy("city").collect()] == [
        ("A", "STABLE"),
        ("B", "IMPROVING"),
    ]


def test_day_gap_compares_with_the_previous_existing_day(spark):
    daily = with_trend(daily_rollup(hours(spark, [("A", 1, 0, 100), ("A", 3, 0, 150)])))
    assert daily.filter("day = 3").first().growth_pct == 50.0


@pytest.mark.parametrize(
    "before,first", [(date(2024, 1, 31), date(2024, 2, 1)), (date(2023, 12, 31), date(2024, 1, 1))]
)
def test_month_edge(spark, before, first):
    daily = with_trend(daily_rollup(hours(spark, [("A", before, 0, 100), ("A", first, 0, 120)])))
    row = in_period(daily, first.year, first.month).first()
    assert (row.date, row.growth_pct) == (first, 20.0)


def readings(spark, values):
    """(city, minute, aqi) rows with parsed times."""
    df = spark.createDataFrame(
        [(c, datetime(2024, 1, 1, m // 60, m % 60), a, float(a), float(a)) for c, m, a in values],
        "city string, timestamp_utc timestamp, aqi int, pm25 double, pm10 double",
    )
    return df


def test_window_statistics(spark):
    dimension = spark.createDataFrame([("A", 1.0, 2.0, "X")], DIMENSION)
    data = [("A", m, a) for m, a in [(0, 10), (5, 20), (9, 30), (10, 40)]] + [("B", 3, 7)]
    got = {
        (r.city, r.window_start.minute): r
        for r in window_stats(readings(spark, data), dimension).collect()
    }
    assert len(got) == 3
    first = got["A", 0]
    assert (first.avg_aqi, first.stddev_aqi, first.p95_aqi, first.event_count) == (20.0, 10.0, 30, 3)
    assert (first.lat, first.lon, first.country) == (1.0, 2.0, "X")
    assert first.window_end == datetime(2024, 1, 1, 0, 10)
    assert got["A", 10].stddev_aqi is None
    assert got["B", 0].country is None


def test_category_counts(spark):
    data = [("A", 0, a) for a in (0, 50, 51, 101, 151, 200, 201, 1000)]
    row = category_counts(readings(spark, data)).first()
    assert (row.Good, row.Moderate, row.Unhealthy, row.Very_Unhealthy, row.Hazardous) == (2, 1, 1, 2, 2)


def test_dimension_is_broadcast_only_where_it_is_measured_small(spark, capsys):
    dimension = spark.createDataFrame([("A", 1.0, 2.0, "X")], DIMENSION)
    assert is_small(dimension) and not is_small(dimension, limit=10)
    df = readings(spark, [("A", 0, 1), ("B", 0, 2)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        enrich_static(df, dimension, small=True).explain()
        assert "BroadcastHashJoin" in capsys.readouterr().out
        wide = enrich_static(df, dimension)
        wide.explain()
        assert "SortMergeJoin" in capsys.readouterr().out
        assert wide.filter("country IS NULL").count() == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_cities_do_not_multiply_documents(spark):
    dimension = spark.createDataFrame([("A", 1.0, 2.0, "X"), ("A", 3.0, 1.0, "W")], DIMENSION)
    found = window_stats(readings(spark, [("A", 0, 1), ("B", 0, 2)]), dimension).collect()
    assert sorted((r.city, r.lat, r.lon, r.country) for r in found) == [("A", 3.0, 2.0, "X"), ("B", None, None, None)]
    assert len({r.doc_id for r in found}) == 2


def test_parts_of_the_chain_join_agree(spark, rows):
    air, wind, temperature, humidity = (clean_source(spark, m) for m in ("aqi", "wind_speed", "temperature", "humidity"))
    one = join_weather_chain(air, wind, temperature, humidity)
    many = join_weather_chain(air, wind, temperature, None, parts=8, most=1)
    assert rows(join_weather_chain(air, wind, temperature, humidity, parts=8, most=1)) == rows(one)
    assert many.columns == one.columns and many.filter("humidity IS NOT NULL").count() == 0


def test_only_hot_minutes_are_split(spark, rows):
    """One minute holds a third of all rows; its rows are dealt over the parts, all others stay on their key."""
    def side(metric, n):
        times = [f"2024-01-01T{k // 60 % 24:02d}:{k % 60 if k % 3 else 0:02d}:{k % 60:02d}" for k in range(n)]
        data = [("A", "2024-01-01T05:00:00" if k % 3 == 0 else t, float(k)) for k, t in enumerate(times)]
        return spark.createDataFrame(data, f"city string, timestamp_utc string, {metric} double")

    air, wind = side("aqi", 600), side("wind_speed", 90)
    keys = heavy_minutes(air, 100)
    assert len(keys) == 1 and heavy_minutes(air, 1000) == [] and heavy_minutes(air.limit(0), 1) == []
    split = join_weather_chain(air, wind, parts=8, most=100)
    assert rows(split) == rows(join_weather_chain(air, wind))
    # the rows of one key of the split join: no key holds the hot minute's 200 x 30 rows
    dealt = F.pmod(F.xxhash64(*[F.col(c) for c in ("city", "timestamp_utc", "aqi")]), F.lit(8))
    hot = split.where("join_time = timestamp '2024-01-01 05:00:00'")
    assert hot.groupBy(dealt).count().agg(F.max("count")).first()[0] < 200 * 30 / 4


def test_the_chain_join_unfolds_arrays(spark, rows):
    """More values than one array holds, nulls, a minute without weather: the rows of plain joins, minutes later."""
    readings = air(spark, [("A", at(0, n), n, 1.0) for n in range(3)] + [("A", at(59), 7, None), ("B", "bad", 1, 1.0)])
    wind = weather(spark, "wind_speed", [("A", at(0), float(n % 9) if n % 7 else None) for n in range(150)])
    humidity = weather(spark, "humidity", [("A", at(0), 1.0), ("A", at(0), None), ("A", "bad", 2.0), ("B", "bad", 2.0)])
    temperature = weather(spark, "temperature", [("A", at(0), 5.0)] * 2)
    chain = join_weather_chain(readings, wind, temperature, humidity)
    plain = readings
    for metric, source in (("wind_speed", wind), ("temperature", temperature), ("humidity", humidity)):
        plain = join_minute_left(with_minute(plain), source, metric)
    assert rows(chain, *plain.columns) == rows(plain) and chain.count() == 3 * 150 * 2 * 2 + 2
    plan = chain._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 3 and plan.rindex("Generate explode") < plan.index("Join")


def test_the_chain_join_unfolds_in_all_tasks(spark):
    """Adaptive execution would make one task of a few hundred readings, however many rows they give."""
    times = [f"2024-01-01T00:{n // 10 % 60:02d}:{n % 10:02d}" for n in range(600)]
    air, wind, temperature = (
        spark.createDataFrame([("A", t, float(n)) for n, t in enumerate(times)], f"city string, timestamp_utc string, {m} double")
        for m in ("aqi", "wind_speed", "temperature")
    )
    chosen = {"spark.sql.shuffle.partitions": "8", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    with ExitStack() as stack:
        for key, value in chosen.items():
            stack.enter_context(session_setting(spark, key, value))
        chain = join_weather_chain(air, wind, temperature)
        sizes = [r["count"] for r in chain.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 600 * 10 * 10 and len(sizes) > 4


def test_the_chain_join_unfolds_one_array_at_a_time(spark):
    """Loops compiled together would hold all rows that a reading gives."""
    chain = join_weather_chain(*(clean_source(spark, m) for m in ("aqi", "wind_speed", "temperature", "humidity")))
    assert len(chain.collect()) == 3 * 5**4
    plan = chain._jdf.queryExecution().executedPlan().toString()
    loops = re.findall(r"\*\((\d+)\) Generate explode\(_\w+", plan.partition("Initial Plan")[0])
    assert len(loops) == len(set(loops)) == 3


def test_the_chain_query_rounds_ahead_of_its_join(spark):
    from aerostrata.plans import catalog

    df = catalog.registered()["join_weather_chain"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("round(")


def clean_source(spark, metric):
    data = [("A", f"2024-01-01T00:0{m}:0{s}", float(m + s)) for m in range(3) for s in range(5)]
    return spark.createDataFrame(data, f"city string, timestamp_utc string, {metric} double")


def test_means_are_rounded_once(spark):
    hourly = "'A' city, 2024 year, 1 month, 1 day, {} hour, 52.12499999999D pm25_mean, 1D aqi_mean, 1D avg_temp, 1D avg_hum, 1D avg_wind"
    df = spark.sql(f"SELECT {hourly.format(0)}")
    assert daily_rollup(df).first().pm25_avg == 52.12


def test_no_python_in_the_plans(spark, capsys):
    df = readings(spark, [("A", 0, 1)])
    for frame in (window_stats(df), category_counts(df)):
        frame.explain()
    plan = capsys.readouterr().out
    assert "EvalPython" not in plan and "MapInPandas" not in plan
