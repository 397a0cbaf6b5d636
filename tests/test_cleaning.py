from datetime import date

import pytest
from pyspark.sql import functions as F

from aerostrata.operators import cleaning
from aerostrata.operators.quality import dq_report
from aerostrata.schemas import AIR, HUMIDITY, TEMPERATURE, WIND
from aerostrata.sources.raw import well_formed

T0 = "2024-01-01T00:00:00"


def air(spark, *rows):
    """Rows of (city, aqi, timestamp_utc, ts)."""
    df = spark.createDataFrame(list(rows), "city string, aqi int, timestamp_utc string, ts long")
    rest = [f.name for f in AIR.schema.fields if f.name not in df.columns]
    return df.selectExpr("*", *[f"cast(null AS double) {c}" for c in rest])


@pytest.mark.parametrize(
    "kind,values",
    [
        (AIR, [-1, 0, 1000, 1001]),
        (WIND, [-0.5, 0.0, 200.0, 200.5]),
        (TEMPERATURE, [-61.0, -60.0, 60.0, 61.0]),
        (HUMIDITY, [-1.0, 0.0, 100.0, 101.0]),
    ],
)
def test_range_edges(spark, rows, kind, values):
    dtype = kind.schema[kind.metric].dataType.simpleString()
    df = spark.createDataFrame([(v,) for v in values], f"{kind.metric} {dtype}")
    kept = cleaning.range_filter(df, kind.metric, kind.low, kind.high)
    assert rows(kept) == sorted([(v,) for v in values[1:3]], key=lambda r: str(r[0]))


def test_open_bounds(spark):
    df = spark.range(10)
    assert cleaning.range_filter(df, "id", low=7).count() == 3
    assert cleaning.range_filter(df, "id", high=6).count() == 7
    assert cleaning.range_filter(df, "id").count() == 10


def test_city_spellings_are_one_reading(spark, rows):
    df = air(spark, (" abc ", 5, T0, 1), ("ABC", 5, T0, 1))
    assert rows(cleaning.clean(df, AIR), "city", "aqi") == [("ABC", 5)]


def test_bad_time_and_nulls_are_rejected(spark, rows):
    df = air(
        spark,
        ("a", 5, "bad", 1),
        (None, 5, T0, 2),
        ("a", None, T0, 3),
        ("a", 5, None, 4),
        ("a", 5, T0, 5),
    )
    got = rows(cleaning.clean(df, AIR), "city", "ts", "year", "month", "day")
    assert got == [("A", 5, 2024, 1, 1)]


def test_invalid_first_reading_removes_its_valid_twin(spark):
    df = air(spark, ("a", -1, T0, 1), ("a", 50, T0, 1))
    assert cleaning.clean(df, AIR).count() == 0


def test_survivor_does_not_depend_on_partitioning(spark, rows):
    df = air(spark, *[("a", n % 17, T0, n % 5) for n in range(200)])
    results = [
        rows(cleaning.first_per_key(df.repartition(n), ("city", "ts")), "ts", "aqi") for n in (1, 3, 16)
    ]
    assert results[0] == results[1] == results[2]
    assert len(results[0]) == 5


def test_first_per_key_limits_rows_before_the_shuffle(spark, capsys):
    df = air(spark, ("a", 1, T0, 1))
    cleaning.first_per_key(df, ("city", "ts")).explain()
    plan = capsys.readouterr().out
    assert "Partial" in plan and plan.index("Exchange") < plan.index("Partial")


def test_malformed_lines_are_dropped_whatever_is_selected(spark, rows):
    lines = ['{"city":"x","aqi":60}', '{"city":"x","aqi":52.5}', '{"city":"x","aqi":"60"}', "{bad", "null"]
    df = well_formed(spark.createDataFrame([(t,) for t in lines], "value string"), AIR.schema)
    assert rows(df, "city", "aqi") == [("x", 60)]
    assert df.count() == 1
    assert df.select("city").count() == 1


def test_quality_report_counts_each_row_once(spark, rows):
    lines = [
        '{"city":"a","aqi":5,"timestamp_utc":"2024-01-01T00:00:00","ts":1}',
        '{"city":" A","aqi":6,"timestamp_utc":"2024-01-01T00:00:00","ts":1}',
        '{"city":"a","aqi":2000,"timestamp_utc":"2024-01-01T00:00:01","ts":2}',
        '{"city":"a","aqi":2000,"timestamp_utc":"2024-01-01T00:00:01","ts":2}',
        '{"city":"a","aqi":7,"timestamp_utc":"2024-01-02T00:00:01","ts":3}',
        '{"city":"a","timestamp_utc":"2024-01-02T00:00:01","ts":4}',
        '{"city":"a","aqi":7,"timestamp_utc":"bad","ts":5}',
        '{"aqi":7,"timestamp_utc":"bad","ts":5}',
        '{"city":"a","aqi":"7","timestamp_utc":"2024-01-02T00:00:01","ts":3}',
        "{bad",
    ]
    report = dq_report(spark.createDataFrame([(t,) for t in lines], "value string"), AIR)
    assert rows(report.drop("kind")) == [
        (date(2024, 1, 1), 4, 0, 0, 0, 2, 1, 1),
        (date(2024, 1, 2), 3, 1, 1, 0, 0, 0, 1),
        (None, 3, 1, 1, 1, 0, 0, 0),
    ]
    total = report.selectExpr(
        "sum(malformed + required_null + bad_time + duplicate + out_of_range + valid) AS n",
        "sum(rows_seen) AS seen",
    ).first()
    assert total.n == total.seen == len(lines)


def test_quality_report_agrees_with_cleaning(spark):
    lines = [
        f'{{"city":"c{n % 3}","aqi":{n % 7 * 300},"timestamp_utc":"2024-01-01T00:00:0{n % 5}","ts":{n % 5}}}'
        for n in range(60)
    ]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    valid = cleaning.clean(well_formed(df, AIR.schema), AIR).count()
    assert dq_report(df, AIR).agg(F.sum("valid")).first()[0] == valid
