from datetime import date, datetime
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from aerostrata.functions import (
    aqi_category,
    aqi_risk_score,
    day_key,
    document_id,
    hour_timestamp,
    parse_event_time,
    register_sql_functions,
)

EDGES = [0, 50, 51, 100, 101, 150, 151, 200, 201, 1000]
NAMES = ["Good", "Moderate", "Unhealthy", "Very Unhealthy", "Hazardous"]
RISKS = [0.1, 0.3, 0.6, 0.8, 1.0]


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_category_and_risk_edges(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(EDGES)], "i int, aqi int").orderBy("i")
    got = df.select(aqi_category(F.col("aqi")), aqi_risk_score(F.col("aqi"))).collect()
    assert [r[0] for r in got] == [n for n in NAMES for _ in range(2)]
    assert [r[1] for r in got] == [r for r in RISKS for _ in range(2)]


def test_null_index_has_no_risk(spark):
    null = F.lit(None).cast("int")
    assert one(spark, aqi_risk_score(null)) is None
    assert one(spark, aqi_category(null)) == "Hazardous"


def test_functions_in_sql(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([(i, a) for i, a in enumerate([*EDGES, None])], "i int, aqi int")
    df.createOrReplaceTempView("edges")
    got = spark.sql("SELECT aqi_category(aqi) c, aqi_risk_score(aqi) r FROM edges ORDER BY i").collect()
    assert [r.c for r in got] == [n for n in NAMES for _ in range(2)] + ["Hazardous"]
    assert [r.r for r in got] == [r for r in RISKS for _ in range(2)] + [None]


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-02-29T23:59:59", datetime(2024, 2, 29, 23, 59, 59)),
        ("bad", None),
        ("2024-02-30T00:00:00", None),
        ("2024-02-29 23:59:59", None),
        ("2024-02-29T23:59:59Z", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time(spark, text, expected):
    assert one(spark, parse_event_time(F.lit(text).cast("string"))) == expected


def test_plain_time_text_is_cast_and_other_text_goes_by_the_pattern(spark):
    texts = [
        "2024-02-29T23:59:59", "2023-02-29T00:00:00", "2024-01-01T24:00:00", "2024-01-01T00:00:60", "0000-01-01T00:00:00",
        "2024-01-01T00:00:0 ", " 2024-01-01T00:00:00", "2024-01-01T00:00:00\n", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00",
        "2024-01-01", "+12024-01-01T00:00:00", "1582-10-10T00:00:00", "0001-01-01T00:00:00", "bad", "", None,
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    by_pattern = F.try_to_timestamp("t", F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    differing = df.where(~parse_event_time(F.col("t")).eqNullSafe(by_pattern))
    assert differing.count() == 0
    plan = df.select(parse_event_time(F.col("t")))._jdf.queryExecution().analyzed().toString().lower()
    assert "cast(t#" in plan and "rlike" in plan


def test_hour_and_day_from_parts(spark):
    def parts(*values):
        return [F.lit(v) for v in values]

    assert one(spark, hour_timestamp(*parts(2024, 1, 31, 23))) == datetime(2024, 1, 31, 23)
    assert one(spark, hour_timestamp(*parts(2024, 2, 31, 23))) is None
    assert one(spark, hour_timestamp(*parts(2024, 1, 31, 24))) is None
    assert one(spark, day_key(*parts(2024, 2, 29))) == date(2024, 2, 29)
    assert one(spark, day_key(*parts(2023, 2, 29))) is None


def test_document_id_is_the_digest_of_its_parts(spark):
    moment = F.lit(datetime(2024, 1, 2, 3)).cast("timestamp")
    city = F.lit("OSLO")
    digest = sha256(b"OSLO_2024-01-02 03:00:00").hexdigest()
    pivot = sha256(b"OSLO_2024-01-02 03:00:00_pivot").hexdigest()
    assert one(spark, document_id(city, moment)) == digest
    assert one(spark, document_id(city, moment, "pivot")) == pivot
