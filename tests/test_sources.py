from datetime import datetime
from pathlib import Path

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from aerostrata.schemas import AIR, WIND
from aerostrata.session import shared_folder
from aerostrata.sources import payloads
from aerostrata.sources.messages import broker_options
from aerostrata.operators.quality import dq_report
from aerostrata.sources.raw import HourScope, raw_path, read_lines, read_raw
from aerostrata.sources.tables import previous_month, read_day, read_table, read_two_months

LINE = '{"city":"a","wind_speed":%s,"timestamp_utc":"2024-01-01T00:00:00","ts":%d}'


def put(folder, *lines):
    folder.mkdir(parents=True)
    (folder / "part.json").write_text("\n".join(lines) + "\n")


def test_hour_scope_reads_its_folder_in_either_layout(spark, tmp_path):
    put(tmp_path / "weather_wind/2024/01/02/03", LINE % (1, 1), "", "{bad")
    put(tmp_path / "weather_wind/year=2024/month=01/day=02/hour=03", LINE % (2, 2))
    put(tmp_path / "weather_wind/2024/01/02/04", LINE % (3, 3))
    root = str(tmp_path)
    scoped = read_raw(spark, root, WIND, HourScope(2024, 1, 2, 3))
    assert sorted(r.ts for r in scoped.collect()) == [1, 2]
    assert scoped.columns == WIND.schema.fieldNames()
    assert read_raw(spark, root, WIND).count() == 3


def test_nothing_landed_is_none(spark, tmp_path):
    assert read_raw(spark, str(tmp_path), AIR) is None
    put(tmp_path / "weather_wind/2024/01/02/03", LINE % (1, 1))
    assert read_raw(spark, str(tmp_path), WIND, HourScope(2024, 1, 2, 5)) is None


def test_scope_needs_all_parts_or_none():
    assert HourScope.of() is None
    assert HourScope.of("2024", "1", "2", "0") == HourScope(2024, 1, 2, 0)
    with pytest.raises(ValueError):
        HourScope.of(year=2024)
    assert raw_path("/r/", AIR).endswith("air_quality/*/*/*/*")


def answers(spark, *texts):
    when = datetime(2024, 1, 1, 23, 30)
    return spark.createDataFrame(
        [("Oslo", when, t) for t in texts], "city string, received_at timestamp, payload string"
    )


def test_air_payloads(spark):
    full = '{"data":[{"aqi":60,"co":1,"no2":2.5,"o3":3,"pm10":4,"pm25":null,"so2":6},{"aqi":1}]}'
    got = payloads.shape_air(
        answers(spark, full, '{"error":1}', '{"data":[]}', '{"data":[{"aqi":1}]}', "{bad"), "Asia/Bangkok"
    ).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.city, row.aqi, row.no2, row.pm25, row.so2) == ("Oslo", 60, 2.5, None, 6.0)
    assert row.timestamp_utc == "2024-01-01T23:30:00"
    assert row.timestamp_local == "2024-01-02T06:30:00"
    assert row.ts == 1704151800


def test_weather_payloads(spark, capsys):
    metrics = payloads.weather_metrics(
        answers(spark, '{"data":[{"wind_spd":1.5,"temp":20,"rh":80}]}', '{"data":[{"temp":1}]}')
    )
    wind = payloads.metric_records(metrics, "wind_speed")
    assert [tuple(r) for r in wind.collect()] == [("Oslo", 1.5, "2024-01-01T23:30:00", 1704151800)]
    assert payloads.metric_records(metrics, "temperature").first().temperature == 20.0
    assert payloads.metric_records(metrics, "humidity").first().humidity == 80.0
    assert wind.columns == WIND.schema.fieldNames()
    metrics.explain()
    assert capsys.readouterr().out.count("from_json") == 1


def test_broker_options():
    options = broker_options("broker:9092", "air")
    assert options["subscribe"] == "air"
    assert options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false"


@pytest.fixture
def days(spark, tmp_path):
    path = str(tmp_path / "days")
    data = [(2023, 12, 31), (2024, 1, 1), (2024, 1, 2), (2024, 2, 1)]
    df = spark.createDataFrame([(*d, i) for i, d in enumerate(data)], "year int, month int, day int, n int")
    df.write.partitionBy("year", "month", "day").parquet(path)
    return path


def break_folder(path):
    """A file no reader can open."""
    for file in Path(path).rglob("*.parquet"):
        file.write_bytes(b"no parquet")


def test_day_read_opens_its_folder_only(spark, days):
    break_folder(f"{days}/year=2024/month=2")
    break_folder(f"{days}/year=2024/month=1/day=1")
    day = read_day(spark, days, 2024, 1, 2)
    assert [(r.n, r.year, r.month, r.day) for r in day.collect()] == [(2, 2024, 1, 2)]
    assert all("day=2" in f for f in day.inputFiles())
    assert read_day(spark, days, 2024, 1, 3) is None


def test_two_months_cross_the_year(spark, days):
    assert previous_month(2024, 1) == (2023, 12)
    assert sorted(r.n for r in read_two_months(spark, days, 2024, 3).collect()) == [3]
    break_folder(f"{days}/year=2024/month=2")
    assert sorted(r.n for r in read_two_months(spark, days, 2024, 1).collect()) == [0, 1, 2]


def test_array_lines_hold_several_records(spark, tmp_path):
    folder = tmp_path / AIR.folder / "2024/01/02/03"
    folder.mkdir(parents=True)
    one = '{"city":"a","aqi":1,"timestamp_utc":"2024-01-02T03:00:00","ts":%d}'
    lines = [f"[{one % 1},{one % 2}]", one % 3, "[]", "[{", '[{"city":5,"aqi":"x"}]', f" [{one % 4}]"]
    (folder / "a.json").write_text("\n".join(lines))
    assert sorted(r.ts for r in read_raw(spark, str(tmp_path), AIR).collect()) == [1, 2, 3, 4]
    report = dq_report(read_lines(spark, str(tmp_path), AIR), AIR).collect()
    assert sum(r.rows_seen for r in report) == 6 and sum(r.malformed for r in report) == 2


def test_absent_table_is_none(spark, tmp_path):
    assert read_table(spark, str(tmp_path / "no")) is None
    assert read_day(spark, str(tmp_path / "no"), 2024, 1, 1) is None
    assert read_two_months(spark, str(tmp_path / "no"), 2024, 1) is None


def test_absence_is_not_logged_but_other_errors_are_raised(spark, tmp_path, capfd):
    read_table(spark, str(tmp_path / "no"))
    assert "PATH_NOT_FOUND" not in capfd.readouterr().err
    (tmp_path / "broken.parquet").write_text("no parquet")
    with pytest.raises((PySparkException, Py4JJavaError)):
        read_table(spark, str(tmp_path / "broken.parquet"))


def test_shared_folder_is_the_clusters(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
