import json
import os
from datetime import datetime
from pathlib import Path

import pytest

from aerostrata.operators.cleaning import clean
from aerostrata.plans import cli, jobs
from aerostrata.plans.jobs import Layout
from aerostrata.schemas import AIR, HUMIDITY, KINDS
from aerostrata.sources.raw import HourScope, read_raw
from aerostrata.sources.tables import read_table

SCOPE = HourScope(2024, 1, 2, 3)


def land(layout, kind, scope, records):
    parts = f"{scope.year:04d}/{scope.month:02d}/{scope.day:02d}/{scope.hour:02d}"
    folder = Path(layout.raw) / kind.folder / parts
    folder.mkdir(parents=True, exist_ok=True)
    number = len(list(folder.iterdir()))
    (folder / f"{kind.folder}_{number}.json").write_text("\n".join(map(json.dumps, records)) + "\n")


def reading(kind, value, minute, day=2, hour=3):
    time = f"2024-01-{day:02d}T{hour:02d}:{minute:02d}:00"
    ts = day * 86400 + hour * 3600 + minute * 60
    record = {"city": " oslo", kind.metric: value, "timestamp_utc": time, "ts": ts}
    return record | ({"pm25": 60.0 + minute} if kind is AIR else {})


@pytest.fixture
def layout(tmp_path):
    layout = Layout(str(tmp_path))
    for kind in KINDS.values():
        land(layout, kind, SCOPE, [reading(kind, 10, 0), reading(kind, 20, 1), reading(kind, 5000, 2)])
    return layout


def state(spark, layout, rows):
    """What is stored: clean air readings, hourly facts and documents."""
    found = [read_table(spark, layout.clean(AIR)), jobs.read_hourly(spark, layout)]
    found += [jobs.read_documents(spark, layout, name) for name in ("hourly", "weather_pairs")]
    return [df if df is None else rows(df) for df in found]


def test_hourly_run_and_rerun(spark, layout, rows):
    reports = jobs.hourly_run(spark, layout, SCOPE)
    assert [r.rows for r in reports] == [8, 1, 1, 1]
    assert reports[0].parts == {"air": 2, "wind": 2, "temperature": 2, "humidity": 2}
    hourly = jobs.read_hourly(spark, layout).first()
    assert (hourly.city, hourly.hour, hourly.aqi_mean, hourly.pm25_mean) == ("OSLO", 3, 15.0, 60.5)
    assert (hourly.avg_temp, hourly.avg_hum, hourly.avg_wind) == (15.0, 15.0, 15.0)

    before = state(spark, layout, rows)
    jobs.hourly_run(spark, layout, SCOPE)
    assert state(spark, layout, rows) == before
    assert jobs.pending_hours(spark, layout) == ([], set())


def test_late_arrival_replaces_its_hour(spark, layout):
    jobs.hourly_run(spark, layout, SCOPE)
    land(layout, AIR, SCOPE, [reading(AIR, 60, 5)])
    jobs.hourly_run(spark, layout, SCOPE)
    table = jobs.read_hourly(spark, layout)
    assert table.count() == 1
    assert table.first().aqi_mean == 30.0
    assert jobs.read_documents(spark, layout, "hourly").first().aqi_mean == 30.0


def test_late_readings_reach_the_hour_before(spark, tmp_path, rows):
    layout = Layout(str(tmp_path))
    land(layout, AIR, SCOPE, [reading(AIR, 10, 0, hour=2), reading(AIR, 40, 0, hour=3)])
    jobs.hourly_run(spark, layout, SCOPE)
    land(layout, AIR, HourScope(2024, 1, 2, 4), [reading(AIR, 30, 59, hour=2), reading(AIR, 50, 0, day=1, hour=23)])
    reports = jobs.hourly_run(spark, layout, HourScope(2024, 1, 2, 4))
    assert reports[1].rows == 2
    hours = rows(jobs.read_hourly(spark, layout), "day", "hour", "aqi_mean")
    assert hours == [(1, 23, 50.0), (2, 2, 20.0), (2, 3, 40.0)]
    documents = rows(jobs.read_documents(spark, layout, "hourly"), "day", "hour", "aqi_mean")
    assert documents == hours


@pytest.mark.parametrize("step", ["mark_hours", "append", "hourly_job", "export_job", "remove"])
def test_a_run_that_stopped_is_made_up_for(spark, tmp_path, rows, monkeypatch, step):
    """Late readings of an earlier hour reach its means wherever the run that stored them has stopped."""
    later = HourScope(2024, 1, 2, 4)
    layouts = [Layout(str(tmp_path / name)) for name in ("stopped", "whole")]
    for layout in layouts:
        land(layout, AIR, SCOPE, [reading(AIR, 10, 0)])
        jobs.hourly_run(spark, layout, SCOPE)
        land(layout, AIR, later, [reading(AIR, 30, 59), reading(AIR, 50, 0, hour=4)])
    jobs.hourly_run(spark, layouts[1], later)

    def stop(*args, **kwargs):
        raise RuntimeError("stopped")

    place = jobs.keyed if step == "remove" else jobs
    with monkeypatch.context() as patch:
        patch.setattr(place, step, stop)
        with pytest.raises(RuntimeError):
            jobs.hourly_run(spark, layouts[0], later)
    jobs.hourly_run(spark, layouts[0], later)
    found = state(spark, layouts[0], rows)
    assert found == state(spark, layouts[1], rows)
    assert rows(jobs.read_hourly(spark, layouts[0]), "hour", "aqi_mean") == [(3, 20.0), (4, 50.0)]
    assert jobs.pending_hours(spark, layouts[0]) == ([], set())


def test_hours_cleaned_by_another_job_are_computed(spark, tmp_path, rows):
    layout = Layout(str(tmp_path))
    land(layout, AIR, SCOPE, [reading(AIR, 10, 0)])
    jobs.hourly_run(spark, layout, SCOPE)
    later = HourScope(2024, 1, 2, 4)
    land(layout, AIR, later, [reading(AIR, 30, 59)])
    jobs.clean_job(spark, layout)
    jobs.hourly_run(spark, layout, later)
    assert rows(jobs.read_hourly(spark, layout), "hour", "aqi_mean") == [(3, 20.0)]
    assert rows(jobs.read_documents(spark, layout, "hourly"), "hour", "aqi_mean") == [(3, 20.0)]


def test_many_pending_hours_are_computed_by_day(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(jobs, "MANY_HOURS", 2)
    layout = Layout(str(tmp_path))
    land(layout, AIR, SCOPE, [reading(AIR, h, 0, hour=h) for h in range(5)])
    jobs.hourly_run(spark, layout, SCOPE)
    assert rows(jobs.read_hourly(spark, layout), "hour", "aqi_mean") == [(h, float(h)) for h in range(5)]


def test_clean_reads_no_file_twice(spark, layout, rows):
    first = jobs.clean_kind(spark, layout, AIR)
    before = rows(read_table(spark, layout.clean(AIR)))
    for file in Path(layout.raw).glob("*/2024/01/02/03/*.json"):
        file.write_text("no longer readable as a record\n")
    assert (first, jobs.clean_kind(spark, layout, AIR)) == (2, 0)
    land(layout, AIR, SCOPE, [reading(AIR, 30, 9), reading(AIR, 10, 0)])
    old = HourScope(2023, 1, 1, 0)
    land(layout, AIR, old, [reading(AIR, 40, 10)])
    os.utime(next(Path(layout.raw).glob(f"{AIR.folder}/2023/01/01/00/*.json")), (1, 1))
    assert jobs.clean_kind(spark, layout, AIR) == 3
    found = rows(read_table(spark, layout.clean(AIR)))
    assert len(found) == 4 and set(before) < set(found)


def test_clean_of_few_files_at_a_time_gives_the_same(spark, tmp_path, rows):
    layouts = [Layout(str(tmp_path / name)) for name in ("one", "all")]
    for layout in layouts:
        for n in range(5):
            land(layout, AIR, SCOPE, [reading(AIR, n, m) for m in (n, n + 1) if m != n or n % 2 == 0])
    jobs.clean_kind(spark, layouts[0], AIR, max_files=1)
    jobs.clean_kind(spark, layouts[1], AIR)
    times = [rows(read_table(spark, layout.clean(AIR)), "timestamp_utc") for layout in layouts]
    assert times[0] == times[1] and len(set(times[0])) == len(times[0])


def test_second_run_over_everything(spark, layout, rows):
    reports = [[r.rows for r in jobs.hourly_run(spark, layout)]]
    before = state(spark, layout, rows)
    reports.append([r.rows for r in jobs.hourly_run(spark, layout)])
    assert reports == [[8, 1, 1, 1], [0, 1, 1, 1]] and state(spark, layout, rows) == before


def test_jobs_that_find_no_row_report_none(spark, layout):
    jobs.hourly_run(spark, layout)
    assert [r.rows for r in jobs.daily_run(spark, layout, 2024, 2)] == [0, 0]
    assert jobs.hourly_job(spark, layout, HourScope(2024, 1, 2, 9)).rows == 0
    schema = "city string, received_at timestamp, payload string"
    payloads = spark.createDataFrame([("oslo", datetime(2024, 1, 2), '{"nothing":1}'), ("oslo", None, None)], schema)
    report = jobs.shape_job(layout, payloads, payloads)
    assert report.parts == {"air": 0, "wind": 0, "temperature": 0, "humidity": 0}


def test_compaction_of_all_tables(spark, layout, rows):
    for _ in range(3):
        jobs.hourly_run(spark, layout, SCOPE)
    before = state(spark, layout, rows)
    args = ["compact", "--root", layout.root, "--many", "3", "--grace", "0"]
    call = lambda: cli.run(spark, cli.build_parser().parse_args(args))
    [report] = call()
    assert report.rows == 3 and report.parts["categories documents"] is None
    assert state(spark, layout, rows) == before
    assert [r.rows for r in call()] == [0]
    assert state(spark, layout, rows) == before
    assert len(list(Path(layout.hourly).rglob("version=*"))) == 1


def test_hourly_plan_skips_other_hours_and_columns(spark, layout, capsys):
    jobs.clean_job(spark, layout, SCOPE)
    jobs.hourly_facts(spark, layout, [SCOPE]).explain()
    plan = capsys.readouterr().out
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 4
    for scan in scans:
        assert "LessThan(timestamp_u" in scan
    assert "ReadSchema: struct<city:string,aqi:int,pm25:double,timestamp_utc:string>" in scans[0]


def test_readings_without_a_second_are_told_apart_by_their_time(spark, tmp_path, rows):
    whole, hourly = Layout(str(tmp_path / "w")), Layout(str(tmp_path / "h"))
    first, second = SCOPE, HourScope(2024, 1, 2, 4)
    for layout in (whole, hourly):
        records = [reading(AIR, 10, 0) | {"ts": None}, reading(AIR, 20, 1) | {"ts": None}]
        land(layout, AIR, first, records)
        land(layout, AIR, second, [reading(AIR, 30, 2) | {"ts": None}, records[0]])
    jobs.clean_job(spark, whole)
    for scope in (first, second):
        jobs.clean_job(spark, hourly, scope)
    found = rows(read_table(spark, whole.clean(AIR)), "aqi", "timestamp_utc", "ts")
    assert [r[0] for r in found] == [10, 20, 30] and {r[2] for r in found} == {None}
    assert rows(read_table(spark, hourly.clean(AIR)), "aqi", "timestamp_utc", "ts") == found


def test_time_text_is_parsed_once(spark, layout, capsys):
    clean(read_raw(spark, layout.raw, AIR), AIR).explain()
    assert capsys.readouterr().out.count("gettimestamp") == 1


def test_quality_report_is_stored(spark, layout, rows):
    report = jobs.quality_job(spark, layout, SCOPE)
    assert report.parts == {"air": 1, "wind": 1, "temperature": 1, "humidity": 1}
    jobs.quality_job(spark, layout, SCOPE)
    stored = read_table(spark, layout.quality)
    assert rows(stored, "kind", "rows_seen", "out_of_range", "valid") == [
        (k, 3, 1, 2) for k in ("air", "humidity", "temperature", "wind")
    ]


def test_payloads_land_as_raw_records(spark, tmp_path):
    layout = Layout(str(tmp_path / "store"))
    schema = "city string, received_at timestamp, payload string"
    when = datetime(2024, 1, 2, 3, 30)
    air = '{"data":[{"aqi":60,"co":1,"no2":2.5,"o3":3,"pm10":4,"pm25":5,"so2":6}]}'
    weather = '{"data":[{"wind_spd":1.5,"temp":20,"rh":80}]}'
    for name, text in (("air", air), ("weather", weather)):
        spark.createDataFrame([("oslo", when, text)], schema).write.parquet(str(tmp_path / name))
    args = ["shape", "--root", layout.root, "--air", str(tmp_path / "air"), "--weather", str(tmp_path / "weather")]
    [report] = cli.run(spark, cli.build_parser().parse_args(args))
    assert report.parts == {"air": 1, "wind": 1, "temperature": 1, "humidity": 1}
    assert [r.rows for r in jobs.hourly_run(spark, layout, SCOPE)] == [4, 1, 1, 1]


def test_absent_tables_log_no_error(spark, layout, capfd):
    spark.sparkContext.setLogLevel("ERROR")
    jobs.clean_job(spark, layout)
    spark.sparkContext.setLogLevel("OFF")
    assert "PATH_NOT_FOUND" not in capfd.readouterr().err


def test_append_mode_writes_again(spark, layout):
    for _ in range(2):
        jobs.clean_kind(spark, layout, AIR, SCOPE, "append")
    assert read_table(spark, layout.clean(AIR)).count() == 4
    with pytest.raises(ValueError):
        jobs.clean_kind(spark, layout, AIR, SCOPE, "replace")


def test_absent_kind_is_skipped_alone(spark, tmp_path):
    layout = Layout(str(tmp_path))
    land(layout, HUMIDITY, SCOPE, [reading(HUMIDITY, 10, 0)])
    report = jobs.clean_job(spark, layout, SCOPE)
    assert report.parts == {"air": None, "wind": None, "temperature": None, "humidity": 1}
    assert jobs.hourly_job(spark, layout, SCOPE).rows is None
    assert jobs.daily_job(spark, layout, 2024, 1).rows is None
    assert jobs.export_job(spark, layout, "pm25").rows is None


def test_no_valid_rows_write_nothing(spark, tmp_path):
    layout = Layout(str(tmp_path))
    land(layout, AIR, SCOPE, [reading(AIR, 5000, 0)])
    assert jobs.clean_kind(spark, layout, AIR, SCOPE) == 0
    assert jobs.clean_kind(spark, layout, AIR) == 0


def test_hour_without_weather_has_null_means(spark, tmp_path):
    layout = Layout(str(tmp_path))
    land(layout, AIR, SCOPE, [reading(AIR, 10, 0)])
    jobs.hourly_run(spark, layout, SCOPE)
    row = jobs.read_hourly(spark, layout).first()
    assert (row.aqi_mean, row.avg_hum, row.avg_temp, row.avg_wind) == (10.0, None, None, None)


def test_daily_run(spark, tmp_path, rows):
    layout = Layout(str(tmp_path))
    for day, minute in ((1, 0), (2, 30), (3, 30)):
        land(layout, AIR, SCOPE, [reading(AIR, 10, minute, day)])
    jobs.clean_job(spark, layout)
    jobs.hourly_job(spark, layout)
    reports = jobs.daily_run(spark, layout, 2024, 1)
    assert [r.rows for r in reports] == [3, 3]
    daily = read_table(spark, layout.daily)
    columns = ("day", "pm25_avg", "growth_pct", "trend_status", "polluted_hours_count")
    expected = [
        (1, 60.0, None, "STABLE", 1), (2, 90.0, 50.0, "WORSENING", 1), (3, 90.0, 0.0, "STABLE", 1)
    ]
    assert rows(daily, *columns) == expected
    jobs.daily_run(spark, layout, 2024, 1, 2)
    assert rows(read_table(spark, layout.daily), *columns) == expected
    documents = jobs.read_documents(spark, layout, "pm25")
    assert documents.count() == 3
    assert set(documents.columns) == {
        "doc_id", "city", "timestamp", "pm25", "aqi_mean", "avg_temp", "avg_hum", "avg_wind", "doc_day"
    }


def test_export_period(spark, layout):
    jobs.clean_job(spark, layout)
    jobs.hourly_job(spark, layout)
    assert jobs.export_job(spark, layout, "pm25", 2024, 2).rows == 0
    assert jobs.export_job(spark, layout, "pm25", 2024, 1, 2).rows == 1
    with pytest.raises(ValueError):
        jobs.export_job(spark, layout, "pm25", day=2)


def test_command_line(spark, layout):
    def call(*args):
        return cli.run(spark, cli.build_parser().parse_args([*args, "--root", layout.root]))

    hour = ["--year", "2024", "--month", "1", "--day", "2", "--hour", "3"]
    assert [r.rows for r in call("clean")] == [8]
    assert [r.rows for r in call("hourly", *hour)] == [1]
    assert [r.rows for r in call("daily", *hour[:4])] == [1]
    assert [r.rows for r in call("export", "--name", "pm25")] == [1]
    assert [r.rows for r in call("hourly-run", *hour)] == [8, 1, 1, 1]
    assert [r.rows for r in call("hourly-run")][1:] == [None, 0, 0]
    assert [r.rows for r in call("dq", *hour)] == [4]
    assert [r.rows for r in call("daily-run", *hour[:6])] == [1, 1]
    with pytest.raises(ValueError):
        call("hourly", "--year", "2024")
    with pytest.raises(ValueError):
        call("daily", "--year", "2024")


def test_stream_command_line(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "m.json").write_text(json.dumps(reading(AIR, 10, 0)) + "\n")
    spark.sql("SELECT 'OSLO' city, 60.0D lat, 10.5D lon, 'Norway' country").write.parquet(
        str(tmp_path / "cities")
    )
    root = ["--root", str(tmp_path / "store"), "--files", str(inbox), "--available-now"]
    cli.run(spark, cli.build_parser().parse_args(["stream", "--dimension", str(tmp_path / "cities"), *root]))
    layout = Layout(str(tmp_path / "store"))
    row = jobs.read_documents(spark, layout, "statistics").first()
    assert (row.city, row.avg_aqi, row.country) == ("OSLO", 10.0, "Norway")
    assert jobs.read_documents(spark, layout, "categories").first().Good == 1
    cli.run(spark, cli.build_parser().parse_args(["land", "--kind", "air", *root]))
    assert jobs.clean_kind(spark, layout, AIR) == 1
