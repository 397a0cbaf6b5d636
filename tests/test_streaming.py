import json
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from aerostrata.plans.jobs import Layout, clean_kind, read_documents, stream_job
from aerostrata.schemas import AIR, DIMENSION
from aerostrata.sinks.keyed import read_keyed
from aerostrata.sources.messages import read_message_files
from aerostrata.sources.raw import read_raw
from aerostrata.streaming import outputs
from aerostrata.streaming.losses import LossRecorder
from aerostrata.streaming.readings import (
    clean_readings,
    decode,
    dedupe,
    ten_minute_categories,
    ten_minute_statistics,
)

ON = ["doc_day", "doc_hour", "pivot_doc_id"]
BANDS = ["Good", "Moderate", "Unhealthy", "Very_Unhealthy", "Hazardous"]


def message(city, minute, aqi, second=0, **more):
    time = f"2024-01-01T{10 + minute // 60:02d}:{minute % 60:02d}:{second:02d}"
    record = {"city": city, "aqi": aqi, "pm25": 1.0, "pm10": 2.0, "timestamp_utc": time, "ts": 1, **more}
    return json.dumps({k: v for k, v in record.items() if v is not None})


class Inbox:
    """A folder of message files processed by restarted one-shot queries."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder = spark, tmp_path / "inbox"
        self.folder.mkdir()
        self.table, self.checkpoint = str(tmp_path / "table"), str(tmp_path / "checkpoint")
        self.files = 0

    def put(self, *lines):
        if not lines:
            return
        (self.folder / f"m{self.files:03d}.json").write_text("\n".join(lines) + "\n")
        self.files += 1

    def stream(self):
        return read_message_files(self.spark, str(self.folder))

    def categories(self, *lines):
        self.put(*lines)
        outputs.start_documents(
            ten_minute_categories(self.stream()), self.table, "pivot_doc_id", self.checkpoint, True
        ).awaitTermination()
        rows = read_keyed(self.spark, self.table, ON).collect()
        return {(r.city, r.window_start.hour, r.window_start.minute): [r[b] for b in BANDS] for r in rows}


@pytest.fixture
def inbox(spark, tmp_path):
    return Inbox(spark, tmp_path)


def batch(spark, *lines):
    return spark.createDataFrame([(bytearray(t, "utf8"),) for t in lines], "value binary")


def test_decode_keeps_neighbours_of_a_bad_field(spark):
    df = decode(batch(spark, message("a", 0, "x"), "{bad", message("b", 1, 5), ""))
    got = [(r.city, r.aqi, r.pm25) for r in df.collect()]
    assert got == [("a", None, 1.0), (None, None, None), ("b", 5, 1.0), (None, None, None)]
    assert df.collect()[0].timestamp_utc == datetime(2024, 1, 1, 10)


def test_category_and_score_are_added(spark):
    row = clean_readings(decode(batch(spark, message(" a ", 0, 120)))).first()
    assert (row.city, row.aqi_category, row.aqi_risk_score) == ("A", "Unhealthy", 0.6)


def test_differently_written_cities_both_stay(spark):
    lines = message(" abc ", 0, 10), message("ABC", 0, 20)
    assert clean_readings(decode(batch(spark, *lines))).count() == 2
    assert clean_readings(decode(batch(spark, *lines)), normalize_first=True).count() == 1


def test_repeats_across_batches_count_once(inbox):
    assert inbox.categories(message("a", 0, 10), message("a", 0, 10)) == {("A", 10, 0): [1, 0, 0, 0, 0]}
    got = inbox.categories(message("a", 0, 10), message("a", 1, 60))
    assert got == {("A", 10, 0): [1, 1, 0, 0, 0]}


def test_reading_without_index_hides_its_later_twin(inbox):
    inbox.categories(message("a", 0, None), message("a", 1, 10))
    assert inbox.categories(message("a", 0, 20)) == {("A", 10, 0): [1, 0, 0, 0, 0]}


def test_late_rows_are_dropped(inbox):
    inbox.categories(message("a", 0, 10))
    inbox.categories(message("a", 45, 10))
    got = inbox.categories(message("a", 5, 10), message("a", 44, 10))
    assert got == {("A", 10, 0): [1, 0, 0, 0, 0], ("A", 10, 40): [2, 0, 0, 0, 0]}


def test_unreadable_time_reaches_no_window(inbox):
    got = inbox.categories(message("a", 0, 10), message("a", 0, 20, timestamp_utc="bad"), "{bad")
    assert got == {("A", 10, 0): [1, 0, 0, 0, 0]}


def test_restart_without_new_messages_changes_nothing(inbox):
    before = inbox.categories(message("a", 0, 10), message("b", 3, 300))
    outputs.start_documents(
        ten_minute_categories(inbox.stream()), inbox.table, "pivot_doc_id", inbox.checkpoint, True
    ).awaitTermination()
    assert read_keyed(inbox.spark, inbox.table, ON).count() == len(before)


def test_batch_equals_stream(spark, tmp_path, rows):
    # copies of a (city, second) are equal, so it does not matter which one survives
    lines = [message(f"c{n % 3}", n % 50, (n % 150) * 13 % 400, n % 7) for n in range(150) for _ in range(2)]
    lines = list({(m["city"], m["timestamp_utc"]): m for m in map(json.loads, lines)}.values())
    lines = [json.dumps(m) for m in lines for _ in range(2)]
    box = Inbox(spark, tmp_path)
    box.put(*lines)
    layout = Layout(str(tmp_path))
    dimension = spark.createDataFrame([("C0", 1.0, 2.0, "X")], DIMENSION)
    for query in stream_job(box.stream(), dimension, layout, available_now=True):
        query.awaitTermination()
    messages = batch(spark, *lines)
    for name, expected in (
        ("statistics", ten_minute_statistics(messages, dimension)),
        ("categories", ten_minute_categories(messages)),
    ):
        doubles = {f.name for f in expected.schema.fields if f.dataType.typeName() == "double"}
        columns = [F.round(c, 9).alias(c) if c in doubles else c for c in expected.columns]
        assert rows(read_documents(spark, layout, name), *columns) == rows(expected, *columns)


def test_plain_inserts_without_an_id(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    for n in range(2):
        box.put(message("a", 0, 10, n))
        outputs.start_documents(
            ten_minute_categories(box.stream()), box.table, None, box.checkpoint, True
        ).awaitTermination()
    assert sorted(r.Good for r in read_keyed(spark, box.table, ON).collect()) == [1, 2]


def test_failed_write_stops_the_query_and_repeats_after_restart(spark, tmp_path, monkeypatch):
    box = Inbox(spark, tmp_path)

    def fail(*args, **kwargs):
        raise OSError("no space")

    with monkeypatch.context() as patch:
        patch.setattr(outputs, "upsert", fail)
        with pytest.raises(StreamingQueryException):
            box.categories(message("a", 0, 10))
    assert box.categories(message("a", 1, 10)) == {("A", 10, 0): [2, 0, 0, 0, 0]}


def test_landing_writes_by_arrival_hour_and_is_scanned_as_raw(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(message("a", 0, 10, ts=5), message("a", 1, 20, ts=6), "{bad")
    root = str(tmp_path / "raw")
    for _ in range(2):
        outputs.start_landing(box.stream(), AIR, root, box.checkpoint, True).awaitTermination()
    raw = read_raw(spark, root, AIR)
    assert sorted((r.ts, r.aqi) for r in raw.collect()) == [(5, 10), (6, 20)]
    layout = Layout(str(tmp_path / "store"))
    outputs.start_landing(
        box.stream(), AIR, layout.raw, str(tmp_path / "second"), True
    ).awaitTermination()
    assert clean_kind(spark, layout, AIR) == 2


def test_dedupe_state_is_bounded_by_the_watermark(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    table, check = str(tmp_path / "kept"), str(tmp_path / "check")

    def run():
        query = (
            dedupe(decode(box.stream()))
            .writeStream.format("parquet")
            .option("path", table)
            .option("checkpointLocation", check)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        return [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress]

    box.put(message("a", 0, 10), message("a", 0, 10), message("a", 2, 10))
    run()
    box.put(message("a", 90, 10))
    assert run()[-1] == 2
    assert spark.read.parquet(table).count() == 3


def test_writes_are_adaptive_and_state_is_not(spark, tmp_path, monkeypatch):
    box, seen = Inbox(spark, tmp_path), []
    key = "spark.sql.adaptive.enabled"
    real = outputs.upsert

    def spy(batch, *args, **kwargs):
        seen.append(batch.sparkSession.conf.get(key))
        real(batch, *args, **kwargs)
        box.session = batch.sparkSession

    monkeypatch.setattr(outputs, "upsert", spy)
    box.categories(message("a", 0, 10))
    assert set(seen) == {"true"}
    assert box.session.conf.get(key) == "false"


def test_a_batch_written_before_it_was_committed_is_replaced(spark, tmp_path, monkeypatch):
    """Stop between the write and the commit: the repeated batch leaves the same files and rows, no second version."""
    box, real = Inbox(spark, tmp_path), outputs.upsert
    box.categories(message("a", 0, 10))

    def stop_after(*args, **kwargs):
        real(*args, **kwargs)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(outputs, "upsert", stop_after)
        with pytest.raises(StreamingQueryException):
            box.categories(message("a", 1, 60))
    folders = lambda: sorted(str(p.parent) for p in Path(box.table).rglob("*.parquet"))
    before = folders()
    assert box.categories() == {("A", 10, 0): [1, 1, 0, 0, 0]}
    assert folders() == before


def test_state_after_a_restart_holds_no_expired_key(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.categories(message("a", 0, 10), message("b", 1, 10))
    box.categories(message("a", 60, 10), message("a", 61, 20), message("a", 61, 20))

    def keys(operator):
        state = spark.read.format("statestore").option("operatorId", operator).load(box.checkpoint)
        return sorted(str(r.key.timestamp_utc) for r in state.select("key").collect())

    # the watermark is 10:51: of the dedupe keys the live ones stay, once each
    live = ["2024-01-01 11:00:00", "2024-01-01 11:01:00"]
    found = sorted(n for n in range(3) if "timestamp_utc" in spark.read.format("statestore").option("operatorId", n).load(box.checkpoint).select("key.*").columns)
    assert len(found) == 2
    assert [keys(n) for n in found] == [live, live]
    assert box.categories(message("a", 60, 10), message("a", 20, 10)) == {
        ("A", 10, 0): [1, 0, 0, 0, 0], ("B", 10, 0): [1, 0, 0, 0, 0], ("A", 11, 0): [2, 0, 0, 0, 0]
    }


def test_a_query_that_fails_takes_the_other_with_it(spark, tmp_path):
    box = Inbox(spark, tmp_path)
    box.put(message("a", 0, 10))
    ended = []

    def fail(batch, batch_id):
        raise OSError("no space")

    def start(name, write, **trigger):
        writer = decode(box.stream()).writeStream.queryName(name).foreachBatch(write)
        return writer.option("checkpointLocation", str(tmp_path / name)).trigger(**trigger).start()

    healthy = start("healthy", lambda batch, batch_id: ended.append(batch_id), processingTime="1 second")
    failing = start("failing", fail, processingTime="1 second")
    with pytest.raises(StreamingQueryException, match="no space"):
        outputs.supervise(spark, [healthy, failing])
    assert not healthy.isActive and healthy.exception() is None
    fine = [start(f"fine{n}", lambda batch, batch_id: ended.append(batch_id), availableNow=True) for n in range(2)]
    outputs.supervise(spark, fine, until_all_end=True)
    assert not any(q.isActive for q in fine)


def test_losses_are_stored_by_micro_batch(spark, tmp_path, rows):
    box, path = Inbox(spark, tmp_path), str(tmp_path / "losses")
    recorder = LossRecorder(spark, path)
    spark.streams.addListener(recorder)

    def run(*lines, name="counts", normalize_first=False):
        box.put(*lines)
        stream = clean_readings(decode(box.stream()), normalize_first)
        writer = stream.writeStream.queryName(name).foreachBatch(lambda batch, _: batch.count())
        query = writer.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        query.awaitTermination()
        recorder.wait(query)

    copies = [message("a", 30, 10)] * 3
    try:
        run(*copies, message("a", 31, None), message("a", 32, 5000), message("b", 33, 7), "{bad")
        run(message("a", 5, 10), message("a", 6, None), message("a", 30, 10), message("a", 50, 1))
        run(message("a", 59, 10), name="other", normalize_first=True)
    finally:
        spark.streams.removeListener(recorder)
    columns = ("query", "rows_read", "no_time", "late", "duplicate", "incomplete", "out_of_range", "valid")
    found = rows(spark.read.parquet(path), *columns)
    assert found == [
        ("counts", 4, 0, 2, 1, 0, 0, 1), ("counts", 7, 1, 0, 2, 1, 1, 2), ("other", 12, 0, 0, 3, 3, 1, 5)
    ]
