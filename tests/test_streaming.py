"""Streams give what the same functions give on a batch."""

import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from strandlake.sources.tabular import json_stream
from strandlake.streaming import jobs, windows

SCHEMA = "event_id string, timestamp string, gene string, classification string, qual double"


def event(i, at, gene="TP53", kind="Benign", qual=30.0):
    return {"event_id": f"e{i}", "timestamp": f"2024-01-01T{at}", "gene": gene, "classification": kind, "qual": qual}


def write(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(e if isinstance(e, str) else json.dumps(e) for e in events) + "\n")


def timed(df):
    return windows.event_time(df.withColumn("ts", F.to_timestamp("timestamp")))


@pytest.fixture()
def source(tmp_path):
    folder = tmp_path / "in"
    write(folder, "1.json", [event(1, "10:00:00"), event(2, "10:00:59", kind="Pathogenic"), event(3, "10:01:00", "BRCA1", "Pathogenic", 20.0)])
    write(folder, "2.json", [event(4, "10:01:30", kind="Pathogenic"), event(5, "11:00:00")])
    return folder


def counts(df):
    return windows.tumbling(timed(df), ["classification"], F.col("qual"))


def test_window_boundary_and_batch_equality(spark, source, tmp_path):
    batch = counts(spark.read.schema(SCHEMA).json(str(source)))
    got = {(str(r["window_start"])[11:16], r["classification"]): (r["n"], r["mean_value"]) for r in batch.collect()}
    assert got["10:00", "Pathogenic"] == (1, 30.0) and got["10:01", "Pathogenic"] == (2, 25.0) and got["10:00", "Benign"] == (1, 30.0)
    stream = counts(json_stream(spark, str(source), SCHEMA, files_per_batch=1))
    jobs.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    done = spark.read.parquet(str(tmp_path / "out"))
    closed = batch.filter("window_end <= timestamp'2024-01-01 10:50:00'")
    assert rows(done, "window_start", "classification") == rows(closed, "window_start", "classification")


def test_late_rows_are_dropped_and_found_by_reconciliation(spark, source, tmp_path):
    state, out = str(tmp_path / "state"), str(tmp_path / "out")
    stream = lambda: counts(json_stream(spark, str(source), SCHEMA, files_per_batch=1))
    jobs.append_stream(stream(), out, state).awaitTermination()
    write(source, "3.json", [event(6, "10:00:30"), event(7, "12:30:00")])
    jobs.append_stream(stream(), out, state).awaitTermination()
    batch = counts(spark.read.schema(SCHEMA).json(str(source))).filter("window_end <= timestamp'2024-01-01 10:50:00'")
    missing = jobs.reconcile(spark.read.parquet(out), batch, ["window_start", "classification"]).collect()
    assert [(r["landed"], r["streamed"]) for r in missing] == [(2, 1)]


def test_replay_from_the_oldest(spark, source, tmp_path):
    for run in ("a", "b"):
        raw = json_stream(spark, str(source), SCHEMA)
        jobs.append_stream(windows.urgent(raw), str(tmp_path / run), str(tmp_path / f"state-{run}")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "a"))) == rows(spark.read.parquet(str(tmp_path / "b")))
    assert spark.read.parquet(str(tmp_path / "a")).count() == 1


def test_landing_separates_bad_records_and_does_not_repeat(spark, tmp_path):
    source = tmp_path / "raw"
    write(source, "1.json", [event(1, "10:00:00"), '{"event_id": "e2", ', event(3, "11:30:00")])
    good, bad = str(tmp_path / "bronze"), str(tmp_path / "errors")
    for _ in range(2):
        records = jobs.parsed(spark.readStream.text(str(source)), SCHEMA)
        for q in jobs.land(records, "timestamp", good, bad, str(tmp_path / "state"), interval=None):
            q.awaitTermination()
    landed = spark.read.json(good)
    assert landed.count() == 2 and {r["hour"] for r in landed.collect()} == {10, 11}
    assert [r[0] for r in spark.read.text(bad).collect()] == ['{"event_id": "e2", ']


def test_refresh_takes_new_files_only(spark, source, tmp_path):
    for _ in range(2):
        jobs.refresh(spark, str(source), SCHEMA, lambda df: df.filter("qual >= 30"), str(tmp_path / "silver"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 4
    write(source, "9.json", [event(9, "12:00:00")])
    jobs.refresh(spark, str(source), SCHEMA, lambda df: df.filter("qual >= 30"), str(tmp_path / "silver"), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "silver")).count() == 5


def test_alerts_and_monitor(spark, source, tmp_path):
    stream = windows.alerts(counts(json_stream(spark, str(source), SCHEMA)), "classification")
    jobs.write_alerts(stream, str(tmp_path / "alerts"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "alerts") + "/batch=*")
    assert sorted(r["n"] for r in got.collect()) == [1, 2] and "Pathogenic: 2 events" in "".join(r["message"] for r in got.collect())
    qc = spark.createDataFrame([("s1", "2024-01-01 10:00:30", 0.8), ("s1", "2024-01-01 10:01:30", 0.95)], "sample string, ts string, rate double")
    status = {str(r["window_start"])[11:16]: r["status"] for r in windows.sliding_monitor(windows.event_time(qc), "sample", "rate").collect()}
    assert status == {"09:59": "WARN", "10:00": "OK", "10:01": "OK"}


def test_lag():
    now = datetime(2024, 1, 1, 10, 2, 0, tzinfo=timezone.utc)
    assert jobs.lag_seconds("2024-01-01T10:00:30.000Z", now) == 90.0


def test_lag_monitor_hears_progress(spark, source, tmp_path):
    import time
    monitor = jobs.LagMonitor()
    spark.streams.addListener(monitor)
    try:
        stream = counts(json_stream(spark, str(source), SCHEMA))
        jobs.append_stream(stream, str(tmp_path / "o"), str(tmp_path / "s")).awaitTermination()
        for _ in range(50):
            if monitor.latest:
                break
            time.sleep(0.1)
        assert monitor.latest and all(late for _, late in monitor.latest.values())
    finally:
        spark.streams.removeListener(monitor)
