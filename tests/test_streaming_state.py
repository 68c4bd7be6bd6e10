"""Keyed state of streams: order inside a key, state that shrinks, lag rows, bounded files."""

import json
import random

from pyspark.sql import functions as F

from conftest import rows
from strandlake.sources.tabular import json_stream
from strandlake.streaming import jobs, state, windows

SCHEMA = "id bigint, k string, ts timestamp"


def at(seconds):
    return f"2024-01-01T{10 + seconds // 3600:02d}:{seconds // 60 % 60:02d}:{seconds % 60:02d}.000Z"


def put(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps({"id": i, "k": k, "ts": at(s)}) + "\n" for i, k, s in events))


def stream(spark, folder):
    return json_stream(spark, str(folder), SCHEMA, files_per_batch=1).withWatermark("ts", "60 seconds")


def totals(query):
    return [json.loads(p.json)["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if json.loads(p.json)["stateOperators"]]


def test_an_unordered_stream_comes_out_in_order(spark, tmp_path):
    r = random.Random(4)
    events = [(i, r.choice(["a", "a", "b", None]), s) for i, s in enumerate(sorted(r.randrange(1800) for _ in range(400)))]
    arrival = sorted(events, key=lambda e: e[2] + r.randrange(50))  # later than the next ones by less than the delay
    for n in range(8):
        put(tmp_path / "in", f"{n}.json", arrival[n * 50:n * 50 + 50])
        import time
        time.sleep(0.02)  # files are taken in the order of their times
    put(tmp_path / "in", "9.json", [(999, "z", 9000)])
    ordered = state.in_key_order(stream(spark, tmp_path / "in"), "k", "ts", "id")
    query = jobs.append_stream(ordered, str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    want = sorted(events, key=lambda e: (e[2], e[0]))
    for k in ("a", "b", None):
        got = out.filter(F.col("k").eqNullSafe(F.lit(k))).orderBy("place").collect()
        assert [x.id for x in got] == [i for i, key, _ in want if key == k]
        assert [x.place for x in got] == list(range(1, len(got) + 1))
    assert totals(query)[-1] <= 4


def test_state_goes_when_the_watermark_has_passed(spark, tmp_path):
    put(tmp_path / "in", "1.json", [(i, f"k{i}", i) for i in range(100)])
    out, check = str(tmp_path / "out"), str(tmp_path / "state")
    ordered = lambda: state.in_key_order(stream(spark, tmp_path / "in"), "k", "ts", "id", time_to_live_ms=10_000)
    seen = []
    for name, second in (("2.json", 4000), ("3.json", 8000), ("4.json", 12000)):
        query = jobs.append_stream(ordered(), out, check)
        query.awaitTermination()
        seen += totals(query)
        put(tmp_path / "in", name, [(1000 + second, "late", second)])
    query = jobs.append_stream(ordered(), out, check)
    query.awaitTermination()
    assert max(seen) >= 60 and totals(query)[-1] <= 2
    assert spark.read.parquet(out).filter("id < 100").count() == 100


def test_burdens_are_forgotten_when_idle(spark, tmp_path):
    put(tmp_path / "in", "1.json", [(i, "hot", i) for i in range(5)] + [(9, "cold", 3)])
    run = lambda: jobs.write_alerts(state.burden_alerts(stream(spark, tmp_path / "in"), "k", "ts", 5, 100_000),
                                    str(tmp_path / "out"), str(tmp_path / "state"))
    run().awaitTermination()
    put(tmp_path / "in", "2.json", [(20, "hot", 60), (21, "other", 3000)])
    run().awaitTermination()
    put(tmp_path / "in", "3.json", [(30, "hot", 3050), (31, "other", 3051), (32, "x", 9000)])
    query = run()
    query.awaitTermination()
    got = spark.read.schema("k string, n bigint").parquet(str(tmp_path / "out") + "/batch=*").collect()
    assert [(r.k, r.n) for r in got] == [("hot", 6)]  # counted over two batches; from 1 again after the gap
    assert totals(query)[-1] <= 2


def test_lag_of_every_batch(spark, tmp_path):
    put(tmp_path / "in", "1.json", [(1, "a", 0), (2, "a", 30)])
    put(tmp_path / "in", "2.json", [(3, "a", 10)])
    source = jobs.with_lag(json_stream(spark, str(tmp_path / "in"), SCHEMA, files_per_batch=1), "ts")
    query = jobs.append_stream(source.filter("id > 1"), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination()
    got = jobs.lag_rows(spark, query).orderBy("batch").collect()
    assert [(r.batch, r.records, r.late) for r in got] == [(0, 2, True), (1, 1, True)] and all(r.lag_seconds > 1e6 for r in got)
    progress = {"batchId": 3, "timestamp": "2024-01-01T10:01:00.000Z", "observedMetrics": {"lag": {"records": 1, "newest": "2024-01-01T10:00:30Z"}}}
    assert jobs.lag_row(progress) == {"batch": 3, "records": 1, "newest": "2024-01-01T10:00:30+00:00", "lag_seconds": 30.0, "late": False}
    assert jobs.lag_row(progress | {"observedMetrics": {}}) is None


def test_landed_files_are_bounded(spark, tmp_path):
    schema = "id bigint, k string, ts string"
    put(tmp_path / "in", "1.json", [(i, "x" * (i % 40), 0) for i in range(500)])
    batch = spark.read.schema(schema).json(str(tmp_path / "in"))
    longest = jobs.row_bytes(batch)
    records = json_stream(spark, str(tmp_path / "in"), schema).withColumn("_corrupt", F.lit(None).cast("string"))
    for query in jobs.land(records, "ts", str(tmp_path / "out"), str(tmp_path / "bad"), str(tmp_path / "state"), None, 5000, longest):
        query.awaitTermination()
    lines = spark.read.text(str(tmp_path / "out")).select("value", F.input_file_name().alias("f"))
    sizes = rows(lines.groupBy("f").agg(F.sum(F.octet_length("value") + 1)).select("sum((octet_length(value) + 1))"))
    assert len(sizes) >= 8 and max(s for s, in sizes) <= 5000 and lines.count() == 500
    assert jobs.row_bytes(batch.limit(0)) == 1


def test_batch_burdens(spark):
    df = spark.range(30).select((F.col("id") % 4).alias("k"))
    assert rows(windows.over_burden(df, "k", 7), "k") == [(0, 8), (1, 8)]
