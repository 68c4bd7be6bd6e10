"""Event-window queries: the batch form of the streaming functions, and streams run to their end."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandlake.functions.numeric import half_up
from strandlake.plans.registry import half_up as HU
from strandlake.plans.registry import query
from strandlake.session import scratch_path
from strandlake.sources.tabular import json_stream
from strandlake.streaming import jobs, state
from strandlake.streaming import windows as w



def stamp(name):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


TUMBLING = f"""w AS (SELECT date_trunc('minute', ts) AS ws, event_type, count(*) AS n, {HU('avg(value)', 6)} AS mean_value FROM events GROUP BY 1, 2)"""


@query("tumbling_counts", "STM-01", f"""
WITH {TUMBLING} SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
  event_type, n, mean_value FROM w""")
def _(t):
    out = w.tumbling(w.event_time(t.events), ["event_type"], F.col("value"))
    return out.select(stamp("window_start"), stamp("window_end"), "event_type", "n", half_up(F.col("mean_value"), 6).alias("mean_value"))


@query("sliding_warn", "STM-02", f"""
WITH s AS (SELECT date_trunc('minute', ts) - to_minutes(k) AS ws, user_id, value FROM events, (VALUES (0), (1)) v(k)),
  a AS (SELECT ws, user_id, avg(value) AS m FROM s GROUP BY 1, 2)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, strftime(ws + INTERVAL 2 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end, user_id,
  {HU('m', 6)} AS mean_value, CASE WHEN m < 15 THEN 'WARN' ELSE 'OK' END AS status FROM a""")
def _(t):
    out = w.sliding_monitor(w.event_time(t.events), "user_id", "value", limit=15)
    return out.select(stamp("window_start"), stamp("window_end"), "user_id", half_up(F.col("mean_value"), 6).alias("mean_value"), "status")


@query("alerts", "STM-03 STR-05", f"""
WITH {TUMBLING} SELECT n, 'error' AS event_type, 'error: ' || n || ' events in window ending ' || strftime(ws + INTERVAL 60 SECOND, '%Y-%m-%d %H:%M:%S') AS message
FROM w WHERE event_type = 'error' AND n > 0""")
def _(t):
    out = w.alerts(w.tumbling(w.event_time(t.events), ["event_type"], F.col("value")), "event_type", "error")
    return out.select("n", "event_type", "message")


@query("hot_key_counts", "AGG-01", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    return t.events.groupBy("event_type").agg(F.count("*").alias("n"))


@query("routed_events", "STM-07 FLT-06", "SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup')")
def _(t):
    return w.urgent(t.events.select("event_id", "event_type"), "event_type", ("error", "signup"))


@query("over_burden", "STM-07", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 60")
def _(t):
    return w.over_burden(t.events, "user_id", 60)


def event_stream(t):
    """The events table as a file stream, from its first file (a new checkpoint replays it all)."""
    return t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.root)


@query("streamed_windows", "STM-01 STM-05 STM-09 SRC-17", """
WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events), w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n FROM w, m WHERE ws + INTERVAL 1 HOUR <= mark""")
def _(t):
    # Append mode emits a window once the watermark has passed its end.
    counts = w.tumbling(w.event_time(event_stream(t)), ["event_type"], F.col("value"), size="1 hour")
    target = scratch_path(t.spark, "windows")
    jobs.append_stream(counts, target, scratch_path(t.spark, "windows-state")).awaitTermination()
    return t.spark.read.schema(counts.schema).parquet(target).select(stamp("window_start"), "event_type", "n")


@query("streamed_alerts", "STM-03 STM-07", """
SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1 HAVING count(*) > 8""")
def _(t):
    errors = w.event_time(event_stream(t)).filter(F.col("event_type") == "error")
    target = scratch_path(t.spark, "alerts")
    found = state.burden_alerts(errors, "user_id", "ts", 8)
    jobs.write_alerts(found, target, scratch_path(t.spark, "alerts-state")).awaitTermination()
    return (t.spark.read.schema("user_id bigint, n bigint").parquet(f"{target}/batch=*")
            .groupBy("user_id").agg(F.max("n").alias("n")))


@query("landed_events", "SNK-05 STM-06 STM-10 JSN-01", """
SELECT strftime(ts, '%Y-%m-%d %H') AS hour_key, count(*) AS n, count(*) FILTER (event_id % 50 = 0) AS refused FROM events GROUP BY 1""")
def _(t):
    # Every fiftieth record is cut off in the middle, as a broken producer would send it.
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    text = F.to_json(F.struct("event_id", ts.alias("ts"), "event_type"))
    cut = F.expr("substring(j, 1, length(j) - 1)")
    lines = event_stream(t).select("event_id", text.alias("j")).select(
        F.when(F.col("event_id") % 50 == 0, cut).otherwise(F.col("j")).alias("value"))
    records = jobs.parsed(lines, "event_id bigint, ts string, event_type string")
    good, bad = scratch_path(t.spark, "landing"), scratch_path(t.spark, "refused")
    for running in jobs.land(records, "ts", good, bad, scratch_path(t.spark, "landing-state"), interval=None):
        running.awaitTermination()
    landed = t.spark.read.schema("event_id bigint, ts string, year string, month string, day string, hour string").json(good)
    refused = t.spark.read.text(bad).select(F.regexp_extract("value", '"ts":"([0-9-]+ [0-9]+)', 1).alias("hour_key"), F.lit(1).alias("bad"))
    key = F.concat_ws("", F.concat_ws("-", "year", "month", "day"), F.lit(" "), "hour")
    both = landed.select(key.alias("hour_key"), F.lit(0).alias("bad")).unionByName(refused)
    return both.groupBy("hour_key").agg(F.count("*").alias("n"), F.sum("bad").alias("refused"))


@query("ordered_stream", "STM-04 STM-05", """
WITH m AS (SELECT epoch_ms(max(ts)) - 600000 AS mark FROM events)
SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events, m WHERE epoch_ms(ts) < mark""")
def _(t):
    rows = w.event_time(event_stream(t)).select("user_id", "ts", "event_id")
    target = scratch_path(t.spark, "ordered")
    ordered = state.in_key_order(rows, "user_id", "ts", "event_id")
    jobs.append_stream(ordered, target, scratch_path(t.spark, "ordered-state")).awaitTermination()
    return t.spark.read.schema(ordered.schema).parquet(target).select("user_id", "event_id", "place")


@query("stream_lag", "STM-08", "SELECT count(*) AS records, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS newest, true AS late FROM events")
def _(t):
    rows = jobs.with_lag(event_stream(t), "ts").select("event_id")
    running = jobs.append_stream(rows, scratch_path(t.spark, "lagging"), scratch_path(t.spark, "lagging-state"))
    running.awaitTermination()
    lag = jobs.lag_rows(t.spark, running)
    return lag.agg(F.sum("records").alias("records"), F.max("newest").cast("timestamp").alias("newest"), F.bool_and("late").alias("late")).select(
        "records", stamp("newest"), "late")


def event_lines(t):
    """The events as JSON lines in a new folder, as a producer leaves them, and their schema."""
    source = scratch_path(t.spark, "event-lines")
    t.events.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "event_type", "value").write.json(source)
    return source, "event_id bigint, ts string, event_type string, value double"


@query("landed_files", "SNK-05 SRC-17", """
SELECT strftime(ts, '%Y-%m-%d %H') AS hour_key, count(*) AS n, true AS bounded FROM events GROUP BY 1""")
def _(t):
    source, schema = event_lines(t)
    limit = 4096
    records = json_stream(t.spark, source, schema).withColumn("_corrupt", F.lit(None).cast("string"))
    longest = jobs.row_bytes(t.spark.read.schema(schema).json(source))
    good = scratch_path(t.spark, "bounded")
    for running in jobs.land(records, "ts", good, scratch_path(t.spark, "bounded-refused"), scratch_path(t.spark, "bounded-state"),
                             interval=None, max_bytes=limit, bytes_of_row=longest):
        running.awaitTermination()
    # the lines as they lie in the files: the file sink's log names the files that count
    lines = t.spark.read.text(good).select("value", "year", "month", "day", "hour", F.input_file_name().alias("file"))
    key = F.format_string("%d-%02d-%02d %02d", *[F.col(c).cast("int") for c in ("year", "month", "day", "hour")])
    files = lines.groupBy(key.alias("hour_key"), "file").agg(F.count("*").alias("n"), F.sum(F.octet_length("value") + 1).alias("bytes"))
    return files.groupBy("hour_key").agg(F.sum("n").alias("n"), F.bool_and(F.col("bytes") <= limit).alias("bounded"))


@query("refreshed_layers", "STM-09 SRC-17", """
SELECT event_type, count(*) AS n, max(strftime(ts, '%Y-%m-%d')) AS newest FROM events WHERE value >= 5 GROUP BY 1""")
def _(t):
    source, schema = event_lines(t)
    silver, gold = scratch_path(t.spark, "silver"), scratch_path(t.spark, "gold")
    kept = "event_id bigint, event_type string, day string"
    jobs.refresh(t.spark, source, schema, lambda df: df.filter("value >= 5").select("event_id", "event_type", F.left("ts", F.lit(10)).alias("day")),
                 silver, scratch_path(t.spark, "silver-state"))
    # the daily step goes on from what the hourly one has added
    jobs.refresh(t.spark, silver, kept, lambda df: df.select("event_type", "day"), gold, scratch_path(t.spark, "gold-state"), fmt="parquet")
    return t.spark.read.schema("event_type string, day string").parquet(gold).groupBy("event_type").agg(
        F.count("*").alias("n"), F.max("day").alias("newest"))


@query("reconciled_windows", "STM-01 STM-09", """
WITH m AS (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events), w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, n AS landed, 0::BIGINT AS streamed, n AS missing FROM w, m WHERE ws + INTERVAL 1 HOUR > mark""")
def _(t):
    counts = w.tumbling(w.event_time(event_stream(t)), ["event_type"], F.col("value"), size="1 hour")
    target = scratch_path(t.spark, "reconciled")
    jobs.append_stream(counts, target, scratch_path(t.spark, "reconciled-state")).awaitTermination()
    batch = w.tumbling(w.event_time(t.events), ["event_type"], F.col("value"), size="1 hour")
    missing = jobs.reconcile(t.spark.read.schema(counts.schema).parquet(target), batch, ["window_start", "event_type"])
    return missing.select(stamp("window_start"), "event_type", "landed", F.col("streamed").cast("bigint").alias("streamed"), "missing")
