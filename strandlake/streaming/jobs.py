"""Streaming jobs: landing, refresh, alerts, lag. Every query has its own checkpoint."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import StringType, StructType

# Landing interval, lag limit, partition columns of the landing zone.
LANDING_INTERVAL = "60 seconds"
LANDING_BYTES = 5 * 1024 * 1024
LAG_LIMIT_SECONDS = 60.0
LANDING_PARTITIONS = ("year", "month", "day", "hour")


def parsed(lines: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """JSN-01: JSON text as typed columns; the text of a record that does not parse is kept in ``_corrupt``."""
    full = StructType.fromDDL(schema).add("_corrupt", StringType())
    record = F.from_json(column, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return lines.select(record.alias("r")).select("r.*")


def good_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("_corrupt").isNull()).drop("_corrupt")


def bad_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("_corrupt").isNotNull()).select(F.col("_corrupt").alias("value"))


def with_landing_keys(df: DataFrame, column: str) -> DataFrame:
    at = F.col(column).try_cast("timestamp")
    return df.withColumns({"year": F.date_format(at, "yyyy"), "month": F.date_format(at, "MM"),
                           "day": F.date_format(at, "dd"), "hour": F.date_format(at, "HH")})


def _triggered(writer, interval: str | None):
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def row_bytes(records: DataFrame) -> int:
    """Bytes of the longest record as a JSON line, from a batch of earlier or landed records; 1 if there is none."""
    line = F.to_json(F.struct(*[c for c in records.columns if c != "_corrupt"]))
    return records.agg(F.max(F.octet_length(line) + 1)).first()[0] or 1


def land(records: DataFrame, column: str, path: str, errors: str, checkpoint: str,
         interval: str | None = LANDING_INTERVAL, max_bytes: int = LANDING_BYTES, bytes_of_row: int = 1024) -> list[StreamingQuery]:
    """SNK-05, STM-06: GZIP JSON by hour; records that do not parse, or whose time does not, as text under the error path.

    A file ends after as many records as fit into ``max_bytes`` of JSON lines when a record has ``bytes_of_row`` at most
    (``row_bytes`` observes it on a batch), or at the end of the interval's batch.
    The file sink commits each batch once, so a restarted query neither loses nor repeats records.
    ``interval=None`` processes what is there and stops.
    """
    timed = F.col(column).try_cast("timestamp").isNotNull()
    good = with_landing_keys(good_records(records).filter(timed), column)
    fields = [c for c in records.columns if c != "_corrupt"]
    untimed = good_records(records).filter(~timed).select(F.to_json(F.struct(*fields)).alias("value"))
    landed = _triggered(good.writeStream.format("json").partitionBy(*LANDING_PARTITIONS).option("compression", "gzip")
                        .option("maxRecordsPerFile", max(1, max_bytes // bytes_of_row))
                        .option("checkpointLocation", f"{checkpoint}/landing"), interval).start(path)
    refused = _triggered(bad_records(records).unionByName(untimed).writeStream.format("text").option("compression", "gzip")
                         .option("checkpointLocation", f"{checkpoint}/errors"), interval).start(errors)
    return [landed, refused]


def append_stream(df: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """STM-09: append a stream's results to a Parquet table."""
    writer = df.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start(path)


def write_alerts(df: DataFrame, path: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """STM-03: alerts table; each micro-batch rewrites its own folder, so a retried batch adds nothing twice."""
    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = df.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
    return _triggered(writer, interval).start()


def refresh(spark, source: str, schema: str, step, target: str, checkpoint: str, fmt: str = "json") -> None:
    """STM-09: one scheduled run (hourly silver, daily gold): new files only, then stop.

    ``step`` is a DataFrame function, the same one a batch job would use.
    """
    rows = spark.readStream.schema(schema).format(fmt).load(source)
    append_stream(step(rows), target, checkpoint).awaitTermination()


def reconcile(streamed: DataFrame, batch: DataFrame, keys: list[str], count: str = "n") -> DataFrame:
    """Windows whose streamed count differs from the batch count over landed data: late rows dropped."""
    a = streamed.select(*keys, F.col(count).alias("streamed"))
    b = batch.select(*keys, F.col(count).alias("landed"))
    joined = b.join(a, keys, "left").withColumn("streamed", F.coalesce("streamed", F.lit(0)))
    return joined.filter(F.col("streamed") != F.col("landed")).withColumn("missing", F.col("landed") - F.col("streamed"))


def lag_seconds(newest_event: str, now: datetime | None = None) -> float:
    """STM-08: seconds between now and the newest event time of a progress report."""
    at = datetime.fromisoformat(newest_event.replace("Z", "+00:00"))
    return ((now or datetime.now(timezone.utc)) - at).total_seconds()


def with_lag(df: DataFrame, column: str, name: str = "lag") -> DataFrame:
    """STM-08: the stream with its rows and newest event time observed in every batch; put it behind the source."""
    return df.observe(name, F.count("*").alias("records"), F.max(column).alias("newest"))


def _moment(text: str) -> datetime:
    """A time of a progress report; without zone it is UTC, the zone of the session."""
    at = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return at if at.tzinfo else at.replace(tzinfo=timezone.utc)


def lag_row(progress: dict, name: str = "lag", limit: float = LAG_LIMIT_SECONDS) -> dict | None:
    """One row for a batch's progress report: batch, records, newest event, seconds behind at its end, above the limit.

    None for a batch without records.
    """
    seen = progress.get("observedMetrics", {}).get(name)
    if not seen or not seen["records"]:
        return None
    newest = seen["newest"].replace("Z", "+00:00")
    lag = (_moment(progress["timestamp"]) - _moment(newest)).total_seconds()
    return {"batch": int(progress["batchId"]), "records": int(seen["records"]), "newest": newest, "lag_seconds": lag, "late": lag > limit}


LAG_COLUMNS = "batch bigint, records bigint, newest string, lag_seconds double, late boolean"


def lag_rows(spark, query: StreamingQuery, name: str = "lag", limit: float = LAG_LIMIT_SECONDS) -> DataFrame:
    """STM-08: the lag of each recent batch of a query as a table; one small row a batch."""
    found = [lag_row(json.loads(p.json), name, limit) for p in query.recentProgress]
    return spark.createDataFrame([tuple(r.values()) for r in found if r], LAG_COLUMNS)


class LagMonitor(StreamingQueryListener):
    """STM-08: keeps the latest lag per query and whether it is above the limit."""

    def __init__(self, limit: float = LAG_LIMIT_SECONDS):
        self.limit = limit
        self.latest: dict[str, tuple[float, bool]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        newest = dict(event.progress.eventTime).get("max")
        if newest:
            lag = lag_seconds(newest)
            self.latest[str(event.progress.id)] = (lag, lag > self.limit)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
