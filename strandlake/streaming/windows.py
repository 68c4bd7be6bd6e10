"""Event-time windows. The same functions run on ``read`` and ``readStream`` DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Window sizes, watermark, limits of the monitors.
WINDOW, WATERMARK = "60 seconds", "10 minutes"
MONITOR_WINDOW, MONITOR_SLIDE, MONITOR_LIMIT = "2 minutes", "1 minute", 0.85
URGENT_GENES = ("BRCA1", "BRCA2")
BURDEN_LIMIT = 10


def event_time(df: DataFrame, column: str = "ts", delay: str = WATERMARK) -> DataFrame:
    """Event time as a timestamp with a watermark; a batch DataFrame ignores the watermark.

    A time that does not parse is NULL, which is in no window; ``jobs.land`` keeps such records on its refused side.
    """
    return df.withColumn(column, F.col(column).try_cast("timestamp")).withWatermark(column, delay)


def tumbling(df: DataFrame, keys: list[str], value: Column, column: str = "ts", size: str = WINDOW) -> DataFrame:
    """STM-01: count and mean per window and keys, with both ends of the window."""
    return (df.groupBy(F.window(column, size), *keys)
            .agg(F.count("*").alias("n"), F.avg(value).alias("mean_value"))
            .select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n", "mean_value"))


def sliding_monitor(df: DataFrame, key: str, value: str, column: str = "ts", size: str = MONITOR_WINDOW,
                    slide: str = MONITOR_SLIDE, limit: float = MONITOR_LIMIT) -> DataFrame:
    """STM-02: mean per key in sliding windows, WARN below the limit."""
    out = df.groupBy(F.window(column, size, slide), key).agg(F.avg(value).alias("mean_value"))
    status = F.when(F.col("mean_value") < limit, "WARN").otherwise("OK")
    return out.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key,
                      "mean_value", status.alias("status"))


def alerts(windowed: DataFrame, column: str, wanted: str = "Pathogenic") -> DataFrame:
    """STM-03: windows of the wanted class with at least one event, with a message."""
    text = F.format_string("%s: %d events in window ending %s", column, "n",
                           F.date_format("window_end", "yyyy-MM-dd HH:mm:ss"))
    return windowed.filter((F.col(column) == wanted) & (F.col("n") > 0)).withColumn("message", text)


def urgent(df: DataFrame, gene: str = "gene", genes: tuple[str, ...] = URGENT_GENES) -> DataFrame:
    """STM-07: events of the urgent genes."""
    return df.filter(F.col(gene).isin(*genes))


def over_burden(df: DataFrame, key: str, limit: int = BURDEN_LIMIT) -> DataFrame:
    """STM-07: keys of a batch whose event count is above the limit; on a stream ``state.burden_alerts`` forgets idle keys."""
    return df.groupBy(key).agg(F.count("*").alias("n")).filter(F.col("n") > limit)
