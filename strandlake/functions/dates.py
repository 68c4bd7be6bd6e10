"""Date functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def month_index(col: Column) -> Column:
    return F.year(col) * 12 + F.month(col)


def months_between_boundaries(start: Column, end: Column) -> Column:
    """DAT-02: count of month boundaries crossed, not elapsed months."""
    return month_index(end) - month_index(start)


def days_between(start: Column, end: Column) -> Column:
    """DAT-04."""
    return F.datediff(end, start)


def safe_date(col: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """DAT-03: text to date; NULL when it does not parse."""
    return F.try_to_date(col, fmt)


def date_key(col: Column) -> Column:
    return (F.year(col) * 10000 + F.month(col) * 100 + F.dayofmonth(col)).cast("int")


def with_date_parts(df: DataFrame, col: str = "full_date") -> DataFrame:
    """DAT-01: calendar attributes; weekday counts from Sunday = 0, weeks are ISO weeks."""
    d = F.col(col)
    weekday = F.dayofweek(d) - 1
    return df.withColumns({
        "date_key": date_key(d),
        "year": F.year(d), "quarter": F.quarter(d), "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"), "week": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d), "day_of_week": weekday,
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekday.isin(0, 6),
    })


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """SRC-15: one row per day from ``start`` to ``end`` inclusive."""
    days = F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))
    return spark.range(1).select(F.explode(days).alias("full_date"))


def calendar_of(df: DataFrame, col: str) -> DataFrame:
    """SRC-15: the days between the first and the last value of a column."""
    span = df.agg(F.min(col).cast("date").alias("a"), F.max(col).cast("date").alias("b"))
    return span.select(F.explode(F.sequence("a", "b")).alias("full_date"))
