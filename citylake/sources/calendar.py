"""Day-by-day calendars."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _days(start: Column, end: Column) -> Column:
    return F.explode(F.sequence(start, end, F.expr("interval 1 day"))).alias("date_key")


def _as_day(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def calendar(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    one = spark.range(0, 1, 1, 1)
    return one.select(_days(F.lit(_as_day(start)), F.lit(_as_day(end))))


def calendar_over(df: DataFrame, column: str) -> DataFrame:
    """Every day from the first to the last date of a column; no row when it has none."""
    day = F.col(column).cast("date")
    span = df.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    return span.select(_days(F.col("first"), F.col("last")))
