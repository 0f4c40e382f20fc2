"""Dimension and forecast tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions import as_date, cast_to, first_element, is_weekend, nan_to_null
from citylake.operators.conform import dedup, explode_rows, flatten
from citylake.operators.series import forward_fill


def dim_date(days: DataFrame) -> DataFrame:
    """Attributes of each ``date_key``."""
    return days.selectExpr(
        "date_key",
        "year(date_key) as year",
        "month(date_key) as month",
        "date_format(date_key, 'MMMM') as month_name",
        "date_format(date_key, 'EEEE') as day_name",
    ).withColumn("is_weekend", is_weekend("date_key"))


def dim_zone(zones: DataFrame) -> DataFrame:
    """One row per zone; of several the first by name is kept."""
    return dedup(zones.select("location_id", "borough", "zone_name", "service_zone"), ["location_id"])


def dim_gdp(rows: DataFrame) -> DataFrame:
    """GDP rows with their structs flattened and the year as a number."""
    return flatten(
        rows,
        {
            "country_name": "country.value",
            "countryiso3code": "countryiso3code",
            "indicator_name": "indicator.value",
            "gdp_year": cast_to("date", "int"),
            "gdp_value": "value",
            "obs_status": "obs_status",
        },
    )


def fx_base(rows: DataFrame) -> DataFrame:
    """Dated exchange rates; rows whose date cannot be read are left out, missing rates stay."""
    return rows.select(
        as_date("TIME_PERIOD").alias("fx_date"),
        "CURRENCY",
        nan_to_null("OBS_VALUE").alias("exchange_rate_to_eur"),
    ).filter(F.col("fx_date").isNotNull())


def dim_fx(rows: DataFrame, fill: Callable[..., DataFrame] = forward_fill) -> DataFrame:
    """Exchange rates with gaps filled from the last known rate.

    The default fill suits one row per currency and day. Pass ``forward_fill_by_period`` with a period for longer feeds,
    and ``forward_fill_bucketed`` for one that may repeat days without bound.
    """
    base = fx_base(rows)
    # The rate is part of the order: it makes repeated days of a currency come in a fixed order.
    keyed = base.withColumn("_tie", F.col("exchange_rate_to_eur"))
    filled = fill(keyed, ["CURRENCY"], ["fx_date", "_tie"], "exchange_rate_to_eur")
    return filled.drop("_tie")


def forecast_steps(docs: DataFrame) -> DataFrame:
    """One row per forecast step of each document."""
    return explode_rows(docs.select("list"), "list", alias="step")


def weather_forecast(docs: DataFrame, run_ts: dt.datetime | None = None) -> DataFrame:
    """Forecast table. The step's time is a timestamp, and its first weather entry the condition."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return flatten(
        forecast_steps(docs),
        {
            "forecast_time": F.timestamp_seconds("step.dt"),
            "temperature": "step.main.temp",
            "feels_like": "step.main.feels_like",
            "humidity": "step.main.humidity",
            "pressure": "step.main.pressure",
            "condition": first_element("step.weather")["description"],
            "wind_speed": "step.wind.speed",
            "ingested_at": stamp,
        },
    )
