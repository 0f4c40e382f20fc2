"""Joins of facts, dimensions and sources. All are equi-joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.operators.exact import exact_aggregate


def with_dim(
    fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, attrs: Sequence[str], by_month: Sequence[str] = ()
) -> DataFrame:
    """Dimension attributes on fact rows; a fact without its dimension row keeps NULL attributes.

    ``by_month`` names the fact's column of the key's month (``yyyy-MM``), if it is partitioned by one: the join then goes by the
    month too, and a filter on the dimension reaches the fact's partitions.

    No broadcast is forced: a dimension may grow with the data, and Spark knows its size at run time.
    A dominating fact key in a shuffled join is split by adaptive execution.
    """
    months = [F.date_format(dim_key, "yyyy-MM").alias(f"_dim_{c}") for c in by_month]
    right = dim.select(F.col(dim_key).alias("_dim_key"), *months, *attrs)
    same = [F.col(fact_key) == F.col("_dim_key"), *[F.col(c) == F.col(f"_dim_{c}") for c in by_month]]
    return fact.join(right, reduce(Column.__and__, same), "left").drop("_dim_key", *[f"_dim_{c}" for c in by_month])


def sensor_measurements(sensors: DataFrame, days: DataFrame) -> DataFrame:
    """Daily values with the place and parameter of their sensor; sensors without values give no row."""
    return sensors.join(days, sensors["id"] == days["sensor_id"], "inner").select(
        days["sensor_id"], "location_name", "parameter", "lat", "lon", "value", "unit", "date_utc"
    )


def overlay_daily(taxi: DataFrame, aq: DataFrame) -> DataFrame:
    """Trips and mean PM2.5 per day. Each fact is reduced to days before the two meet."""
    trips = exact_aggregate(
        taxi, [F.col("pickup_date").alias("day")], {"revenue_usd": "daily_revenue_usd"}, also={"total_trips": "sum(total_trips)"}
    )
    air = exact_aggregate(aq, [F.col("reading_date").alias("day")], averages={"avg_pm25": "avg_pm25"})
    return trips.join(air, "day", "full")


def overlay_corr(overlay: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Correlation of daily trips and PM2.5 over the days that have both."""
    both = overlay.filter(F.col("total_trips").isNotNull() & F.col("avg_pm25").isNotNull())
    return both.groupBy(*by).agg(
        F.count(F.lit(1)).alias("days"), F.corr("total_trips", "avg_pm25").alias("corr_trips_pm25")
    )


def mobility_vs_gdp(taxi: DataFrame, gdp: DataFrame) -> DataFrame:
    """Trips per year beside the GDP of that year and its growth over the year before, by country."""
    trips = taxi.groupBy(F.year("pickup_date").alias("year")).agg(
        F.sum("total_trips").alias("total_trips")
    )
    yearly = exact_aggregate(gdp, ["country_name", "gdp_year"], {"gdp_value": "gdp_value"})
    # A country has one row per year by now, so its window is short whatever the input was.
    before = F.lag("gdp_value").over(Window.partitionBy("country_name").orderBy("gdp_year"))
    growth = F.try_divide(F.col("gdp_value") - before, before)
    yearly = yearly.withColumn("gdp_growth", growth)
    return trips.join(yearly, F.col("year") == F.col("gdp_year"), "left").select(
        "year", "country_name", "total_trips", "gdp_value", "gdp_growth"
    )
