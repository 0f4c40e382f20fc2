"""The questions the dashboards answer, as queries over facts and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions import rate
from citylake.operators import joins
from citylake.operators.exact import exact_aggregate
from citylake.operators.facts import summarize
from citylake.operators.ordering import ordered, top_k
from citylake.operators.quality import bad_trip
from citylake.plans.measures import CityModel, latest_value


def trip_volume(model: CityModel, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Trips and revenue by calendar attributes."""
    return model.taxi_totals(by).select(*by, "total_trips", "daily_revenue_usd")


def busiest_zones(model: CityModel, k: int) -> DataFrame:
    """The ``k`` zones with most trips. Names are looked up for those ``k`` rows only."""
    zones = top_k(model.taxi_totals(["pickup_zone_id"]), k, "total_trips", "pickup_zone_id")
    named = joins.with_dim(zones, model.zones, "pickup_zone_id", "location_id", ["borough", "zone_name"])
    return named.orderBy(F.desc("total_trips"), "pickup_zone_id").select(
        "pickup_zone_id", "zone_name", "borough", "total_trips"
    )


def average_fare(model: CityModel, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Revenue per trip by date and zone attributes."""
    return model.avg_fare(by)


def aq_hotspots(aq: DataFrame, k: int) -> DataFrame:
    """The ``k`` places with the highest mean PM2.5."""
    places = exact_aggregate(aq, ["location_name"], averages={"avg_pm25": "avg_pm25"}, also={"days": "count(avg_pm25)"})
    return top_k(places.select("location_name", "avg_pm25", "days"), k, "avg_pm25", "location_name")


def aq_trend(aq: DataFrame, dates: DataFrame, by: Sequence[str] = ("year", "month", "location_name")) -> DataFrame:
    """Mean pollutants by calendar attributes and place."""
    attrs = [n for n in by if n in dates.columns]
    rows = joins.with_dim(aq, dates, "reading_date", "date_key", attrs)
    return exact_aggregate(rows, list(by), averages={c: c for c in ("avg_pm25", "avg_no2", "avg_o3")})


def overlay(taxi: DataFrame, aq: DataFrame) -> DataFrame:
    """Traffic and pollution side by side, day by day."""
    return joins.overlay_daily(taxi, aq)


def overlay_corr(taxi: DataFrame, aq: DataFrame) -> DataFrame:
    """How daily traffic and pollution move together."""
    return joins.overlay_corr(joins.overlay_daily(taxi, aq))


def revenue_usd_eur(model: CityModel, by: Sequence[str] = ("year", "month")) -> DataFrame:
    """Revenue in dollars, the measure in euro, and the economic conversion."""
    both = model.revenue_and_rate(by)
    return both.select(
        *by,
        "revenue_usd",
        "average_rate",
        (F.col("revenue_usd") * F.col("average_rate")).alias("revenue_eur"),
        rate("revenue_usd", "average_rate").alias("revenue_eur_divided"),
    )


def mobility_gdp(taxi: DataFrame, gdp: DataFrame) -> DataFrame:
    """Trips beside GDP and GDP growth, by year and country."""
    return joins.mobility_vs_gdp(taxi, gdp)


def daily_summary(trips: DataFrame, aq: DataFrame, max_rate: float = 0.01) -> DataFrame:
    """What a daily status message says: trips, quality of the trips, mean PM2.5."""
    day = trips.groupBy(F.to_date("pickup_datetime").alias("day")).agg(
        F.count(F.lit(1)).alias("total_trips"), F.count_if(bad_trip()).alias("bad_trips")
    )
    share = rate("bad_trips", "total_trips")
    day = day.withColumns(
        {
            "failure_rate": share,
            "quality": F.when(share > max_rate, F.lit("Failure")).otherwise(F.lit("Success")),
        }
    )
    air = exact_aggregate(aq, [F.col("reading_date").alias("day")], averages={"avg_pm25": "avg_pm25"})
    return day.join(air, "day", "left")


def forecast_series(weather: DataFrame) -> DataFrame:
    """Temperatures and pressure by forecast time, in time order."""
    return ordered(summarize(weather, "forecast_time", ["temperature", "feels_like", "pressure"]), "forecast_time")


def forecast_cards(weather: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Temperature, humidity and condition of the latest forecast step."""
    return latest_value(weather, "forecast_time", ["temperature", "humidity", "condition"], by)
