"""Named queries over the driver's tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake import bindings as b
from citylake import schemas
from citylake.functions import array_at, duration_minutes, first_of
from citylake.operators.conform import (
    conform_trips,
    dedup,
    explode_rows,
    in_bbox,
    tag,
    trailing_days,
    union_conformed,
)
from citylake.operators.facts import fact_taxi_daily, pivot_parameters, summarize, taxi_daily_by_zone
from citylake.operators.joins import sensor_measurements
from citylake.operators.quality import (
    quality_report,
    quarantine,
    run_suite,
    suite_status,
    weather_rules,
)
from citylake.operators.series import forward_fill_bucketed, forward_fill_by_period
from citylake.plans import insights
from citylake.plans.dimensions import dim_date, dim_gdp, dim_zone, weather_forecast
from citylake.plans.measures import latest_value, measure
from citylake.session import scanned_bytes, session_for, size_for, staging_path
from citylake.sources.calendar import calendar_over
from citylake.sources.files import flatten_days, flatten_sensors, rows_of_meta_array
from citylake.sources.manifest import flagged_slots, manifest_over, pending_of, status_counts
from citylake.sources.sinks import export_top_n, read_evolving
from citylake.streaming import ingest_mixed_stream

Query = Callable[[SparkSession, str], DataFrame]

CATALOG: dict[str, Query] = {}


def named(name: str) -> Callable[[Query], Query]:
    """Register a query; it runs in a session of its own, sized for what it reads."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            own = session_for(spark)
            df = fn(own, sf_dir)
            size_for(own, scanned_bytes(df))  # before the query is planned
            return df

        CATALOG[name] = run
        return run

    return register


def query(fn: Query) -> Query:
    """Register a query under its function's name."""
    return named(fn.__name__)(fn)


def _ntz(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


# Conforming


@query
def silver_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.trips(spark, sf_dir).drop("silver_processing_time")


@query
def trip_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    timed = b.raw_trips(spark, sf_dir).select(
        "VendorID",
        first_of("tpep_pickup_datetime", "lpep_pickup_datetime").alias("pickup_datetime"),
        first_of("tpep_dropoff_datetime", "lpep_dropoff_datetime").alias("dropoff_datetime"),
    )
    return timed.filter(F.col("pickup_datetime") < F.col("dropoff_datetime")).withColumn(
        "trip_duration_minutes", duration_minutes("pickup_datetime", "dropoff_datetime")
    )


@query
def union_missing_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    yellow, green = b.trip_variants(spark, sf_dir)
    return union_conformed(tag(yellow, "taxi_type", "yellow"), tag(green, "taxi_type", "green"))


@query
def zone_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = b.table(spark, sf_dir, "lineitem").select(
        "l_suppkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    return dedup(lines, ["l_suppkey"])


@query
def gdp_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = b.gdp_rows(spark, sf_dir)
    row = F.to_json(F.struct(*rows.columns))
    docs = rows.select(F.concat(F.lit('[{"page":1},['), row, F.lit("]]")).alias("value"))
    return dim_gdp(rows_of_meta_array(docs, "value", schemas.GDP_ROW))


@query
def json_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = b.forecast_documents(spark, sf_dir).select("doc_id", F.to_json(F.struct("list")).alias("doc"))
    docs = text.select("doc_id", F.from_json("doc", schemas.FORECAST)["list"].alias("list"))
    return explode_rows(docs, "list", alias="step", keep_empty=True).select(
        "doc_id",
        F.col("step.dt").alias("dt"),
        F.col("step.main.temp").alias("temperature"),
        array_at("step.weather", 0)["description"].alias("condition"),
    )


@query
def sensor_flatten_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    sensors = flatten_sensors(b.sensor_documents(spark, sf_dir))
    return sensor_measurements(sensors, flatten_days(b.day_documents(spark, sf_dir)))


@query
def bbox_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = trailing_days(b.table(spark, sf_dir, "events"), "ts", 15, "2024-01-31")
    inside = in_bbox(b.readings_of(recent), -74.259, 40.477, -73.700, 40.917)
    return inside


# Series and air quality


@query
def fx_ffill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.fx(spark, sf_dir)


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values of which purchases are unknown."""
    known = F.when(F.col("event_type") != "purchase", F.col("value"))
    return b.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", known.alias("value"))


@query
def fx_ffill_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_fill_bucketed(_gappy_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value")


@query
def fx_ffill_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forward_fill_by_period(_gappy_events(spark, sf_dir), ["user_id"], ["ts", "event_id"], "value", "to_date(ts)")


@query
def aq_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.silver_aq(spark, sf_dir)


@query
def aq_pivot_by_sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = pivot_parameters(b.readings(spark, sf_dir), ["pm25", "no2", "pm10"], ["sensor_id", "unit"])
    return wide


@query
def aq_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.aq_fact(spark, sf_dir)


# Facts and dimensions


@query
def trip_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.taxi_fact(spark, sf_dir)


@query
def trip_daily_no_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = conform_trips(b.raw_trips(spark, sf_dir).drop("tip_amount"), b.RUN_TS)
    return fact_taxi_daily(trips)


@query
def trip_daily_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taxi_daily_by_zone(b.taxi_fact(spark, sf_dir))


def _order_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return b.table(spark, sf_dir, "orders").select("o_orderdate")


@named("dim_date")
def date_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_date(calendar_over(_order_dates(spark, sf_dir), "o_orderdate"))


@named("dim_zone")
def zone_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_zone(b.repeated_zones(spark, sf_dir))


@named("dim_gdp")
def gdp_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_gdp(b.gdp_rows(spark, sf_dir))


@query
def weather_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(b.weather(spark, sf_dir).drop("ingested_at"), "forecast_time")


# Ingest bookkeeping


@query
def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_over(b.slots(spark, sf_dir), "taxi_type", "first_day")


def _wanted_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots that should exist, with what became of each; the slots are one row per type and month."""
    slots = b.slots(spark, sf_dir).withColumn("failed", F.expr("available AND NOT landed AND taxi_type = 'A'"))
    return flagged_slots(manifest_over(slots, "taxi_type", "first_day"), slots)


@named("pending_slots")
def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending_of(_wanted_slots(spark, sf_dir))


@named("load_summary")
def load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return status_counts(_wanted_slots(spark, sf_dir))


@query
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    source, schema = b.table_path(sf_dir, "lineitem"), b.table(spark, sf_dir, "lineitem").schema
    out, checkpoint = staging_path(spark, "bronze"), staging_path(spark, "ingest")
    slot = {
        "taxi_type": F.col("l_returnflag"),
        "year": F.year("l_shipdate"),
        "month": F.month("l_shipdate"),
    }
    for _ in range(2):  # the second run finds nothing new
        ingest_mixed_stream(spark, source, schema, out, checkpoint, slot).awaitTermination()
    return (
        read_evolving(spark, out)
        .groupBy("taxi_type", "year", "month")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))
    )


# Quality


@query
def dq_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(b.trips(spark, sf_dir), b.silver_aq(spark, sf_dir), b.fx(spark, sf_dir))


@query
def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_suite(b.weather(spark, sf_dir), weather_rules())


@query
def dq_suite_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suite_status(run_suite(b.weather(spark, sf_dir), weather_rules()))


@named("quarantine")
def quarantine_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = quarantine(
        b.raw_trips(spark, sf_dir),
        {
            "no passengers": F.col("passenger_count") <= 0,
            "no distance": F.col("trip_distance") <= 0,
            "no tip": F.col("tip_amount") <= 0,
        },
    )
    return checked.select("VendorID", "PULocationID", "fare_amount", F.concat_ws(",", "reasons").alias("reasons"))


# Measures


@query
def avg_fare_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.average_fare(b.model(spark, sf_dir), ["year", "month"])


@query
def avg_fare_by_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.average_fare(b.model(spark, sf_dir), ["borough"])


@query
def avg_fare_by_zone_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.average_fare(b.model(spark, sf_dir), ["zone_name", "year", "month"])


@query
def avg_fare_weekends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir), "avg_fare", ["borough"], where={"is_weekend": 1, "year": [1996, 1997]})


@query
def revenue_eur_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir, with_fx=True), "revenue_eur", ["year", "month"])


@query
def revenue_eur_by_borough(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir, with_fx=True), "revenue_eur", ["borough"])


@query
def revenue_eur_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir, with_fx=True), "revenue_eur", mode="divide")


@query
def revenue_eur_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(
        b.model(spark, sf_dir, with_fx=True), "revenue_eur", ["year", "borough"], where={"day_name": "Monday"}
    )


@query
def avg_fare_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir), "avg_fare", ["year", "month"], totals=True)


@query
def revenue_eur_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return measure(b.model(spark, sf_dir, with_fx=True), "revenue_eur", ["borough", "year"], totals=True)


@query
def latest_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = F.date_trunc("minute", "forecast_time")
    steps = b.weather(spark, sf_dir).withColumns({"day": F.to_date("forecast_time"), "forecast_time": minute})
    latest = latest_value(steps, "forecast_time", ["temperature", "humidity", "condition"], ["day"])
    return _ntz(latest, "latest_time")


@query
def forecast_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ntz(insights.forecast_cards(b.weather(spark, sf_dir)), "latest_time")


@query
def forecast_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = insights.forecast_series(b.weather(spark, sf_dir))
    return _ntz(out, "forecast_time")


@query
def default_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(b.aq_fact(spark, sf_dir), "location_name")


# Insights


@query
def trip_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.trip_volume(b.model(spark, sf_dir))


@query
def busiest_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.busiest_zones(b.model(spark, sf_dir), 10)


@query
def aq_hotspots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.aq_hotspots(b.aq_fact(spark, sf_dir), 10)


@query
def aq_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.aq_trend(b.aq_fact(spark, sf_dir), b.dates(spark))


@query
def overlay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.overlay(b.taxi_fact(spark, sf_dir), b.aq_fact(spark, sf_dir))


@query
def overlay_corr(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = insights.overlay_corr(b.taxi_fact(spark, sf_dir), b.aq_fact(spark, sf_dir))
    # A correlation's last digits depend on the order of its rows.
    return out.withColumn("corr_trips_pm25", F.round("corr_trips_pm25", 9))


@query
def revenue_usd_eur(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.revenue_usd_eur(b.model(spark, sf_dir, with_fx=True))


@query
def mobility_gdp(spark: SparkSession, sf_dir: str) -> DataFrame:
    gdp = dim_gdp(b.gdp_rows(spark, sf_dir))
    return insights.mobility_gdp(b.taxi_fact(spark, sf_dir), gdp)


@query
def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return insights.daily_summary(b.trips(spark, sf_dir), b.aq_fact(spark, sf_dir), max_rate=0.15)


@named("export_top_n")
def export_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["forecast_time", "temperature", "condition", "humidity"]
    return _ntz(export_top_n(b.weather(spark, sf_dir).drop("ingested_at"), 5, order), "forecast_time")


@query
def weather_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast rows by condition, from the documents to the default summary."""
    rows = weather_forecast(b.forecast_documents(spark, sf_dir), b.RUN_TS)
    return summarize(rows, "condition", ["temperature", "feels_like", "humidity", "pressure", "wind_speed"])
