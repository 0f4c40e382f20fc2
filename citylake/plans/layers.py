"""The daily run: landed files to raw tables, conformed tables, the quality gate, and the star.

Layers hand over through tables, so each can be run again on its own. Only this module and the sinks act.
"""

from __future__ import annotations

import datetime as dt
import json
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake import schemas
from citylake.operators.conform import conform_trips, with_audit
from citylake.operators.facts import fact_aq_daily, silver_air_quality
from citylake.operators.joins import sensor_measurements
from citylake.operators.quality import daily_rules, gate, report_of, run_suite, suite_status, weather_rules
from citylake.operators.series import forward_fill_by_period
from citylake.plans.counted import CountedTable
from citylake.plans.dimensions import dim_date, dim_fx, dim_gdp, dim_zone, weather_forecast
from citylake.plans.gold import TaxiGold
from citylake.plans.versions import VersionedDimension
from citylake.session import path_bytes, sized
from citylake.sources import files
from citylake.sources.calendar import calendar
from citylake.sources.manifest import SLOT
from citylake.sources.sinks import (
    export_top_n,
    overwrite_enforced,
    overwrite_partitions,
    overwrite_table,
    promote,
    write_report,
)
from citylake.sources.store import WideningTable, exists, read_text, write_text
from citylake.streaming import ingest_drifting


# Fixed value: tables of checked documents begin with it.
DOCUMENTS = "bronze_documents_"


@dataclass(frozen=True)
class Landing:
    """Where landed files lie, and where the run keeps its raw trips, checkpoint and reports."""

    trips: str
    zones: str
    sensor_locations: str
    sensor_days: str
    gdp: str
    fx: str
    forecast: str
    bronze_trips: str
    checkpoint: str
    reports: str


def run_bronze(spark: SparkSession, at: Landing, run_ts: dt.datetime | None = None) -> None:
    """Load what has landed: trips incrementally and anew where published again, the small sources in full."""
    ingest_drifting(spark, at.trips, schemas.TRIP, at.bronze_trips, at.checkpoint)
    overwrite_table(files.read_zones(spark, at.zones), "bronze_taxi_zone")
    places = land_documents(files.checked_sensor_locations(spark, at.sensor_locations), "sensor_locations")
    days = land_documents(files.checked_sensor_days(spark, at.sensor_days), "sensor_days")
    readings = sensor_measurements(
        files.flatten_sensors(files.loaded_documents(places)), files.flatten_days(files.loaded_documents(days))
    )
    overwrite_table(with_audit(readings, run_ts, "sensor days"), "bronze_openaq")
    gdp = files.gdp_of(land_documents(files.checked_gdp(spark, at.gdp), "gdp"))
    overwrite_table(with_audit(gdp, run_ts, "GDP", column="source_api"), "bronze_gdp")
    overwrite_table(files.read_fx(spark, at.fx), "bronze_fx")


def land_documents(docs: DataFrame, source: str) -> DataFrame:
    """Write checked documents as a table of their own, so that rows and rejects come from one parse."""
    overwrite_table(docs, f"{DOCUMENTS}{source}")
    return docs.sparkSession.table(f"{DOCUMENTS}{source}")


def document_rejects(spark: SparkSession) -> DataFrame:
    """Files of all document sources that something is wrong with: ``source, source_file, reason, loaded``."""
    found = [t.name for t in spark.catalog.listTables(pattern=f"{DOCUMENTS}*") if not t.isTemporary]
    none = spark.createDataFrame([], "source string, source_file string, reason string, loaded boolean")
    parts = [
        files.rejected_documents(spark.table(name)).select(F.lit(name.removeprefix(DOCUMENTS)).alias("source"), "*")
        for name in sorted(found)
    ]
    return reduce(DataFrame.unionByName, parts, none)


def counted_tables(spark: SparkSession, at: Landing) -> dict[str, CountedTable]:
    """The conformed tables that the gate looks at, with the notes on their counts."""
    tables = {"trips": ("silver_nyc_taxi", SLOT), "air": ("silver_openaq", []), "fx": ("silver_fx", [])}
    return {
        name: CountedTable(spark, f"{at.bronze_trips}/_counts_{name}.json", tables[name][0], rules, tables[name][1])
        for name, rules in daily_rules().items()
    }


def conform_new_trips(spark: SparkSession, at: Landing, run_ts: dt.datetime | None = None) -> None:
    """Conform the trips of the slots that new loads have rows for; all other slots of the table stay as they are.

    The table is partitioned by slot. It is built anew where it is missing or its columns have changed. What has been
    conformed is noted after the table is written, so a run that breaks off is made up for by the next.
    """
    name, note = "silver_nyc_taxi", f"{at.bronze_trips}/_conformed.json"
    bronze = WideningTable(spark, at.bronze_trips, SLOT)
    loads = bronze.loads()
    trips = conform_trips(bronze.read(), run_ts, keep=SLOT)
    same = spark.catalog.tableExists(name) and set(spark.table(name).columns) == set(trips.columns)
    done = set(json.loads(read_text(spark, note))) if same and exists(spark, note) else set()
    counted = counted_tables(spark, at)["trips"]
    if not done:
        with counted.writing() as counts:
            overwrite_table(trips, name, SLOT, counts)
    elif new := [load for load in loads if load not in done]:
        changed = bronze.read(with_load=True).filter(F.col("load").isin(new)).select(*SLOT).distinct()
        with counted.writing() as counts:
            overwrite_partitions(trips.join(changed, SLOT, "left_semi"), name, SLOT, counts)
    write_text(spark, note, json.dumps(loads))


def run_silver(spark: SparkSession, at: Landing, run_ts: dt.datetime | None = None) -> None:
    """Conform the raw tables."""
    conform_new_trips(spark, at, run_ts)
    zones = VersionedDimension(spark, f"{at.bronze_trips}/_zones", ["location_id"], schemas.DIM_ZONE)
    zones.load(dim_zone(spark.table("bronze_taxi_zone")))
    note, version = f"{at.bronze_trips}/_zones_of_table.txt", str(zones.version())
    if not spark.catalog.tableExists("silver_dim_zone") or not exists(spark, note) or read_text(spark, note) != version:
        overwrite_enforced(zones.current(), "silver_dim_zone", schemas.DIM_ZONE)
        write_text(spark, note, version)
    overwrite_enforced(dim_gdp(spark.table("bronze_gdp")), "silver_gdp", schemas.DIM_GDP)
    fx = dim_fx(spark.table("bronze_fx"), fill=partial(forward_fill_by_period, period="trunc(fx_date, 'MM')"))
    counted = counted_tables(spark, at)
    with counted["fx"].writing() as counts:
        overwrite_enforced(fx, "silver_fx", schemas.DIM_FX, counts)
    with counted["air"].writing() as counts:
        overwrite_enforced(silver_air_quality(spark.table("bronze_openaq")), "silver_openaq", schemas.SILVER_AQ, counts)


def check_silver(spark: SparkSession, at: Landing, max_rate: float = 0.01) -> DataFrame:
    """Quality report of the conformed tables, from the counts of their writes; raises when the run must stop.

    The report is written before it is judged, and stays for looking into a halt.
    """
    found = {rule: n for table in counted_tables(spark, at).values() for rule, n in table.counts().items()}
    overwrite_table(report_of(spark, found), "quality_report")
    gate(spark.table("quality_report"), max_rate)
    return spark.table("quality_report")


def run_gold(spark: SparkSession, at: Landing, start: dt.date, end: dt.date) -> None:
    """Build the star from the conformed tables. Of the taxi facts only the months of changed slots are written."""
    for src, dst in [
        ("silver_dim_zone", "gold_dim_zone"),
        ("silver_gdp", "gold_dim_gdp"),
        ("silver_fx", "gold_dim_fx"),
    ]:
        promote(spark, src, dst)
    TaxiGold(spark, f"{at.bronze_trips}/_gold.json").refresh()
    overwrite_enforced(fact_aq_daily(spark.table("silver_openaq"), unique=True), "gold_fact_aq_daily", schemas.FACT_AQ)
    overwrite_enforced(dim_date(calendar(spark, start, end)), "gold_dim_date", schemas.DIM_DATE)


def run_weather(spark: SparkSession, at: Landing, run_ts: dt.datetime | None = None) -> DataFrame:
    """The forecast branch: table, expectations, report, and a small export. Gives the suite's status."""
    table = "gold_weather_forecast"
    docs = land_documents(files.checked_forecast(spark, at.forecast), "forecast")
    overwrite_enforced(weather_forecast(files.loaded_documents(docs), run_ts), table, schemas.WEATHER)
    overwrite_table(run_suite(spark.table(table), weather_rules()), "weather_quality")
    status = suite_status(spark.table("weather_quality"))
    write_report(status, f"{at.reports}/weather_quality_report.json", run_ts)
    day = (run_ts or dt.datetime.now()).date()
    export_top_n(spark.table(table), 5, ["forecast_time", "temperature", "condition"], at.reports, day)
    return status


def run_daily(
    spark: SparkSession,
    at: Landing,
    start: dt.date = dt.date(2020, 1, 1),
    end: dt.date = dt.date(2025, 11, 30),
    run_ts: dt.datetime | None = None,
    max_rate: float = 0.01,
) -> DataFrame:
    """All layers in order. A failed gate raises before the star is touched. Gives the quality report."""
    with sized(spark, path_bytes(spark, at.trips)):
        run_bronze(spark, at, run_ts)
        run_silver(spark, at, run_ts)
        report = check_silver(spark, at, max_rate)
        run_gold(spark, at, start, end)
    return report
