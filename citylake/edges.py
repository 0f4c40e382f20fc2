"""Named queries of the library's edge: files and tables, written from the given tables and read back.

Each query stages its files below the shared folder; what it returns reads them.
"""

from __future__ import annotations

import datetime as dt
import uuid
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylake import bindings as b
from citylake import schemas
from citylake.catalog import CATALOG, query
from citylake.functions import slot_path_text
from citylake.operators.conform import cast_all, conform_trips, rename, with_audit
from citylake.operators.ordering import ordered
from citylake.operators.quality import (
    daily_rules,
    gate_checks,
    quality_report,
    report_of,
    report_text,
    run_suite,
    suite_status,
    weather_rules,
)
from citylake.plans.counted import CountedTable
from citylake.plans.filled import FilledSeries
from citylake.plans.gold import TaxiGold
from citylake.plans.measures import CityModel, measure
from citylake.plans.sensors import SensorHistory
from citylake.plans.versions import VersionedDimension
from citylake.session import path_bytes, sized, staging_path
from citylake.sources import files
from citylake.sources.manifest import SLOT, ingest_manifest, landed_slots, slot_path
from citylake.sources.sinks import (
    append_evolving,
    balanced,
    export_name,
    export_top_n,
    overwrite_enforced,
    overwrite_partitions,
    overwrite_table,
    promote,
    read_evolving,
    write_report,
)
from citylake.sources.store import write_text
from citylake.streaming import failed_slots, ingest_drifting, ingest_drifting_stream, ingest_stream, read_drifting

_BEFORE = set(CATALOG)

FORECAST_COLUMNS = ["forecast_time", "temperature", "condition", "humidity"]


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex}"


@query
def zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "zones")
    headed = rename(b.zones(spark, sf_dir), {"location_id": "LocationID", "borough": "Borough", "zone_name": "Zone"})
    headed.write.option("header", "true").csv(path)
    return files.read_zones(spark, path)


@query
def fx_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates with empty cells on weekends."""
    path = staging_path(spark, "fx")
    b.fx_rows(spark, sf_dir).write.option("header", "true").csv(path)
    return files.read_fx(spark, path)


@query
def forecast_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast documents of many steps, one file per day of the events; a file is one JSON text."""
    steps = b.forecast_documents(spark, sf_dir).select("doc_id", F.explode("list").alias("step"))
    days = steps.withColumn("part", F.expr("doc_id div 1000")).groupBy("part").agg(F.collect_list("step").alias("list"))
    path = staging_path(spark, "forecast")
    days.select("part", F.to_json(F.struct("list")).alias("value")).write.partitionBy("part").text(path)
    read = files.read_forecast(spark, f"{path}/part=*")
    return read.select(F.inline("list")).select(
        "dt", F.col("main.temp").alias("temperature"), F.get("weather", F.lit(0))["description"].alias("condition")
    )


@query
def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast files of which some are cut off, some are an error message, and some give a time as a word."""
    docs = b.forecast_documents(spark, sf_dir).withColumn("part", F.expr("doc_id div 100"))
    days = docs.select("part", F.explode("list").alias("step")).groupBy("part").agg(F.collect_list("step").alias("list"))
    text = F.to_json(F.struct("list"))
    kind = F.col("part") % 4
    value = (
        F.when(kind == 1, F.left(text, F.length(text) - 1))
        .when(kind == 2, F.lit('{"cod":"404"}'))
        .when(kind == 3, F.concat(F.lit('{"cod":"200","list":[{"dt":"noon"},'), F.substr(text, F.lit(10))))
        .otherwise(text)
    )
    path, parsed = staging_path(spark, "forecast"), staging_path(spark, "parsed")
    # Very many files: tasks give them their places, each for its own, and not the driver for all of them.
    landed = days.select("part", value.alias("value")).write.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    landed.partitionBy("part").text(path)
    found = files.checked_forecast(spark, path)
    steps = F.coalesce(F.size("list"), F.lit(0))
    # Each document is parsed once, into rows that both sides of the join read.
    found.withColumns({"file": F.col("source_file"), "steps": steps}).drop("list").write.parquet(parsed)
    checked = spark.read.parquet(parsed)
    loaded = files.loaded_documents(checked).select("file", "steps")
    checked = checked.drop("file", "steps")
    return (
        checked.join(loaded, F.col("source_file") == F.col("file"), "left")
        .groupBy("part", "reason")
        .agg(F.sum("steps").alias("steps"))
    )


@query
def gdp_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDP documents ``[meta, rows]``, one file per indicator."""
    rows = b.gdp_rows(spark, sf_dir)
    path = staging_path(spark, "gdp")
    text = rows.groupBy("date").agg(F.to_json(F.collect_list(F.struct(*rows.columns))).alias("r"))
    text.select("date", F.concat(F.lit('[{"page":1},'), "r", F.lit("]")).alias("value")).write.partitionBy("date").text(path)
    found = files.read_gdp(spark, f"{path}/date=*")
    return found.select("countryiso3code", "date", "value")


@query
def append_new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends, the second with a column more."""
    path = staging_path(spark, "evolving")
    lines = b.table(spark, sf_dir, "lineitem")
    append_evolving(lines.filter(b.YELLOW).select("l_orderkey", "l_quantity"), path)
    append_evolving(lines.filter(f"not ({b.YELLOW})").select("l_orderkey", "l_quantity", "l_tax"), path)
    return read_evolving(spark, path)


@query
def replace_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table replaced with another schema, then promoted and scanned."""
    first, second = _name("replaced"), _name("promoted")
    orders = b.table(spark, sf_dir, "orders")
    overwrite_table(orders.select("o_orderkey"), first)
    overwrite_table(orders.select("o_orderkey", F.col("o_totalprice").alias("price")), first)
    promote(spark, first, second)
    return spark.table(second)


@query
def enforce_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones under an enforced schema; a table of another schema is refused and changes nothing."""
    name = _name("enforced")
    zones = b.zones(spark, sf_dir).withColumn("location_id", F.col("location_id").cast("int"))
    overwrite_enforced(zones, name, schemas.DIM_ZONE)
    try:
        overwrite_enforced(zones.withColumn("extra", F.lit(1)), name, schemas.DIM_ZONE)
        refused = ""
    except schemas.SchemaMismatch as error:
        refused = str(error)
    return spark.table(name).withColumn("refused", F.lit(refused))


@query
def report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{staging_path(spark, 'report')}/quality.json"
    write_report(suite_status(run_suite(b.weather(spark, sf_dir), weather_rules())), path, b.RUN_TS)
    return spark.read.schema("status string, total_checks long, success_percent double, timestamp string").json(path)


@query
def export_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, day = staging_path(spark, "export"), dt.date(2024, 2, 1)
    rows = b.weather(spark, sf_dir).drop("ingested_at")
    export_top_n(rows, 5, FORECAST_COLUMNS, path, day)
    read = spark.read.schema(rows.schema).option("multiLine", "true").json(f"{path}/{export_name(day)}")
    return read.withColumn("forecast_time", F.col("forecast_time").cast("timestamp_ntz"))


def _land_flags(spark: SparkSession, sf_dir: str, columns: list[str]) -> str:
    """One file of order lines per return flag, each in the folder of a slot."""
    root = staging_path(spark, "landing")
    lines = b.table(spark, sf_dir, "lineitem")
    for month, flag in enumerate("ANR", 1):
        found = lines.filter(F.col("l_returnflag") == flag).selectExpr(*columns)
        found.write.parquet(f"{root}/{slot_path(flag, 1998, month)}")
    return root


@query
def landed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_slots(spark, _land_flags(spark, sf_dir, ["l_orderkey"]))


@query
def slot_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one slot each, loaded once by two runs."""
    root = _land_flags(spark, sf_dir, ["l_orderkey", "l_quantity"])
    out, checkpoint = staging_path(spark, "bronze"), staging_path(spark, "ingest")
    schema = schemas.struct(l_orderkey=schemas.LONG, l_quantity=schemas.DOUBLE)
    for _ in range(2):
        ingest_stream(spark, root, schema, out, checkpoint).awaitTermination()
    loaded = spark.read.schema("l_orderkey long, l_quantity double, taxi_type string, year int, month int").parquet(out)
    return loaded.groupBy("taxi_type", "year", "month").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity"))


@query
def drifting_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An unknown column that is INT, then DOUBLE, then text, in three runs; a file in no slot's folder is left out."""
    root, out, checkpoint = staging_path(spark, "landing"), staging_path(spark, "bronze"), staging_path(spark, "ingest")
    lines = b.table(spark, sf_dir, "lineitem")
    kinds = [("A", "l_linenumber"), ("N", "l_quantity"), ("R", "concat('x', l_linestatus)")]
    for month, (flag, surcharge) in enumerate(kinds, 1):
        found = lines.filter(F.col("l_returnflag") == flag)
        rows = found.selectExpr("l_orderkey as VendorID", "l_linenumber as passenger_count", f"{surcharge} as surcharge")
        rows.write.parquet(f"{root}/{slot_path('yellow', 1998, month)}")
        if month == 1:
            rows.write.parquet(f"{root}/elsewhere")
        ingest_drifting_stream(spark, root, schemas.TRIP, out, checkpoint).awaitTermination()
    loaded = read_drifting(spark, out)
    return loaded.groupBy("month", "surcharge").agg(F.count(F.lit(1)).alias("n"), F.sum("passenger_count").alias("passengers"))


@query
def republished_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month published again with fewer rows, one with a file more, one with a file that is no Parquet file."""
    root, out, checkpoint = staging_path(spark, "landing"), staging_path(spark, "bronze"), staging_path(spark, "ingest")
    lines = b.table(spark, sf_dir, "lineitem")

    def publish(flag: str, month: int, condition: str, mode: str) -> None:
        rows = lines.filter(F.col("l_returnflag") == flag).filter(condition)
        rows = rows.selectExpr("l_orderkey as VendorID", "l_linenumber as passenger_count")
        rows.write.mode(mode).parquet(f"{root}/{slot_path('yellow', 1998, month)}")

    for month, flag in enumerate("ANR", 1):
        publish(flag, month, "true", "error")
    ingest_drifting(spark, root, schemas.TRIP, out, checkpoint)
    publish("A", 1, "l_quantity > 25", "overwrite")
    publish("N", 2, "l_quantity < 5", "append")
    write_text(spark, f"{root}/{slot_path('yellow', 1998, 3)}/cut.parquet", "no rows")
    ingest_drifting(spark, root, schemas.TRIP, out, checkpoint)
    loaded = read_drifting(spark, out).groupBy("month").agg(F.count(F.lit(1)).alias("n"), F.sum("passenger_count").alias("passengers"))
    failed = failed_slots(spark, out).select("month", F.lit(True).alias("failed"))
    return loaded.join(failed, "month", "left").select("month", "n", "passengers", F.coalesce("failed", F.lit(False)).alias("failed"))


def _with_slot(trips: DataFrame) -> DataFrame:
    """Conformed trips with the slot they would be loaded from: type, and year and month of the pickup."""
    begun = F.col("pickup_datetime")
    return trips.withColumns({"year": F.date_format(begun, "yyyy"), "month": F.date_format(begun, "MM")})


def _dealt_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed trips with their slot, whose rows lie together by slot.

    What is dealt are the order lines of valid trips. The columns that are computed from them are made where they arrive:
    they would take up more than all that they come from.
    """
    lines = b.trip_lines(spark, sf_dir).withColumn("pickup_month", F.trunc("o_orderdate", "month"))
    return _with_slot(conform_trips(b.raw_trips_of(balanced(lines, ["l_linestatus", "pickup_month"])), b.RUN_TS))


# Order lines are joined with all their columns: sorted in memory they take many times the bytes of their files.
JOINED_ROWS = 12


def _joining(spark: SparkSession, sf_dir: str) -> AbstractContextManager[None]:
    """For a run that joins the order lines: as many shuffle partitions as they need to be sorted without a spill."""
    return sized(spark, JOINED_ROWS * path_bytes(spark, b.table_path(sf_dir, "lineitem"), b.table_path(sf_dir, "orders")))


def _landed_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conformed trips with their slot, conformed once: several writes read parts of them."""
    rows = _with_slot(b.trips(spark, sf_dir))
    path = staging_path(spark, "trips")
    with _joining(spark, sf_dir):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _fresh_gold(spark: SparkSession) -> TaxiGold:
    note = f"{staging_path(spark, 'gold')}/note.json"
    return TaxiGold(spark, note, _name("silver"), _name("states"), _name("fact"), _name("by_zone"))


@query
def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips without a year, then with half of that year's, then with all: each run merges the months it changes."""
    gold, trips = _fresh_gold(spark), _landed_trips(spark, sf_dir)
    late, half = F.col("year") == "1996", F.col("trip_distance") < 25
    overwrite_table(trips.filter(~late), gold.silver, SLOT)
    gold.refresh()
    for part in (late & half, late):
        overwrite_partitions(trips.filter(part), gold.silver, SLOT)
        gold.refresh()
    return spark.table(gold.fact)


@query
def counted_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips written without a year, then with half of it, then a month again: the report sums the counts of the writes."""
    table, trips = _name("silver"), _landed_trips(spark, sf_dir)
    counted = CountedTable(spark, f"{staging_path(spark, 'counts')}/note.json", table, daily_rules()["trips"], SLOT)
    late, first = F.col("year") == "1996", F.col("month") == "01"
    with counted.writing() as counts:
        overwrite_table(trips.filter(~late), table, SLOT, counts)
    for part in (late & (F.col("trip_distance") < 25), late & first):
        with counted.writing() as counts:
            overwrite_partitions(trips.filter(part), table, SLOT, counts)
    return report_of(spark, counted.counts())


@query
def avg_fare_of_a_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From a written fact that is partitioned by month: the filter on the days' years prunes its files."""
    gold, dates = _fresh_gold(spark), _name("dates")
    with _joining(spark, sf_dir):
        overwrite_table(_dealt_trips(spark, sf_dir), gold.silver, SLOT, together=True)
    gold.refresh()
    overwrite_table(b.dates(spark), dates)
    model = CityModel(taxi=spark.table(gold.by_zone), dates=spark.table(dates), zones=b.zones(spark, sf_dir))
    return measure(model, "avg_fare", ["year", "month"], where={"year": 1996})


@query
def incremental_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event values without those of ten days, then with all: late days, and later ones that begin with another value, are filled."""
    known = F.when(F.col("event_type") != "purchase", F.col("value"))
    day = F.date_format("ts", "yyyy-MM-dd")
    events = b.table(spark, sf_dir, "events").select("user_id", "ts", "event_id", known.alias("value"), day.alias("period"))
    raw, note = _name("raw"), f"{staging_path(spark, 'filled')}/note.json"
    series = FilledSeries(spark, note, raw, _name("filled"), _name("closings"), ["user_id"], ["ts", "event_id"], "value")
    late = F.dayofmonth("ts").between(10, 19)
    overwrite_table(events.filter(~late), raw, ["period"])
    series.refresh()
    overwrite_partitions(events.filter(late), raw, ["period"])
    series.refresh()
    return spark.table(series.filled).drop("period")


@query
def zone_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of three lookups: all zones, some renamed and some gone, the same again."""
    zones = b.zones(spark, sf_dir).withColumn("location_id", F.col("location_id").cast("int"))
    renamed = F.when(F.col("location_id") % 5 == 0, F.concat("zone_name", F.lit(" (new)"))).otherwise(F.col("zone_name"))
    later = zones.filter("location_id % 7 <> 0").withColumn("zone_name", renamed)
    dimension = VersionedDimension(spark, staging_path(spark, "zones"), ["location_id"], schemas.DIM_ZONE)
    for lookup in (zones, later, later):
        dimension.load(lookup)
    return dimension.history()


@query
def sensor_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily values added in two loads, the second one twice, joined bucket by bucket to their sensors."""
    history = SensorHistory(spark, staging_path(spark, "sensors"), buckets=8, parts=4)
    history.put_places(files.flatten_sensors(b.sensor_documents(spark, sf_dir)))
    days = files.flatten_days(b.day_documents(spark, sf_dir))
    early = F.substring("date_utc", 9, 2) < "16"
    for load, rows in (("early", days.filter(early)), ("late", days.filter(~early)), ("late", days.filter(~early))):
        history.add_days(rows, load)
    return history.measurements()


@query
def manifest_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slots wanted up to a month inside a year, with the order lines of each."""
    wanted = ingest_manifest(spark, ["A", "N", "R"], [1996, 1997], dt.date(1997, 5, 20))
    shipped = b.table(spark, sf_dir, "lineitem").select(
        F.col("l_returnflag").alias("taxi_type"), F.date_format("l_shipdate", "yyyy").alias("year"), F.date_format("l_shipdate", "MM").alias("month")
    )
    counted = shipped.groupBy("taxi_type", "year", "month").agg(F.count(F.lit(1)).alias("n"))
    return wanted.join(counted, ["taxi_type", "year", "month"], "left")


@query
def slot_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = b.slots(spark, sf_dir)
    return slots.select(slot_path_text("taxi_type", "year", "month").alias("path"), "landed")


@query
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = b.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    stamped = with_audit(orders, b.RUN_TS, "orders.parquet", taxi_type="yellow")
    typed = cast_all(stamped, {"o_custkey": "string"})
    return typed.withColumn("ingestion_timestamp", F.col("ingestion_timestamp").cast("timestamp_ntz"))


@query
def months_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month names in calendar order, with the place each has in the sorted rows."""
    dates = b.table(spark, sf_dir, "orders").groupBy(
        F.date_format("o_orderdate", "MMMM").alias("month_name"), F.month("o_orderdate").alias("month")
    ).count()
    placed = ordered(dates, "month").withColumn("at", F.monotonically_increasing_id())
    return placed.select("month_name", F.row_number().over(Window.orderBy("at")).alias("rank"))


@query
def gate_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gate_checks(quality_report(b.trips(spark, sf_dir), b.silver_aq(spark, sf_dir), b.fx(spark, sf_dir)))


@query
def report_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report_text(quality_report(b.trips(spark, sf_dir), b.silver_aq(spark, sf_dir), b.fx(spark, sf_dir)))


@query
def configured_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones of the boroughs that the configuration names."""
    wanted = files.rows_df(spark, [("ASIA", 1), ("EUROPE", 2)], "borough string, priority int")
    return b.zones(spark, sf_dir).join(wanted, "borough").select("location_id", "borough", "zone_name", "priority")


@query
def latest_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = CityModel(taxi=b.taxi_fact(spark, sf_dir), dates=b.dates(spark), zones=b.zones(spark, sf_dir), weather=b.weather(spark, sf_dir))
    parts = [measure(model, f"latest_{c}") for c in ("temperature", "humidity", "condition")]
    return parts[0].select(
        "latest_temperature", parts[1].scalar().alias("latest_humidity"), parts[2].scalar().alias("latest_condition")
    )


# The queries of this module.
NAMES = [name for name in CATALOG if name not in _BEFORE]
