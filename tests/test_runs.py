"""Incremental ingest and the layered run, on landed files."""

import datetime as dt
import json
import shutil

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from citylake import schemas
from citylake.operators.quality import QualityGateError
from citylake.plans.layers import Landing, conform_new_trips, document_rejects, run_bronze, run_daily, run_weather
from citylake.session import build_session, staging_path
from citylake.sources import store
from citylake.sources.manifest import load_summary, slot_path
from citylake.sources.sinks import read_evolving
from citylake.sources.store import WideningTable
from citylake.streaming import (
    failed_slots,
    ingest_drifting,
    ingest_drifting_stream,
    ingest_mixed_stream,
    ingest_stream,
    read_drifting,
    rejected_files,
)
from tests.conftest import values

RUN = dt.datetime(2024, 4, 1, tzinfo=dt.timezone.utc)


def land_trips(spark, root, taxi, month, passengers, start_day=1):
    prefix = "tpep" if taxi == "yellow" else "lpep"
    rows = [
        (1, dt.datetime(2024, month, start_day + i, 8), dt.datetime(2024, month, start_day + i, 9), p, 2.0, 1, 2, 10.0, 12.5)
        for i, p in enumerate(passengers)
    ]
    df = spark.createDataFrame(
        rows,
        f"VendorID bigint, {prefix}_pickup_datetime timestamp_ntz, {prefix}_dropoff_datetime timestamp_ntz, "
        "passenger_count double, trip_distance double, PULocationID int, DOLocationID int, fare_amount double, total_amount double",
    )
    df.coalesce(1).write.mode("append").parquet(f"{root}/{slot_path(taxi, 2024, month)}")


def test_each_landed_file_is_loaded_once(spark, tmp_path):
    landing, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    land_trips(spark, landing, "green", 1, [1.0, 2.0])

    def run():
        ingest_stream(spark, landing, schemas.TRIP, out, checkpoint).awaitTermination()
        return read_evolving(spark, out)

    assert run().count() == 2
    assert run().count() == 2
    land_trips(spark, landing, "yellow", 2, [1.0, 1.0, 1.0])
    loaded = run()
    assert loaded.groupBy("taxi_type").count().orderBy("taxi_type").collect() == [("green", 2), ("yellow", 3)]
    assert loaded.filter(F.col("source_file").contains("yellow/2024/02")).count() == 3
    # The partition columns come back typed by their values.
    assert values(loaded.select("taxi_type", "year", "month").distinct()) == [("green", 2024, 1), ("yellow", 2024, 2)]


def test_mixed_files_are_split_by_slot_once(spark, tmp_path):
    landing, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    slot = {"kind": F.when(F.col("id") % 3 == 0, "hot").otherwise("cold")}
    schema = schemas.struct(id=schemas.LONG)
    for start in (0, 100):
        spark.range(start, start + 100).write.mode("append").parquet(landing)
        for _ in range(2):
            ingest_mixed_stream(spark, landing, schema, out, checkpoint, slot).awaitTermination()
    loaded = read_evolving(spark, out)
    assert loaded.count() == 200 and loaded.select("id").distinct().count() == 200
    assert values(loaded.select("kind").distinct()) == [("cold",), ("hot",)]


def test_drifting_files_bring_new_columns_and_types_once(spark, tmp_path):
    landing, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")

    def land(month, schema, row):
        df = spark.createDataFrame([row], schema).coalesce(1)
        df.write.parquet(f"{landing}/{slot_path('yellow', 2024, month)}")

    def run():
        ingest_drifting_stream(spark, landing, schemas.TRIP, out, checkpoint, 2).awaitTermination()
        return read_drifting(spark, out)

    land(1, "VendorID bigint, passenger_count bigint", (1, 2))
    land(2, "VendorID int, passenger_count double, airport_fee double", (2, 1.5, 0.5))
    land(3, "VendorID bigint, passenger_count bigint", (3, 4))
    expected = [(1, 2.0, None, "01"), (2, 1.5, 0.5, "02"), (3, 4.0, None, "03")]
    columns = ["VendorID", "passenger_count", "airport_fee", "month"]
    assert values(run(), *columns) == expected
    assert values(run(), *columns) == expected
    land(4, "VendorID bigint, congestion_fee double", (4, 9.0))
    after = run()
    assert values(after.filter("congestion_fee IS NOT NULL"), "VendorID", "congestion_fee") == [(4, 9.0)]
    assert after.count() == 4


KINDS = [("int", 7), ("double", 0.5), ("string", "x")]


@pytest.mark.parametrize("runs", [3, 1])
def test_an_unknown_column_of_three_types_keeps_all_rows(spark, tmp_path, runs):
    landing, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    for month, (kind, value) in enumerate(KINDS, 1):
        df = spark.createDataFrame([(month, value)], f"VendorID bigint, extra {kind}").coalesce(1)
        df.write.parquet(f"{landing}/{slot_path('green', 2024, month)}")
        if runs == 3 or month == 3:
            ingest_drifting_stream(spark, landing, schemas.TRIP, out, checkpoint).awaitTermination()
    assert values(read_drifting(spark, out), "VendorID", "extra") == [(1, "7"), (2, "0.5"), (3, "x")]


def test_a_new_checkpoint_on_a_loaded_table_is_refused(spark, tmp_path):
    landing, out = str(tmp_path / "in"), str(tmp_path / "out")
    land_trips(spark, landing, "green", 1, [1.0])
    ingest_drifting_stream(spark, landing, schemas.TRIP, out, str(tmp_path / "one")).awaitTermination()
    with pytest.raises(ValueError, match="has been loaded before"):
        ingest_drifting_stream(spark, landing, schemas.TRIP, out, str(tmp_path / "two"))
    assert read_drifting(spark, out).count() == 1


def test_a_file_in_no_slot_is_reported(spark, tmp_path):
    landing, out, checkpoint = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp")
    land_trips(spark, landing, "green", 1, [1.0])
    spark.range(3).coalesce(1).write.parquet(f"{landing}/stray")
    ingest_drifting_stream(spark, landing, schemas.TRIP, out, checkpoint).awaitTermination()
    assert read_drifting(spark, out).count() == 1
    rejected = [r["path"] for r in rejected_files(spark, out).collect()]
    assert len(rejected) == 1 and "/stray/" in rejected[0]
    with pytest.raises(Exception, match="no slot in path"):
        ingest_stream(spark, landing, schemas.TRIP, str(tmp_path / "o2"), str(tmp_path / "c2")).awaitTermination()


def small(spark, folder, taxi, month, numbers, name="data.parquet"):
    """One file of a slot under a name of its own, replacing what lies there."""
    target = folder / slot_path(taxi, 2024, month) / name
    target.parent.mkdir(parents=True, exist_ok=True)
    pq.write_table(pa.table({"VendorID": pa.array(numbers, pa.int64())}), target)
    return target


def stored(spark, out):
    return values(read_drifting(spark, out), "taxi_type", "month", "VendorID")


def test_a_slot_published_again_is_replaced_once(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        return ingest_drifting(spark, str(landing), schemas.TRIP, out, checkpoint, files_per_batch=2)

    small(spark, landing, "green", 1, [1, 2])
    small(spark, landing, "green", 2, [3])
    small(spark, landing, "yellow", 2, [4])
    assert run() == []
    small(spark, landing, "green", 1, [7, 8, 9])  # the same path
    small(spark, landing, "yellow", 2, [5], "more.parquet")  # a file more is no replacement
    assert run() == [("green", "2024", "01")]
    expected = [("green", "01", n) for n in (7, 8, 9)] + [("green", "02", 3), ("yellow", "02", 4), ("yellow", "02", 5)]
    assert stored(spark, out) == expected
    assert run() == [] and stored(spark, out) == expected
    # The slot under other names, with another type of column.
    (landing / slot_path("green", 2024, 2) / "data.parquet").unlink()
    spark.createDataFrame([(6, "x")], "VendorID bigint, note string").coalesce(1).write.mode("append").parquet(
        f"{landing}/{slot_path('green', 2024, 2)}"
    )
    assert run() == [("green", "2024", "02")]
    assert stored(spark, out) == [*expected[:3], ("green", "02", 6), *expected[4:]]
    assert run() == []
    # A slot that was cleared away keeps its rows.
    (landing / slot_path("green", 2024, 1) / "data.parquet").unlink()
    assert run() == [] and len(stored(spark, out)) == 6


def test_a_replacement_that_breaks_off_shows_old_rows_or_new_ones(spark, tmp_path, monkeypatch):
    table = WideningTable(spark, str(tmp_path / "t"), ["kind"])
    frame = lambda *rows: spark.createDataFrame(rows, "id int, kind string")
    table.load(frame((1, "a b"), (2, "c")), "one")
    monkeypatch.setattr(store, "rename", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.replace(frame((3, "a b")), "two", [("a b",)])
    assert values(table.read(), "id") == [(1,), (2,)]
    monkeypatch.undo()
    monkeypatch.setattr(WideningTable, "_settle", lambda self: None)  # the old folder is not removed
    table.replace(frame((3, "a b")), "two", [("a b",)])
    assert values(table.read(), "id") == [(2,), (3,)]
    monkeypatch.undo()
    table.load(frame((4, "c")), "three")
    assert values(table.read(), "id") == [(2,), (3,), (4,)]
    assert not (tmp_path / "t" / "_replaced.json").exists()
    table.replace(frame((5, "c")), "four", [("c",), ("none",)])
    assert values(table.read(), "id", "kind") == [(3, "a b"), (5, "c")]


def test_a_broken_file_is_listed_and_the_others_load(spark, tmp_path):
    landing, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run():
        return ingest_drifting(spark, str(landing), schemas.TRIP, out, checkpoint)

    small(spark, landing, "green", 1, [1])
    cut = small(spark, landing, "green", 2, [2])
    cut.write_bytes(cut.read_bytes()[:-30])
    only = small(spark, landing, "yellow", 1, [3])
    only.write_bytes(b"PAR1 and nothing more")
    assert run() == []
    assert stored(spark, out) == [("green", "01", 1)]
    assert [(r["path"].split("/")[-4:-1], r["reason"]) for r in rejected_files(spark, out).orderBy("path").collect()] == [
        (["green", "2024", "02"], "no Parquet file"),
        (["yellow", "2024", "01"], "no Parquet file"),
    ]
    wanted = spark.createDataFrame([("green", "2024", m) for m in ("01", "02", "03")], "taxi_type string, year string, month string")
    available = wanted.filter("month <> '03'")
    summary = load_summary(wanted, wanted.limit(0), available, failed_slots(spark, out))
    assert values(summary) == [("failed", 1), ("loaded", 1), ("missing", 1)]
    assert run() == []  # broken files are not tried again as long as they are the same
    small(spark, landing, "green", 2, [2, 20])
    only.write_bytes(b"PAR1 and still nothing more")
    good = small(spark, landing, "green", 1, [5])
    good.write_bytes(good.read_bytes()[:-30])  # a broken replacement leaves the rows as they are
    assert run() == [("green", "2024", "02")]
    assert stored(spark, out) == [("green", "01", 1), ("green", "02", 2), ("green", "02", 20)]
    assert values(failed_slots(spark, out), "taxi_type", "month") == [("green", "01"), ("yellow", "01")]


def write_json(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(content))


@pytest.fixture
def landing(spark, tmp_path):
    land_trips(spark, str(tmp_path / "trips"), "yellow", 1, [1.0] * 20)
    land_trips(spark, str(tmp_path / "trips"), "green", 2, [1.0] * 20)
    (tmp_path / "zones.csv").write_text("LocationID,Borough,Zone,service_zone\n1,Queens,Astoria,Boro\n2,Bronx,Mott,Boro\n2,Bronx,Twice,Boro\n")
    place = {"name": "x", "coordinates": {"latitude": 40.5, "longitude": -74.0}, "sensors": [{"id": 7, "parameter": {"name": "pm25", "units": "u"}}]}
    write_json(tmp_path / "locations" / "a.json", {"results": [place]})
    day = {"value": 3.5, "period": {"datetimeFrom": {"utc": "2024-01-04T00:00:00Z"}, "datetimeTo": {"utc": "2024-01-05T00:00:00Z"}}}
    write_json(tmp_path / "days" / "sensor_id=7" / "d.json", {"results": [day]})
    gdp = {"country": {"id": "US", "value": "United States"}, "indicator": {"id": "G", "value": "GDP"}, "countryiso3code": "USA", "date": "2024", "value": 5.0, "obs_status": None}
    write_json(tmp_path / "gdp" / "g.json", [{"page": 1}, [gdp]])
    (tmp_path / "fx.csv").write_text("TIME_PERIOD,CURRENCY,OBS_VALUE\n2024-01-01,USD,1.1\n2024-01-02,USD,\n")
    step = {"dt": 1704067200, "main": {"temp": 1.5, "feels_like": 1.0, "humidity": 5, "pressure": 9}, "weather": [{"description": "rain"}], "wind": {"speed": 2.0}}
    write_json(tmp_path / "forecast" / "f.json", {"list": [step, {**step, "dt": 1704078000}]})
    return Landing(
        trips=str(tmp_path / "trips"),
        zones=str(tmp_path / "zones.csv"),
        sensor_locations=str(tmp_path / "locations"),
        sensor_days=str(tmp_path / "days"),
        gdp=str(tmp_path / "gdp"),
        fx=str(tmp_path / "fx.csv"),
        forecast=str(tmp_path / "forecast"),
        bronze_trips=str(tmp_path / "bronze"),
        checkpoint=str(tmp_path / "checkpoint"),
        reports=str(tmp_path / "reports"),
    )


def test_daily_run_builds_the_star_and_repeats_without_change(spark, landing):
    def run():
        report = run_daily(spark, landing, dt.date(2024, 1, 1), dt.date(2024, 12, 31), RUN)
        return {
            "report": values(report, "rule", "total", "failed"),
            **{
                t: values(spark.table(t))
                for t in (
                    "gold_fact_nyc_taxi_daily",
                    "gold_fact_taxi_daily",
                    "gold_fact_aq_daily",
                    "gold_dim_zone",
                    "gold_dim_gdp",
                    "gold_dim_fx",
                )
            },
        }

    first = run()
    assert first["report"] == [("bad_trips", 40, 0), ("fx_nulls", 2, 0), ("impossible_pm25", 1, 0)]
    assert len(first["gold_fact_nyc_taxi_daily"]) == 40
    assert first["gold_dim_fx"] == [(dt.date(2024, 1, 1), "USD", 1.1), (dt.date(2024, 1, 2), "USD", 1.1)]
    assert first["gold_dim_zone"] == [(1, "Queens", "Astoria", "Boro"), (2, "Bronx", "Mott", "Boro")]
    assert first["gold_fact_aq_daily"][0][:5] == (dt.date(2024, 1, 5), "x", 40.5, -74.0, 3.5)
    assert spark.table("gold_dim_date").count() == 366
    assert run() == first

    # Bad trips arrive: the run stops and the star stays as it was.
    land_trips(spark, landing.trips, "green", 3, [0.0] * 20)
    with pytest.raises(QualityGateError):
        run()
    assert values(spark.table("gold_fact_taxi_daily")) == first["gold_fact_taxi_daily"]
    assert ("bad_trips", 60, 20) in values(spark.table("quality_report"), "rule", "total", "failed")


def test_documents_that_are_none_are_listed(spark, landing, tmp_path):
    (tmp_path / "days" / "sensor_id=7" / "cut.json").write_text('{"results": [{"value": 3.5')
    write_json(tmp_path / "gdp" / "message.json", [{"message": "no such indicator"}])
    write_json(tmp_path / "locations" / "gone.json", {"error": "gone"})
    (tmp_path / "forecast" / "word.json").write_text('{"list": [{"dt": "noon"}, {"dt": 1704067300}]}')
    run_bronze(spark, landing, RUN)
    run_weather(spark, landing, RUN)
    assert spark.table("bronze_openaq").count() == 1 and spark.table("bronze_gdp").count() == 1
    found = document_rejects(spark).withColumn("file", F.element_at(F.split("source_file", "/"), -1))
    assert values(found, "source", "file", "reason", "loaded") == [
        ("forecast", "word.json", "a value of another type", True),
        ("gdp", "message.json", "no rows", False),
        ("sensor_days", "cut.json", "not JSON", False),
        ("sensor_locations", "gone.json", "no results", False),
    ]
    assert spark.table("gold_weather_forecast").filter("forecast_time IS NOT NULL").count() == 3


def test_a_month_published_again_goes_through_to_the_facts(spark, landing, tmp_path):
    def run():
        run_daily(spark, landing, dt.date(2024, 1, 1), dt.date(2024, 12, 31), RUN)
        return spark.table("gold_fact_nyc_taxi_daily").agg(F.sum("total_trips")).first()[0]

    assert run() == 40
    shutil.rmtree(tmp_path / "trips" / "green" / "2024" / "02")
    land_trips(spark, landing.trips, "green", 2, [1.0] * 5)
    assert run() == 25 and run() == 25


def test_weather_branch(spark, landing, tmp_path):
    status = run_weather(spark, landing, RUN)
    assert values(status) == [("Success", 3, 100.0)]
    assert spark.table("gold_weather_forecast").count() == 2
    assert (tmp_path / "reports" / "weather_quality_report.json").exists()
    assert (tmp_path / "reports" / "Weather_Report_2024-04-01.json").exists()


def test_staging_lies_below_the_configured_folder(spark):
    assert spark.conf.get("spark.checkpoint.dir") in staging_path(spark, "x")
    assert build_session("again").conf.get("spark.sql.session.timeZone") == "UTC"


def test_a_new_month_rewrites_that_month_only(spark, landing):
    def files_of(month):
        rows = spark.table("silver_nyc_taxi").filter(F.col("month") == month)
        return sorted({r[0] for r in rows.select(F.col("_metadata.file_path")).collect()})

    spark.sql("drop table if exists silver_nyc_taxi")
    run_bronze(spark, landing, RUN)
    conform_new_trips(spark, landing, RUN)
    first = files_of("01"), files_of("02")
    land_trips(spark, landing.trips, "green", 2, [2.0] * 3)
    land_trips(spark, landing.trips, "green", 3, [1.0] * 4)
    run_bronze(spark, landing, RUN)
    conform_new_trips(spark, landing, RUN)
    assert files_of("01") == first[0] and files_of("02") != first[1] and files_of("03")
    partly = values(spark.table("silver_nyc_taxi"))
    spark.sql("drop table silver_nyc_taxi")
    conform_new_trips(spark, landing, RUN)
    assert values(spark.table("silver_nyc_taxi").select(*[c for c in spark.table("silver_nyc_taxi").columns])) == partly
    assert len(partly) == 47


OPEN = "spark.sql.maxConcurrentOutputFileWriters"


def test_slot_loads_hold_no_task_s_rows_for_a_sort(spark, tmp_path):
    """The stream's session keeps a file open for each slot that a task meets; the caller's is as before."""
    landing, out, before = str(tmp_path / "landing"), str(tmp_path / "out"), spark.conf.get(OPEN)
    for month in range(1, 13):
        spark.range(3).selectExpr("id as VendorID").coalesce(1).write.parquet(f"{landing}/{slot_path('yellow', 2024, month)}")
    query = ingest_stream(spark, landing, schemas.TRIP, out, str(tmp_path / "c"))
    query.awaitTermination()
    assert query._jsq.sparkSession().conf().get(OPEN) == "64"
    assert spark.read.parquet(out).groupBy("month").count().filter("count = 3").count() == 12 and spark.conf.get(OPEN) == before


@pytest.mark.parametrize("replace", [False, True])
def test_widening_loads_keep_files_open_beyond_the_bound_too(spark, tmp_path, monkeypatch, replace):
    seen, parquet, before = [], DataFrameWriter.parquet, spark.conf.get(OPEN)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(spark.conf.get(OPEN)), parquet(self, *a, **b))[1])
    rows = spark.range(0, 600, 1, 1).selectExpr("id", "cast(id % 100 as string) as slot")  # one task, 100 slots
    table = WideningTable(spark, str(tmp_path / "t"), ["slot"])
    table.replace(rows, "a", [("1",)]) if replace else table.load(rows, "a")
    assert table.read().groupBy("slot").count().filter("count = 6").count() == 100
    assert seen == ["64"] and spark.conf.get(OPEN) == before
