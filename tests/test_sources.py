import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from citylake import schemas
from citylake.operators.facts import silver_air_quality
from citylake.operators.joins import sensor_measurements
from citylake.plans.dimensions import dim_gdp, dim_zone
from citylake.schemas import SchemaMismatch, enforce_schema
from citylake.session import (
    TARGET_PARTITION_BYTES,
    path_bytes,
    scanned_bytes,
    session_for,
    shuffle_partitions_for,
    size_for,
    staging_path,
)
from citylake.sources import files
from citylake.sources.calendar import calendar, calendar_over
from citylake.sources.manifest import (
    ingest_manifest,
    landed_slots,
    load_summary,
    manifest_over,
    pending_slots,
    slot_path,
)
from citylake.sources.sinks import (
    _versions_folder,
    append_evolving,
    balanced,
    export_top_n,
    overwrite_enforced,
    overwrite_table,
    promote,
    read_evolving,
    write_report,
)
from citylake.sources.store import names
from tests.conftest import plan_of, values


def land(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / name
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(folder)


def test_zone_csv(spark, tmp_path):
    path = land(tmp_path / "zones", "z.csv", "LocationID,Borough,Zone,service_zone\n1,EWR,Newark,EWR\n1,EWR,Again,\n2,,Astoria,Boro\n")
    zones = files.read_zones(spark, path)
    assert zones.columns == ["location_id", "borough", "zone_name", "service_zone"]
    assert values(dim_zone(zones)) == [(1, "EWR", "Again", None), (2, None, "Astoria", "Boro")]


def test_fx_csv_reads_columns_by_name_and_blank_rates_as_null(spark, tmp_path):
    path = land(tmp_path / "fx", "fx.csv", "KEY,CURRENCY,TIME_PERIOD,OBS_VALUE\nk,USD,2024-01-01,1.1\nk,USD,2024-01-02,\nk,USD,2024-01-03,NaN\n")
    assert values(files.read_fx(spark, path)) == [
        ("2024-01-01", "USD", 1.1),
        ("2024-01-02", "USD", None),
        ("2024-01-03", "USD", None),
    ]


def test_forecast_json_with_unknown_fields(spark, tmp_path):
    doc = {"cod": "200", "list": [{"dt": 5, "main": {"temp": 1, "extra": 2}, "weather": []}]}
    row = files.read_forecast(spark, land(tmp_path / "w", "f.json", json.dumps(doc, indent=2))).first()
    assert row["list"][0]["dt"] == 5 and row["list"][0]["main"]["temp"] == 1.0


def test_sensor_documents_to_readings(spark, tmp_path):
    place = {
        "name": "x",
        "coordinates": {"latitude": 40.5, "longitude": -74.0},
        "sensors": [{"id": 7, "parameter": {"name": "pm25", "units": "u"}}, {"id": 8, "parameter": {"name": "co", "units": "u"}}],
    }
    places = land(tmp_path / "locations", "a.json", {"results": [place, {**place, "name": "none", "sensors": []}]})
    land(tmp_path / "locations", "b.json", {"meta": 1})
    day = {"value": 3.5, "period": {"datetimeFrom": {"utc": "2024-01-01T00:00:00Z"}, "datetimeTo": {"utc": "2024-01-02T00:00:00Z"}}}
    land(tmp_path / "days" / "sensor_id=7", "d.json", {"results": [day, day]})
    land(tmp_path / "days" / "sensor_id=8", "d.json", {"error": "gone"})
    sensors = files.flatten_sensors(files.read_sensor_locations(spark, places))
    assert values(sensors, "id", "parameter", "location_name") == [(7, "pm25", "x"), (8, "co", "x")]
    days = files.read_sensor_days(spark, str(tmp_path / "days"))
    readings = sensor_measurements(sensors, files.flatten_days(days))
    assert values(readings, "sensor_id", "value", "date_utc") == [(7, 3.5, "2024-01-02T00:00:00Z")] * 2
    assert values(silver_air_quality(readings), "reading_date", "pm25") == [(dt.date(2024, 1, 2), 3.5)]
    assert files.flatten_days(days, "datetimeFrom").first()["date_utc"] == "2024-01-01T00:00:00Z"


def test_gdp_document_takes_the_rows_and_not_the_meta(spark, tmp_path):
    row = {"country": {"id": "US", "value": "United States"}, "indicator": {"id": "G", "value": "GDP"}, "countryiso3code": "USA", "date": "2020", "value": 5, "obs_status": ""}
    path = land(tmp_path / "gdp", "g.json", [{"page": 1}, [row, {**row, "date": "20x", "value": None}]])
    land(tmp_path / "gdp", "empty.json", [{"page": 2}, []])
    out = dim_gdp(files.read_gdp(spark, path))
    assert out.columns == schemas.DIM_GDP.names
    assert values(out, "country_name", "gdp_year", "gdp_value") == [("United States", 2020, 5.0), ("United States", None, None)]


def test_rows_df_accepts_no_rows(spark):
    assert files.rows_df(spark, [], schemas.DIM_FX).columns == schemas.DIM_FX.names
    assert files.rows_df(spark, [(dt.date(2024, 1, 1), "USD", 1.0)], schemas.DIM_FX).count() == 1


def trip_file(spark, path, schema, row):
    spark.createDataFrame([row], schema).write.parquet(path)


def test_trip_slots_with_different_types_are_united(spark, tmp_path):
    a, b = str(tmp_path / "yellow/2024/01"), str(tmp_path / "yellow/2024/02")
    trip_file(spark, a, "VendorID bigint, passenger_count bigint, airport_fee double", (1, 2, 0.5))
    trip_file(spark, b, "VendorID int, passenger_count double, new_fee double", (2, 1.5, 9.0))
    out = files.read_trip_slots(spark, [a, b])
    assert values(out, "VendorID", "passenger_count", "airport_fee", "new_fee") == [(1, 2.0, 0.5, None), (2, 1.5, None, 9.0)]


def test_read_trips_prunes_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "trips")
    trip_file(spark, path, "VendorID bigint, trip_distance double, total_amount double", (1, 2.0, 3.0))
    df = files.read_trips(spark, path)
    assert df.first()["ehail_fee"] is None
    plan = plan_of(df.filter("trip_distance > 0").select("VendorID"))
    assert "GreaterThan(trip_distance,0.0)" in plan and "ReadSchema: struct<VendorID:bigint,trip_distance:double>" in plan


def test_calendars(spark):
    assert calendar(spark, "2024-02-28", "2024-03-01").count() == 3
    df = spark.createDataFrame([(dt.date(2024, 1, 3),), (dt.date(2024, 1, 1),), (None,)], "d date")
    assert values(calendar_over(df, "d")) == [(dt.date(2024, 1, n),) for n in (1, 2, 3)]
    assert calendar_over(df.limit(0), "d").count() == 0


SLOT = "taxi_type string, year string, month string"


def test_manifest_stops_at_the_current_month_of_the_current_year(spark):
    full = ingest_manifest(spark, ["yellow", "green"], range(2020, 2026), dt.date(2025, 12, 31))
    assert full.count() == 144
    early = ingest_manifest(spark, ["green"], [2024, 2025], dt.date(2025, 3, 15))
    assert early.count() == 15
    assert ("green", "2025", "03") in values(early) and ("green", "2025", "04") not in values(early)


def test_manifest_over_spans_all_types(spark):
    df = spark.createDataFrame([("a", dt.date(2023, 12, 5)), ("b", dt.date(2024, 2, 1))], "t string, d date")
    months = [("2023", "12"), ("2024", "01"), ("2024", "02")]
    assert values(manifest_over(df, "t", "d")) == [(t, y, m) for t in "ab" for y, m in months]


def test_pending_and_summary(spark):
    wanted = spark.createDataFrame([("g", "2024", m) for m in ("01", "02", "03", "04")], SLOT)
    landed = spark.createDataFrame([("g", "2024", "01"), ("g", "2024", "01")], SLOT)
    available = spark.createDataFrame([("g", "2024", m) for m in ("01", "02", "03")], SLOT)
    failed = spark.createDataFrame([("g", "2024", "03")], SLOT)
    assert values(pending_slots(wanted, landed), "month") == [("02",), ("03",), ("04",)]
    assert values(pending_slots(wanted, landed, available), "month") == [("02",), ("03",)]
    assert values(load_summary(wanted, landed, available, failed)) == [("failed", 1), ("loaded", 1), ("missing", 1), ("skipped", 1)]
    assert values(load_summary(wanted, landed, available)) == [("loaded", 2), ("missing", 1), ("skipped", 1)]


def test_landed_slots_ignore_empty_folders_and_files(spark, tmp_path):
    trip_file(spark, f"{tmp_path}/{slot_path('green', 2024, 1)}", "VendorID bigint", (1,))
    (tmp_path / slot_path("green", 2024, 2)).mkdir(parents=True)
    empty = tmp_path / slot_path("green", 2024, 3)
    empty.mkdir(parents=True)
    (empty / "data.parquet").touch()
    assert values(landed_slots(spark, str(tmp_path))) == [("green", "2024", "01")]


def test_append_brings_new_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    append_evolving(spark.createDataFrame([(1, "g")], "id int, kind string"), path, ["kind"])
    append_evolving(spark.createDataFrame([(2, "y", 0.5)], "id int, kind string, fee double"), path, ["kind"])
    assert values(read_evolving(spark, path), "id", "kind", "fee") == [(1, "g", None), (2, "y", 0.5)]
    pruned = plan_of(read_evolving(spark, path).filter("kind = 'g'"))
    assert "PartitionFilters: [isnotnull(kind" in pruned
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(balanced(read_evolving(spark, path), ["kind"]))


def test_overwrite_replaces_or_enforces_the_schema(spark):
    overwrite_table(spark.createDataFrame([(1,)], "a int"), "sink_t")
    overwrite_table(spark.createDataFrame([("x", 2.0)], "b string, c double"), "sink_t")
    assert spark.table("sink_t").columns == ["b", "c"]
    promote(spark, "sink_t", "sink_gold")
    assert values(spark.table("sink_gold")) == [("x", 2.0)]
    zones = spark.createDataFrame([("s", 1, "z", "b")], "service_zone string, location_id int, zone_name string, borough string")
    overwrite_enforced(zones, "sink_zone", schemas.DIM_ZONE)
    assert spark.table("sink_zone").columns == schemas.DIM_ZONE.names
    for bad in (zones.drop("borough"), zones.withColumn("more", F.lit(1)), zones.withColumn("location_id", F.lit("1"))):
        with pytest.raises(SchemaMismatch):
            overwrite_enforced(bad, "sink_zone", schemas.DIM_ZONE)
    assert values(spark.table("sink_zone"), "borough") == [("b",)]


def failing(df):
    """Rows of which the last ones cannot be computed."""
    first = df.columns[0]
    return df.withColumn(first, F.when(F.col(first) > 90, F.raise_error(F.lit("half-way"))).otherwise(F.col(first)))


@pytest.mark.parametrize("by", [[], ["kind"]])
def test_a_write_that_fails_half_way_leaves_the_table_as_it_was(spark, by):
    name, old = f"kept_{len(by)}", spark.range(10).withColumn("kind", F.col("id") % 2)
    overwrite_table(old, name, by)
    reader = spark.table(name)
    bad = spark.range(0, 100, 1, 4).withColumn("kind", F.col("id") % 2)
    with pytest.raises(Exception, match="half-way"):
        overwrite_table(failing(bad), name, by)
    assert values(spark.table(name), "id") == [(i,) for i in range(10)]
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_")] == []
    overwrite_table(spark.table(name).filter("id > 6"), name, by)  # of its own rows
    assert values(spark.table(name), "id") == [(7,), (8,), (9,)]
    assert reader.count() == (3 if by else 10)  # got before: partitions are looked up when it runs, other files are still there
    overwrite_table(spark.table(name).withColumn("more", F.lit(1)), name, by)
    assert sorted(spark.table(name).columns) == ["id", "kind", "more"] and spark.table(name).count() == 3
    overwrite_table(spark.range(2), name)
    assert values(spark.table(name)) == [(0,), (1,)]


def test_old_contents_are_removed_but_the_last(spark):
    for n in range(4):
        overwrite_table(spark.range(n), "contents_t")
    folder = _versions_folder(spark, "contents_t")
    assert len(names(spark, folder)) == 2 and spark.table("contents_t").count() == 3
    spark.sql("create database if not exists other_db")
    overwrite_table(spark.range(2), "other_db.contents_t")
    overwrite_table(spark.range(5), "other_db.contents_t")
    assert spark.table("other_db.contents_t").count() == 5 and spark.table("contents_t").count() == 3


def test_enforce_schema_widens_but_never_narrows(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b bigint")
    assert enforce_schema(df, schemas.struct(b=schemas.LONG, a=schemas.LONG)).first() == (2, 1)
    for narrower in (schemas.INT, schemas.DOUBLE, schemas.STRING):
        with pytest.raises(SchemaMismatch):
            enforce_schema(df, schemas.struct(a=schemas.INT, b=narrower))


def test_report_and_export_files(spark, tmp_path):
    stamp = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    status = spark.createDataFrame([("Success", 3, 100.0)], "status string, total_checks bigint, success_percent double")
    for _ in range(2):
        write_report(status, str(tmp_path / "report"), stamp)
    assert json.loads((tmp_path / "report").read_text()) == {
        "status": "Success", "total_checks": 3, "success_percent": 100.0, "timestamp": "2024-01-01 00:00:00"
    }
    with pytest.raises(ValueError):
        write_report(status.limit(0), str(tmp_path / "none"), stamp)
    rows = spark.createDataFrame([(dt.datetime(2024, 1, d), d) for d in (3, 1, 2)], "t timestamp, n int")
    kept = export_top_n(rows, 2, "t", str(tmp_path), dt.date(2024, 1, 5))
    assert [r["n"] for r in kept.collect()] == [1, 2]
    written = json.loads((tmp_path / "Weather_Report_2024-01-05.json").read_text())
    assert [w["n"] for w in written] == [1, 2] and written[0]["t"].startswith("2024-01-01T00:00:00")


def test_shuffle_size_follows_the_input(spark, tmp_path):
    assert shuffle_partitions_for(0, 8) == 8
    assert shuffle_partitions_for(1000 * TARGET_PARTITION_BYTES + 1, 8) == 1001
    assert shuffle_partitions_for(10**18, 8) == 32_768
    assert shuffle_partitions_for(10**18, 8, most=100) == 100
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes")}
    own = session_for(spark)
    assert size_for(own, 10**14) == (32_768, 10**9)
    assert own.conf.get("spark.sql.files.maxPartitionBytes") == "1000000000b"
    # The caller's session, and the next query's, stay as they were.
    assert before == {k: spark.conf.get(k) for k in before}
    assert size_for(session_for(spark), 1000) == (4, 128 * 1024 * 1024)
    land(tmp_path / "rows", "a.txt", "x" * 1000)
    scanned = scanned_bytes(spark.read.text(str(tmp_path / "rows")).crossJoin(spark.range(3)))
    assert 1000 <= scanned < 10_000
    land(tmp_path / "f", "x.txt", "12345")
    assert path_bytes(spark, str(tmp_path / "f"), str(tmp_path / "absent")) == 5
    assert staging_path(spark, "a") != staging_path(spark, "a")


def test_slots_are_cut_from_paths_of_any_shape(spark):
    from citylake.sources.manifest import SLOT, slot_of_path

    paths = {
        "file:/a/b/yellow/2024/01/part.parquet": ("yellow", "2024", "01"), "green/2023/12/x": ("green", "2023", "12"),
        "/yellow/2024/1/x": ("", "", ""), "/yellow/24/01/x": ("", "", ""), "/yellow/20a4/01/x": ("", "", ""), "2024/01/x": ("", "", ""),
        "/2024/01/x": ("", "", ""), "x": ("", "", ""), "": ("", "", ""), "s3://b/täxi type/2024/01/ü.parquet": ("täxi type", "2024", "01"),
        "/yellow/2024/01/deeper/x": ("", "", ""),
    }
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    found = df.select("path", *[c.alias(n) for n, c in slot_of_path(df["path"]).items()])
    assert {r["path"]: tuple(r[n] for n in SLOT) for r in found.collect()} == paths


def test_documents_are_listed_in_groups_and_parsed_once(spark, monkeypatch):
    """No scan of the documents is left in what broken_documents returns; it reads what was parsed."""
    from pyspark.sql import DataFrameReader

    from __spark_entry__ import queries

    key, seen, json_of = "spark.sql.sources.parallelPartitionDiscovery.parallelism", [], DataFrameReader.json
    monkeypatch.setattr(DataFrameReader, "json", lambda self, *a, **b: (seen.append(int(self._spark.conf.get(key))), json_of(self, *a, **b))[1])
    before = spark.conf.get(key)
    assert "Scan json" not in plan_of(queries()["broken_documents"](spark, "/root/testdata/sf0.001"))
    assert seen == [8 * spark.sparkContext.defaultParallelism] and spark.conf.get(key) == before
