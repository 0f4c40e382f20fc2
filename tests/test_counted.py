"""Quality counts that come from writes."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from citylake.operators.quality import daily_rules, quality_report, rule_counts
from citylake.plans import layers
from citylake.plans.counted import CountedTable
from citylake.sources.sinks import overwrite_partitions, overwrite_table
from tests.conftest import values
from tests.test_runs import RUN, land_trips, landing  # noqa: F401  the fixture of a landed day

SCHEMA = "passenger_count int, trip_distance double, kind string, month string"


def rows(spark, *month_and_passengers):
    made = [(p, 1.0, "yellow", m) for m, passengers in month_and_passengers for p in passengers]
    return spark.createDataFrame(made, SCHEMA)


@pytest.fixture
def counted(spark, tmp_path):
    return CountedTable(spark, str(tmp_path / "note.json"), f"counted_{uuid.uuid4().hex}", daily_rules()["trips"], ["kind", "month"])


def write(counted, df):
    with counted.writing() as counts:
        if counted.spark.catalog.tableExists(counted.table):
            overwrite_partitions(df, counted.table, counted.columns, counts)
        else:
            overwrite_table(df, counted.table, counted.columns, counts)


def scan(counted):
    found = rule_counts(counted.spark.table(counted.table), counted.rules).collect()
    return {r["rule"]: (r["total"], r["failed"]) for r in found}


def scans_of(counted, monkeypatch):
    """Partitions that are scanned from now on."""
    seen, real = [], counted._scanned
    monkeypatch.setattr(counted, "_scanned", lambda slots: (seen.append(sorted(slots)), real(slots))[1])
    return seen


def test_counts_of_writes_are_those_of_a_scan_without_one(spark, counted, monkeypatch):
    seen = scans_of(counted, monkeypatch)
    assert counted.counts() == {"bad_trips": (0, 0)}
    write(counted, rows(spark, ("01", [1, 0, None])))
    write(counted, rows(spark, ("02", [0, 0])))
    assert counted.counts() == {"bad_trips": (5, 3)} == scan(counted)
    write(counted, rows(spark, ("02", [1])))
    assert counted.counts() == {"bad_trips": (4, 1)} == scan(counted)
    assert seen == []


def test_only_partitions_without_counts_are_scanned(spark, counted, monkeypatch):
    seen = scans_of(counted, monkeypatch)
    write(counted, rows(spark, ("01", [0]), ("02", [0, 1]), ("03", [1])))
    write(counted, rows(spark, ("02", [1, 1, 1, 0])))
    assert counted.counts() == {"bad_trips": (6, 2)} == scan(counted)
    assert seen == [[("yellow", "01"), ("yellow", "03")]]
    write(counted, rows(spark, ("01", [1])))
    assert counted.counts() == {"bad_trips": (6, 1)} == scan(counted) and len(seen) == 1
    overwrite_partitions(rows(spark, ("03", [0, 0])), counted.table, counted.columns)  # without counts
    spark.sql(f"alter table {counted.table} drop partition (kind = 'yellow', month = '01')")
    assert counted.counts() == {"bad_trips": (6, 3)} == scan(counted)
    assert seen[1:] == [[("yellow", "03")]]


def test_a_write_that_breaks_off_is_not_noted(spark, counted):
    write(counted, rows(spark, ("01", [0, 1])))
    with pytest.raises(Exception, match="broken"):
        write(counted, rows(spark, ("01", [1])).withColumn("trip_distance", F.expr("raise_error('broken')").cast("double")))
    assert counted.counts() == scan(counted)
    with pytest.raises(RuntimeError):
        with counted.writing() as counts:
            overwrite_partitions(rows(spark, ("01", [0, 0, 0])), counted.table, counted.columns, counts)
            raise RuntimeError("after the write, before the note")
    assert counted.counts() == {"bad_trips": (3, 3)} == scan(counted)


def test_other_rules_do_not_use_the_note(spark, counted):
    write(counted, rows(spark, ("01", [0, 1])))
    other = CountedTable(spark, counted.note, counted.table, {"null": F.col("passenger_count").isNull()}, counted.columns)
    assert other.counts() == {"null": (2, 0)}


def test_a_table_without_partitions_and_one_without_rows(spark, tmp_path):
    plain = CountedTable(spark, str(tmp_path / "note.json"), f"counted_{uuid.uuid4().hex}", daily_rules()["trips"])
    write(plain, rows(spark, ("01", [0, 1, 2])))
    assert plain.counts() == {"bad_trips": (3, 1)}
    for empty in (rows(spark, ("01", [1])).limit(0), rows(spark, ("01", [1])).filter("passenger_count = 5")):
        with plain.writing() as counts:
            overwrite_table(empty, plain.table, (), counts)
        assert plain.counts() == {"bad_trips": (0, 0)} == scan(plain)


def test_many_tasks_are_counted_once(spark, counted):
    df = spark.range(20_000, numPartitions=16).selectExpr(
        "cast(id % 3 as int) as passenger_count", "1D as trip_distance", "'yellow' as kind", "if(id < 15000, '01', '02') as month"
    )
    write(counted, df)
    assert counted.counts() == {"bad_trips": (20_000, 6_667)}


def test_the_gate_of_a_daily_run_scans_no_conformed_table(spark, landing, monkeypatch):  # noqa: F811
    for name in ("silver_nyc_taxi", "silver_openaq", "silver_fx"):
        spark.sql(f"drop table if exists {name}")

    def refuse(self, slots):
        raise AssertionError(f"{self.table} is scanned")

    monkeypatch.setattr(CountedTable, "_scanned", refuse)

    def run():
        report = layers.run_daily(spark, landing, dt.date(2024, 1, 1), dt.date(2024, 12, 31), RUN, max_rate=0.5)
        told = quality_report(spark.table("silver_nyc_taxi"), spark.table("silver_openaq"), spark.table("silver_fx"))
        assert values(report) == values(told)
        return dict((r["rule"], (r["total"], r["failed"])) for r in report.collect())

    assert run() == {"bad_trips": (40, 0), "impossible_pm25": (1, 0), "fx_nulls": (2, 0)}
    land_trips(spark, landing.trips, "green", 3, [0.0] * 5)
    assert run()["bad_trips"] == (45, 5)
    assert run()["bad_trips"] == (45, 5)
