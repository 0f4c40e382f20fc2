import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from citylake.functions import (
    array_at,
    as_date,
    cast_to,
    duration_minutes,
    exact_sum,
    first_of,
    is_weekend,
    nan_to_null,
    pad2,
    percent_text,
    rate,
)
from citylake.operators.conform import (
    cast_all,
    conform_trips,
    dedup,
    explode_rows,
    flatten,
    in_bbox,
    keep_any_not_null,
    rename,
    tag,
    trailing_days,
    union_conformed,
    valid_trips,
    with_audit,
)
from tests.conftest import values

NOON = dt.datetime(2024, 3, 1, 12, 0, 0)
LATER = dt.datetime(2024, 3, 1, 12, 30, 30)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).first()


def test_bad_values_become_null_and_not_errors(spark):
    row = one(
        spark,
        truncated=cast_to(F.lit(1.7), "int"),
        bad=cast_to(F.lit("x"), "int"),
        iso=as_date(F.lit("2024-03-01T10:00:00Z")),
        no_date=as_date(F.lit("soon")),
        empty=array_at(F.array().cast("array<int>"), 0),
        nan=nan_to_null(F.lit(float("nan"))),
        number=nan_to_null(F.lit(2.5)),
        nothing=rate(F.lit(1), F.lit(0)),
    )
    assert row["truncated"] == 1 and row["bad"] is None
    assert row["iso"] == dt.date(2024, 3, 1) and row["no_date"] is None
    assert row["empty"] is None and row["nan"] is None and row["number"] == 2.5
    assert row["nothing"] is None


def test_scalar_helpers(spark):
    row = one(
        spark,
        minutes=duration_minutes(F.lit(NOON), F.lit(LATER)),
        sat=is_weekend(F.lit(dt.date(2024, 3, 2))),
        mon=is_weekend(F.lit(dt.date(2024, 3, 4))),
        first=first_of(F.lit(None).cast("int"), F.lit(3)),
        month=pad2(F.lit(7)),
        text=percent_text(F.lit(0.0123)),
    )
    assert row["minutes"] == 30.5
    assert (row["sat"], row["mon"], row["first"], row["month"]) == (1, 0, 3, "07")
    assert row["text"] == "1.2300%"


def test_duration_counts_whole_seconds(spark):
    start, end = dt.datetime(2024, 3, 1, 12, 0, 0, 900_000), dt.datetime(2024, 3, 1, 12, 1, 0, 100_000)
    assert one(spark, m=duration_minutes(F.lit(start), F.lit(end)))["m"] == 1.0


def test_exact_sum_does_not_depend_on_order(spark):
    amounts = [0.1, 0.2, 0.7, -1.25, 1e9 + 0.000001, -1e9, 0.333333, None] * 50
    expected = math.fsum(a for a in amounts if a is not None)
    for order in (amounts, amounts[::-1], sorted(amounts, key=lambda a: (a is None, a))):
        df = spark.createDataFrame([(a,) for a in order], "a double").repartition(5)
        assert df.agg(exact_sum("a").alias("s")).first()["s"] == expected
    empty = spark.createDataFrame([(None,)], "a double")
    assert empty.agg(exact_sum("a").alias("s")).first()["s"] is None


def test_union_keeps_every_row_and_pads_with_null(spark):
    yellow = spark.createDataFrame([(1, 2.0, 0.5), (1, 2.0, 0.5)], "id int, passengers double, airport_fee double")
    green = spark.createDataFrame([(2, 3, 0.1)], "id int, passengers bigint, ehail_fee double")
    out = union_conformed(tag(yellow, "kind", "y"), tag(green, "kind", "g"))
    assert values(out, "id", "passengers", "airport_fee", "ehail_fee", "kind") == [
        (1, 2.0, 0.5, None, "y"),
        (1, 2.0, 0.5, None, "y"),
        (2, 3.0, None, 0.1, "g"),
    ]


def test_valid_trips_drop_zero_null_and_backward(spark):
    rows = [
        (1, 1.0, 5.0, NOON, LATER),
        (2, 0.0, 5.0, NOON, LATER),
        (3, -1.0, 5.0, NOON, LATER),
        (4, None, 5.0, NOON, LATER),
        (5, 1.0, 0.0, NOON, LATER),
        (6, 1.0, 5.0, NOON, NOON),
        (7, 1.0, 5.0, LATER, NOON),
        (8, 1.0, 5.0, NOON, None),
    ]
    df = spark.createDataFrame(
        rows, "id int, trip_distance double, total_amount double, pickup_datetime timestamp, dropoff_datetime timestamp"
    )
    assert values(valid_trips(df), "id") == [(1,)]


def test_conform_trips_takes_either_variant_and_keeps_optional_columns(spark):
    rows = [
        (1, "yellow", NOON, LATER, None, None, 1.7, 3, 4, 2.0, 10.0, 12.0),
        (2, "green", None, None, NOON, LATER, None, 5, 6, 1.0, 8.0, 9.0),
        (3, "green", None, None, LATER, NOON, 1.0, 5, 6, 1.0, 8.0, 9.0),
    ]
    df = spark.createDataFrame(
        rows,
        "VendorID int, taxi_type string, tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, "
        "lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, passenger_count double, "
        "PULocationID int, DOLocationID int, trip_distance double, fare_amount double, total_amount double",
    )
    out = conform_trips(df, dt.datetime(2024, 3, 2, tzinfo=dt.timezone.utc))
    assert values(out, "VendorID", "passenger_count", "pickup_location_id", "trip_duration_minutes") == [
        (1, 1, 3, 30.5),
        (2, None, 5, 30.5),
    ]
    assert "tip_amount" not in out.columns
    assert "tip_amount" in conform_trips(df.withColumn("tip_amount", F.lit(1.0))).columns
    assert out.schema["silver_processing_time"].dataType.simpleString() == "timestamp"


def test_green_only_input_conforms(spark):
    df = spark.createDataFrame(
        [(2, "green", NOON, LATER, 5, 6, 1.0, 9.0)],
        "VendorID int, taxi_type string, lpep_pickup_datetime timestamp, lpep_dropoff_datetime timestamp, "
        "PULocationID int, DOLocationID int, trip_distance double, total_amount double",
    )
    assert conform_trips(df).count() == 1


def test_dedup_is_deterministic_and_idempotent(spark):
    rows = [(1, "b", 2), (1, "a", 3), (1, "a", 1), (2, None, 1), (None, "z", 1), (None, "y", 1)]
    df = spark.createDataFrame(rows, "id int, name string, n int")
    once = dedup(df, ["id"])
    assert values(once) == [(1, "a", 1), (2, None, 1), (None, "y", 1)]
    assert values(dedup(once, ["id"])) == values(once)
    assert values(dedup(df, ["id"], ["n", "name"]), "id", "n") == [(1, 1), (2, 1), (None, 1)]
    assert dedup(df.select("id"), ["id"]).count() == 3


def test_small_projections(spark):
    df = spark.createDataFrame([(1, None, None), (2, 1.0, None), (3, None, 0.0)], "id int, a double, b double")
    assert values(keep_any_not_null(df, ["a", "b"]), "id") == [(2,), (3,)]
    assert rename(df, {"a": "alpha"}).columns == ["id", "alpha", "b"]
    typed = cast_all(df.withColumn("t", F.lit("7x")), {"t": "int", "absent": "int"})
    assert typed.first()["t"] is None
    nested = df.select(F.struct("id", F.struct("a").alias("deep")).alias("s"))
    assert flatten(nested, {"x": "s.id", "y": "s.deep.a"}).columns == ["x", "y"]
    stamped = with_audit(df, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc), "feed", taxi_type="green").first()
    assert (stamped["source_file"], stamped["taxi_type"]) == ("feed", "green")


def test_explode_drops_or_keeps_empty(spark):
    df = spark.createDataFrame([(1, [7, 8]), (2, []), (3, None)], "id int, list array<int>")
    assert values(explode_rows(df, "list")) == [(1, 7), (1, 8)]
    assert values(explode_rows(df, "list", "step", keep_empty=True)) == [(1, 7), (1, 8), (2, None), (3, None)]


def test_box_edges_count_and_trailing_days_start_at_the_bound(spark):
    df = spark.createDataFrame([(1, 40.0, -74.0), (2, 41.0, -73.0), (3, 41.1, -73.0)], "id int, lat double, lon double")
    assert values(in_bbox(df, -74.0, 40.0, -73.0, 41.0), "id") == [(1,), (2,)]
    days = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3)], "d date")
    assert values(trailing_days(days, "d", 1, "2024-01-03")) == [(dt.date(2024, 1, 2),), (dt.date(2024, 1, 3),)]


def test_trips_without_any_time_column_name_what_is_missing(spark):
    bronze = spark.createDataFrame([(1, 2.0)], "VendorID int, trip_distance double")
    with pytest.raises(ValueError, match="no column of tpep_pickup_datetime, lpep_pickup_datetime"):
        conform_trips(bronze)
