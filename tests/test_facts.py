import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from citylake import schemas
from citylake.functions import exact_avg, exact_sum
from citylake.operators.facts import (
    fact_aq_daily,
    fact_taxi_daily,
    pivot_parameters,
    silver_air_quality,
    summarize,
    taxi_daily_by_zone,
)
from citylake.operators.joins import (
    mobility_vs_gdp,
    overlay_corr,
    overlay_daily,
    sensor_measurements,
    with_dim,
)
from citylake.operators.ordering import ordered, top_k
from tests.conftest import plan_of, values

DAY = dt.date(2024, 3, 1)
NEXT = dt.date(2024, 3, 2)


def at(hour, day=1):
    return dt.datetime(2024, 3, day, hour)


TRIPS = "pickup_datetime timestamp, pickup_location_id int, taxi_type string, total_amount double, trip_distance double"


def test_daily_fact_groups_nulls_and_ignores_them_in_averages(spark):
    rows = [
        (at(1), 1, "green", 10.1, 2.0),
        (at(23), 1, "green", 0.2, None),
        (at(1), 1, "yellow", 5.0, 1.0),
        (at(1), None, "green", 7.0, 3.0),
        (at(1), None, "green", 7.0, 3.0),
    ]
    trips = spark.createDataFrame(rows, TRIPS)
    fact = fact_taxi_daily(trips)
    assert values(fact) == [
        (DAY, 1, "green", 2, 10.1 + 0.2, 2.0, 0.0),
        (DAY, 1, "yellow", 1, 5.0, 1.0, 0.0),
        (DAY, None, "green", 2, 14.0, 3.0, 0.0),
    ]
    assert fact.agg(F.sum("total_trips")).first()[0] == len(rows)
    tipped = fact_taxi_daily(trips.withColumn("tip_amount", F.when(F.col("taxi_type") == "green", 2.0)))
    assert values(tipped.filter("pickup_location_id = 1"), "taxi_type", "avg_tip_amount") == [
        ("green", 2.0),
        ("yellow", None),
    ]
    assert fact.schema["avg_tip_amount"].dataType.simpleString() == "double"


def test_by_zone_weighs_distances_by_trips(spark):
    fact = spark.createDataFrame(
        [(DAY, 1, "green", 3, 30.0, 1.0), (DAY, 1, "yellow", 1, 10.0, 5.0)],
        "pickup_date date, pickup_location_id int, taxi_type string, total_trips bigint, "
        "daily_revenue_usd double, avg_trip_distance double",
    )
    assert values(taxi_daily_by_zone(fact)) == [(DAY, 1, 4, 40.0, 2.0)]


READINGS = "location_name string, parameter string, lat double, lon double, value double, date_utc string"


def readings(spark):
    day = "2024-03-01T05:00:00Z"
    return spark.createDataFrame(
        [
            ("x", "pm25", 1.0, 2.0, 10.0, day),
            ("x", "pm25", 1.0, 2.0, 20.0, day),
            ("x", "pm25", 1.0, 2.0, 20.0, day),
            ("x", "co", 1.0, 2.0, 1.0, day),
            ("x", "noise", 1.0, 2.0, 99.0, day),
            ("y", "co", 1.0, 2.0, 3.0, day),
            ("y", "pm25", 1.0, 2.0, None, day),
            ("z", "o3", 1.0, 2.0, 4.0, "no date"),
        ],
        READINGS,
    )


def test_pivot_has_all_parameters_and_skips_unknown_ones(spark):
    wide = silver_air_quality(readings(spark))
    assert set(schemas.PARAMETERS) <= set(wide.columns) and "noise" not in wide.columns
    rows = {r["location_name"]: r for r in wide.collect()}
    assert rows["x"]["pm25"] == pytest.approx(50 / 3) and rows["x"]["co"] == 1.0
    assert rows["x"]["pm10"] is None and rows["z"]["reading_date"] is None
    without_copies = silver_air_quality(readings(spark), drop_copies=True)
    assert {r["location_name"]: r["pm25"] for r in without_copies.collect()}["x"] == 15.0
    few = pivot_parameters(readings(spark), ["co"], ["location_name"])
    assert values(few) == [("x", 1.0), ("y", 3.0), ("z", None)]


def test_aq_fact_keeps_rows_with_a_major_pollutant(spark):
    wide = silver_air_quality(readings(spark))
    fact = fact_aq_daily(wide)
    assert values(fact, "location_name") == [("x",), ("z",)]
    assert fact.columns == schemas.FACT_AQ.names
    # One row per key on both sides: the daily averages are the wide values again.
    assert fact.filter("location_name = 'x'").first()["avg_pm25"] == pytest.approx(50 / 3)


def test_pivot_and_fact_share_one_shuffle(spark):
    plan = plan_of(fact_aq_daily(silver_air_quality(readings(spark))))
    assert plan.count("Exchange hashpartitioning") == 1


def test_summarize_uses_declared_defaults(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 2.0, None), ("b", None, 4)], "c string, temperature double, humidity bigint")
    assert values(summarize(df, "c")) == [("a", 3.0, 2), ("b", None, 4)]
    assert summarize(df, "c", ["temperature"]).columns == ["c", "temperature"]
    with pytest.raises(ValueError):
        summarize(df, "humidity", ["c"])


def test_with_dim_keeps_unmatched_facts(spark):
    fact = spark.createDataFrame([(1, 5.0), (9, 6.0), (None, 7.0)], "zone int, v double")
    dim = spark.createDataFrame([(1, "Queens")], "location_id int, borough string")
    assert values(with_dim(fact, dim, "zone", "location_id", ["borough"]), "v", "borough") == [
        (5.0, "Queens"),
        (6.0, None),
        (7.0, None),
    ]


def test_sensor_without_days_gives_no_row(spark):
    sensors = spark.createDataFrame(
        [(1, "pm25", "u", 1.0, 2.0, "x"), (2, "co", "u", 1.0, 2.0, "x")],
        "id bigint, parameter string, unit string, lat double, lon double, location_name string",
    )
    days = spark.createDataFrame([(1, 5.0, "d1"), (1, 6.0, "d2"), (3, 7.0, "d1")], "sensor_id bigint, value double, date_utc string")
    assert values(sensor_measurements(sensors, days), "sensor_id", "parameter", "value") == [(1, "pm25", 5.0), (1, "pm25", 6.0)]


def test_overlay_joins_days_and_not_rows(spark):
    taxi = spark.createDataFrame(
        [(DAY, 10, 1.0), (DAY, 5, 2.0), (NEXT, 7, 1.0)], "pickup_date date, total_trips bigint, daily_revenue_usd double"
    )
    aq = spark.createDataFrame(
        [(DAY, 10.0), (DAY, 20.0), (DAY, None), (dt.date(2024, 3, 3), 5.0)], "reading_date date, avg_pm25 double"
    )
    both = overlay_daily(taxi, aq)
    assert values(both) == [(DAY, 15, 3.0, 15.0), (NEXT, 7, 1.0, None), (dt.date(2024, 3, 3), None, None, 5.0)]
    assert values(overlay_corr(both), "days") == [(1,)]


def test_gdp_growth_compares_with_the_year_before(spark):
    taxi = spark.createDataFrame([(dt.date(y, 1, 1), 10) for y in (2020, 2021, 2022)], "pickup_date date, total_trips bigint")
    gdp = spark.createDataFrame(
        [("US", 2020, 100.0), ("US", 2021, 150.0), ("FR", 2021, 0.0)], "country_name string, gdp_year int, gdp_value double"
    )
    assert values(mobility_vs_gdp(taxi, gdp)) == [
        (2020, "US", 10, 100.0, None),
        (2021, "FR", 10, 0.0, None),
        (2021, "US", 10, 150.0, 0.5),
        (2022, None, 10, None, None),
    ]


def test_order_and_top_k(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", None)], "k string, n int")
    assert [r["k"] for r in top_k(df, 2, "n", "k").collect()] == ["b", "c"]
    assert [r["k"] for r in top_k(df, 9, "n", "k").collect()] == ["b", "c", "a"]
    assert [r["k"] for r in ordered(df, ["n", "k"], limit=2).collect()] == ["d", "a"]
    assert [r["k"] for r in ordered(df, "k", desc=True).collect()] == ["d", "c", "b", "a"]
    plan = plan_of(top_k(df, 2, "n", "k"))
    assert "TakeOrderedAndProject" in plan


SPECIAL = [
    ([1.5, float("nan")], "nan"),
    ([1.5, float("inf")], float("inf")),
    ([float("inf"), float("-inf")], "nan"),
    ([5e18, 5e18], 1e19),
    ([1.7e308, -1.0], 1.7e308),
    ([-3.0, 0.01], -2.99),
    ([1e12, -1e12, 2e-7], 2e-7),
    ([0.1] * 10, 1.0),
    ([None, None], None),
    ([None, 2.5], 2.5),
]


@pytest.mark.parametrize("amounts, want", SPECIAL)
def test_exact_sum_of_special_amounts(spark, amounts, want):
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    got = df.agg(exact_sum("a")).first()[0]
    assert (math.isnan(got) if want == "nan" else got == want)
    average = df.agg(exact_avg("a")).first()[0]
    assert average is None if want is None else math.isnan(average) or average == got / sum(a is not None for a in amounts)


def test_exact_sum_keeps_small_amounts_and_decimals(spark):
    tiny = spark.range(1_000_000).select(F.lit(2e-7).alias("a"))
    assert tiny.agg(exact_sum("a")).first()[0] == pytest.approx(0.2, rel=1e-12)
    decimal = spark.sql("select cast('1.234567891' as decimal(20,9)) as a union all select cast('1e-9' as decimal(20,9))")
    assert decimal.agg(exact_sum("a")).first()[0] == 1.234567892


def test_exact_sum_is_the_rounded_true_sum_in_any_order(spark):
    rng = random.Random(4)
    values = [round(rng.uniform(-9e4, 9e4), rng.choice([2, 4, 6])) for _ in range(3000)]
    want = math.fsum(values)
    for n in (1, 3, 8):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "a double").repartition(n)
        assert df.agg(exact_sum("a")).first()[0] == want
