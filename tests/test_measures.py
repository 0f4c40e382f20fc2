import datetime as dt

import pytest
from pyspark.sql import functions as F

from citylake.plans import insights
from citylake.plans.dimensions import dim_date, weather_forecast
from citylake.plans.measures import CityModel, latest_value, measure
from citylake.sources.calendar import calendar
from tests.conftest import plan_of, values

JAN, FEB, OUT = dt.date(2024, 1, 6), dt.date(2024, 2, 5), dt.date(2030, 1, 1)


@pytest.fixture(scope="module")
def model(spark):
    taxi = spark.createDataFrame(
        [
            (JAN, 1, "green", 2, 20.0),
            (JAN, 2, "green", 2, 60.0),
            (FEB, 1, "green", 4, 10.0),
            (FEB, 9, "yellow", 1, 8.0),
            (OUT, 1, "yellow", 1, 5.0),
            (None, 1, "yellow", 0, 0.0),
        ],
        "pickup_date date, pickup_zone_id int, taxi_type string, total_trips bigint, daily_revenue_usd double",
    )
    zones = spark.createDataFrame([(1, "Queens", "Astoria"), (2, "Bronx", "Mott")], "location_id int, borough string, zone_name string")
    fx = spark.createDataFrame(
        [(JAN, 2.0), (JAN, 4.0), (dt.date(2024, 1, 8), None), (OUT, 10.0)],
        "fx_date date, exchange_rate_to_eur double",
    )
    return CityModel(taxi, dim_date(calendar(spark, "2024-01-01", "2024-02-29")), zones, fx)


def test_avg_fare_is_a_ratio_of_sums_per_level(model):
    assert values(model.avg_fare(["year", "month"])) == [(2024, 1, 20.0), (2024, 2, 3.6), (None, None, 5.0)]
    assert values(model.avg_fare(["borough"])) == [("Bronx", 30.0), ("Queens", 5.0), (None, 8.0)]
    assert values(model.avg_fare()) == [(10.3,)]


def test_measure_without_trips_is_null(model):
    assert values(measure(model, "avg_fare", where={"year": 1999})) == [(None,)]
    assert values(measure(model, "avg_fare", ["taxi_type"], where={"pickup_date": None})) == [("yellow", None)]


def test_filters_on_date_zone_and_own_columns(model):
    assert values(measure(model, "avg_fare", ["month"], where={"borough": "Queens", "month": [1, 2]})) == [(1, 10.0), (2, 2.5)]
    assert values(measure(model, "avg_fare", ["borough"], where={"is_weekend": 1})) == [("Bronx", 30.0), ("Queens", 10.0)]
    later = {"pickup_date": lambda c: c > dt.date(2024, 2, 1)}
    assert values(measure(model, "avg_fare", where=later)) == [(pytest.approx(23 / 6),)]
    with pytest.raises(ValueError):
        model.avg_fare(["planet"])
    with pytest.raises(ValueError):
        measure(model, "profit")


def test_revenue_eur_evaluates_each_level_on_its_own(model):
    by_month = values(model.revenue_eur(["year", "month"]))
    # February has no rate; the blank member pairs dates outside the calendar on both sides.
    assert by_month == [(2024, 1, 240.0), (2024, 2, None), (None, None, 50.0)]
    total = values(model.revenue_eur())
    assert total == [(pytest.approx(103 * 16 / 3),)]
    assert total[0][0] != sum(r[2] or 0 for r in by_month)


def test_zone_attributes_do_not_reach_the_rates(model):
    mean = 16 / 3
    assert values(model.revenue_eur(["borough"])) == [
        ("Bronx", pytest.approx(60 * mean)),
        ("Queens", pytest.approx(35 * mean)),
        (None, pytest.approx(8 * mean)),
    ]
    mixed = values(model.revenue_eur(["month", "borough"], where={"month": 1}))
    assert mixed == [(1, "Bronx", 180.0), (1, "Queens", 60.0)]
    filtered = values(model.revenue_eur(["borough"], where={"month": 1}))
    assert filtered == [("Bronx", 180.0), ("Queens", 60.0)]


def test_revenue_modes(model):
    assert values(model.revenue_eur(["month"], where={"month": 1}, mode="divide")) == [(1, pytest.approx(80 / 3))]
    with pytest.raises(ValueError):
        model.revenue_eur(mode="guess")
    usd = insights.revenue_usd_eur(model, ["month"])
    assert usd.columns == ["month", "revenue_usd", "average_rate", "revenue_eur", "revenue_eur_divided"]


def test_no_cartesian_product_in_any_measure(model):
    for by in ([], ["month"], ["borough"], ["month", "borough"]):
        plan = plan_of(model.revenue_eur(by))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_fact_is_reduced_before_it_meets_a_dimension(model):
    plan = model.avg_fare(["month"])._jdf.queryExecution().optimizedPlan().toString()
    join_at = plan.index("Join LeftOuter")
    assert "Aggregate" in plan[:join_at] and "Aggregate" in plan[join_at:]


T1, T2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 11)


def latest(spark, rows, column="v"):
    df = spark.createDataFrame(rows, "g string, t timestamp, v double, s string")
    return {r["g"]: r[f"latest_{column}"] for r in latest_value(df, "t", column, ["g"]).collect()}


def test_latest_value_needs_a_single_value_at_the_latest_time(spark):
    rows = [
        ("one", T1, 1.0, "a"), ("one", T2, 2.0, "b"),
        ("same", T2, 3.0, "c"), ("same", T2, 3.0, "c"),
        ("unlike", T2, 3.0, "c"), ("unlike", T2, 4.0, "d"),
        ("null beside", T2, None, None), ("null beside", T2, 4.0, "d"),
        ("null alone", T1, 4.0, "d"), ("null alone", T2, None, None),
        ("no time", None, 4.0, "d"),
        ("time missing once", None, 9.0, "z"), ("time missing once", T1, 1.0, "a"),
    ]
    expected = {
        "one": 2.0, "same": 3.0, "unlike": None, "null beside": None, "null alone": None, "no time": None,
        "time missing once": 1.0,
    }
    assert latest(spark, rows) == expected
    texts = latest(spark, rows, "s")
    assert (texts["one"], texts["same"], texts["unlike"], texts["time missing once"]) == ("b", "c", None, "a")


def test_latest_value_of_everything_and_of_nothing(spark):
    df = spark.createDataFrame([(T1, 1.0, 5), (T2, 2.0, 6)], "t timestamp_ntz, a double, b int")
    assert values(latest_value(df, "t", ["a", "b"])) == [(T2, 2.0, 6)]
    assert values(latest_value(df.limit(0), "t", "a")) == [(None, None)]


def test_latest_measures_by_name(spark, model):
    weather = spark.createDataFrame(
        [(T1, 1.0, 5, "rain"), (T2, 2.0, 6, "sun"), (T2, 2.0, 7, "sun")],
        "forecast_time timestamp, temperature double, humidity int, condition string",
    )
    full = CityModel(model.taxi, model.dates, model.zones, weather=weather)
    assert values(measure(full, "latest_temperature")) == [(2.0,)]
    assert values(measure(full, "latest_humidity")) == [(None,)]
    assert values(measure(full, "latest_condition", where={"condition": "rain"})) == [("rain",)]
    with pytest.raises(ValueError):
        measure(model, "latest_condition")


def test_forecast_from_documents(spark):
    docs = spark.createDataFrame(
        [
            ([{"dt": 0, "main": {"temp": 1.5, "feels_like": 1.0, "humidity": 5, "pressure": 9},
               "weather": [{"description": "rain"}], "wind": {"speed": 2.0}},
              {"dt": 3600, "main": None, "weather": [], "wind": None}],),
            ([],),
            (None,),
        ],
        "list array<struct<dt: bigint, main: struct<temp: double, feels_like: double, humidity: bigint, "
        "pressure: bigint>, weather: array<struct<description: string>>, wind: struct<speed: double>>>",
    )
    out = weather_forecast(docs, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    rows = out.withColumn("forecast_time", F.unix_timestamp("forecast_time")).orderBy("forecast_time").collect()
    assert [tuple(r)[:7] for r in rows] == [
        (0, 1.5, 1.0, 5, 9, "rain", 2.0),
        (3600, None, None, None, None, None, None),
    ]
    series = insights.forecast_series(out)
    assert series.columns == ["forecast_time", "temperature", "feels_like", "pressure"]


def test_busiest_zones_hotspots_and_trend(spark, model):
    assert values(insights.busiest_zones(model, 2)) == [(1, "Astoria", "Queens", 7), (2, "Mott", "Bronx", 2)]
    assert values(insights.trip_volume(model, ["taxi_type"])) == [("green", 8, 90.0), ("yellow", 2, 13.0)]
    aq = spark.createDataFrame(
        [(JAN, "x", 1.0, 5.0, None), (FEB, "x", 3.0, None, None), (JAN, "y", None, 1.0, 1.0), (OUT, "z", 9.0, 1.0, 1.0)],
        "reading_date date, location_name string, avg_pm25 double, avg_no2 double, avg_o3 double",
    )
    assert [tuple(r) for r in insights.aq_hotspots(aq, 2).collect()] == [("z", 9.0, 1), ("x", 2.0, 2)]
    trend = values(insights.aq_trend(aq, model.dates, ["month"]))
    assert trend == [(1, 1.0, 3.0, 1.0), (2, 3.0, None, None), (None, 9.0, 1.0, 1.0)]


def test_daily_summary(spark):
    trips = spark.createDataFrame(
        [(T1, 0, 1.0), (T2, 1, 1.0), (dt.datetime(2024, 1, 2), 1, 1.0)],
        "pickup_datetime timestamp, passenger_count int, trip_distance double",
    )
    aq = spark.createDataFrame([(dt.date(2024, 1, 1), 4.0)], "reading_date date, avg_pm25 double")
    assert values(insights.daily_summary(trips, aq)) == [
        (dt.date(2024, 1, 1), 2, 1, 0.5, "Failure", 4.0),
        (dt.date(2024, 1, 2), 1, 0, 0.0, "Success", None),
    ]


def test_calendar_defaults(spark):
    days = dim_date(calendar(spark, dt.date(2020, 1, 1), dt.date(2025, 11, 30)))
    row = days.agg(F.count(F.lit(1)), F.sum("is_weekend"), F.min("date_key"), F.max("date_key")).first()
    assert tuple(row) == (2161, 618, dt.date(2020, 1, 1), dt.date(2025, 11, 30))
    first = days.filter("date_key = '2020-01-01'").first()
    assert tuple(first) == (dt.date(2020, 1, 1), 2020, 1, "January", "Wednesday", 0)


def test_two_key_measures_shuffle_reduced_rows_into_the_zone_join(spark):
    """The zone join sees sums by zone and the days' attributes, not the fact at its own grain."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from citylake import bindings

        df = measure(bindings.model(spark, "/root/testdata/sf0.001"), "avg_fare", ["borough", "year"])
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    zone_join = next(i for i, line in enumerate(plan.splitlines()) if "Join" in line and ("pickup_zone_id" in line or "s_suppkey" in line))
    below = plan.splitlines()[zone_join + 1 :]
    first = next(line for line in below if "Aggregate" in line or "Join" in line)
    assert "Aggregate" in first and "year" in first and "pickup_date" not in first
