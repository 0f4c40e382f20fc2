"""The driver's tables in the roles of the city sources.

Order lines are trips (pickup on the order date, dropoff on the ship date, zone by supplier), events are
air-quality readings and forecast documents, daily order prices are exchange rates, and order volume by
nation and year is GDP.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.operators.conform import conform_trips
from citylake.operators.exact import exact_aggregate
from citylake.operators.facts import fact_aq_daily, fact_taxi_daily, silver_air_quality
from citylake.plans.dimensions import dim_date, dim_fx, weather_forecast
from citylake.plans.measures import CityModel
from citylake.sources.calendar import calendar

RUN_TS = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)

# Calendar of the bound star. Some pickups lie after it, so blank members occur.
CALENDAR = (dt.date(1995, 1, 1), dt.date(2001, 6, 30))

# Which event type plays which parameter. pm10 and so2 never occur.
EVENT_PARAMETER = {
    "click": "pm25",
    "error": "no2",
    "purchase": "o3",
    "signup": "temperature",
    "view": "co",
}


# Columns of the driver's tables. Given to the reader, so that no job infers them.
TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(table_path(sf_dir, name))


YELLOW = "l_linestatus = 'F'"
TOTAL = "l_extendedprice * (1 - l_discount) * (1 + l_tax)"


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with their orders: what trips are made of."""
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])


def raw_trips_of(lines: DataFrame) -> DataFrame:
    """Raw trip table of both taxi types: each type has its own time columns, only yellow has tips."""
    return lines.selectExpr(
        "o_custkey as VendorID",
        f"if({YELLOW}, 'yellow', 'green') as taxi_type",
        f"if({YELLOW}, o_orderdate, null) as tpep_pickup_datetime",
        f"if({YELLOW}, l_shipdate, null) as tpep_dropoff_datetime",
        f"if({YELLOW}, null, o_orderdate) as lpep_pickup_datetime",
        f"if({YELLOW}, null, l_shipdate) as lpep_dropoff_datetime",
        "cast(l_linenumber - 1 as double) as passenger_count",
        "l_quantity as trip_distance",
        "l_suppkey as PULocationID",
        "l_partkey as DOLocationID",
        "l_extendedprice as fare_amount",
        f"if({YELLOW}, l_extendedprice * l_tax, null) as tip_amount",
        f"{TOTAL} as total_amount",
        "cast(case l_returnflag when 'R' then 1 when 'A' then 2 else 3 end as bigint) as payment_type",
        f"cast(if({YELLOW}, 2, 1) as bigint) as trip_type",
        "cast(l_linenumber as double) as RatecodeID",
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_of(trip_lines(spark, sf_dir))


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_trips(raw_trips(spark, sf_dir), RUN_TS)


def trip_variants(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two trip files with their own column names; each has a fee that the other lacks."""
    lines = table(spark, sf_dir, "lineitem")
    shared = [
        "l_orderkey as VendorID",
        "l_quantity as trip_distance",
        "l_suppkey as PULocationID",
        "l_extendedprice as fare_amount",
    ]
    yellow = lines.where(YELLOW).selectExpr(
        *shared,
        "l_shipdate as tpep_dropoff_datetime",
        "cast(l_linenumber - 1 as double) as passenger_count",
        "l_discount as airport_fee",
    )
    green = lines.where(f"not ({YELLOW})").selectExpr(
        *shared,
        "l_shipdate as lpep_dropoff_datetime",
        "cast(l_linenumber - 1 as bigint) as passenger_count",
        "l_tax as ehail_fee",
    )
    return yellow, green


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"])
        .join(region, nation["n_regionkey"] == region["r_regionkey"])
        .selectExpr(
            "s_suppkey as location_id", "r_name as borough", "s_name as zone_name", "n_name as service_zone"
        )
    )


def repeated_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The zone lookup with every id twice, under two names."""
    once = zones(spark, sf_dir)
    return once.unionByName(once.withColumn("zone_name", F.concat("zone_name", F.lit(" (old)"))))


def dates(spark: SparkSession) -> DataFrame:
    return dim_date(calendar(spark, *CALENDAR))


def _case(column: str, values: dict[str, object]) -> str:
    """SQL that maps a column's values."""
    quoted = lambda v: "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    arms = " ".join(f"when {quoted(k)} then {v if isinstance(v, int) else quoted(v)}" for k, v in values.items())
    return f"case {column} {arms} end"


PARAMETER = _case("event_type", EVENT_PARAMETER)
SENSOR_CODE = _case("event_type", {e: i for i, e in enumerate(EVENT_PARAMETER)})
LAT = "40.4D + (user_id % 100) * 0.01D"
LON = "-74.3D + (user_id % 80) * 0.01D"
LOCATION = "concat('loc-', user_id)"
# Reading time as ISO text, moved back 25 years into the years of the trips.
UTC_TEXT = "date_format(ts - interval 25 year, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"


def readings_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        f"user_id * 10 + {SENSOR_CODE} as sensor_id",
        f"{LOCATION} as location_name",
        f"{PARAMETER} as parameter",
        f"{LAT} as lat",
        f"{LON} as lon",
        "value",
        "'ug/m3' as unit",
        f"{UTC_TEXT} as date_utc",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings_of(table(spark, sf_dir, "events"))


def sensor_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One location document per user, holding one sensor for each of its event types (five at most)."""
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.collect_set("event_type").alias("types"))
    sensor = f"""named_struct('id', user_id * 10 + {SENSOR_CODE},
        'parameter', named_struct('name', {PARAMETER}, 'units', 'ug/m3'))"""
    return users.selectExpr(
        f"""array(named_struct('name', {LOCATION},
            'coordinates', named_struct('latitude', {LAT}, 'longitude', {LON}),
            'sensors', transform(types, event_type -> {sensor}))) as results"""
    )


def day_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document with one reading per event."""
    utc = f"named_struct('utc', {UTC_TEXT})"
    period = f"named_struct('datetimeFrom', {utc}, 'datetimeTo', {utc})"
    return table(spark, sf_dir, "events").selectExpr(
        f"user_id * 10 + {SENSOR_CODE} as sensor_id",
        f"array(named_struct('value', value, 'period', {period})) as results",
    )


def silver_aq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_air_quality(readings(spark, sf_dir))


def aq_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_aq_daily(silver_aq(spark, sf_dir), unique=True)


def fx_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rate per order priority and day: the mean price in 100,000; none on weekends."""
    keys = [F.expr("o_orderpriority as CURRENCY"), F.expr("cast(o_orderdate as date) as day")]
    daily = exact_aggregate(table(spark, sf_dir, "orders"), keys, {"total": "o_totalprice"}, also={"n": "count(*)"})
    return daily.selectExpr(
        "date_format(day, 'yyyy-MM-dd') as TIME_PERIOD",
        "CURRENCY",
        "if(dayofweek(day) in (1, 7), null, total / n / 1e5D) as OBS_VALUE",
    )


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dim_fx(fx_rows(spark, sf_dir))


def gdp_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GDP rows by nation and year. Orders are summed per customer and year before the first join."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    spent = exact_aggregate(
        table(spark, sf_dir, "orders"), ["o_custkey", F.year("o_orderdate").alias("y")], {"spent": "o_totalprice"}
    )
    with_nation = spent.join(customer, spent["o_custkey"] == customer["c_custkey"])
    by_nation = exact_aggregate(with_nation, ["c_nationkey", "y"], {"value": "spent"})
    return by_nation.join(nation, by_nation["c_nationkey"] == nation["n_nationkey"]).selectExpr(
        "named_struct('id', cast(n_nationkey as string), 'value', n_name) as country",
        "named_struct('id', 'NY.GDP.MKTP.CD', 'value', 'GDP (current US$)') as indicator",
        "concat('N', lpad(n_nationkey, 2, '0')) as countryiso3code",
        "cast(y as string) as date",
        "value",
        "cast(null as string) as obs_status",
    )


def forecast_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document of two steps per event; empty for a signup, and without weather for an error."""

    def step(hours: int) -> str:
        return f"""named_struct(
            'dt', unix_timestamp(ts) + {3600 * hours},
            'main', named_struct('temp', value + {hours}, 'feels_like', value - {hours},
                                 'humidity', k, 'pressure', k + 1000),
            'weather', slice(array(named_struct('description', event_type)), 1, if(event_type = 'error', 0, 1)),
            'wind', named_struct('speed', value / 2))"""

    # The property is read once, in a projection of its own, and used four times.
    events = table(spark, sf_dir, "events").selectExpr(
        "event_id", "ts", "value", "event_type", "cast(get_json_object(props, '$.k') as bigint) as k"
    )
    return events.selectExpr(
        "event_id as doc_id",
        f"slice(array({step(0)}, {step(3)}), 1, if(event_type = 'signup', 0, 2)) as list",
    )


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weather_forecast(forecast_documents(spark, sf_dir), RUN_TS)


def taxi_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_taxi_daily(trips(spark, sf_dir))


def model(spark: SparkSession, sf_dir: str, with_fx: bool = False) -> CityModel:
    return CityModel(
        taxi=taxi_fact(spark, sf_dir).withColumnRenamed("pickup_location_id", "pickup_zone_id"),
        dates=dates(spark),
        zones=zones(spark, sf_dir),
        fx=fx(spark, sf_dir) if with_fx else None,
    )


def slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per return flag and ship month, with what became of that month's file.

    A slot that has yellow trips has landed, except in July; nothing was published for November.
    """
    found = (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            F.expr("l_returnflag as taxi_type"),
            F.expr("trunc(cast(l_shipdate as date), 'month') as first_day"),
        )
        .agg(F.expr(f"bool_or({YELLOW}) as has_yellow"))
    )
    return found.selectExpr(
        "taxi_type",
        "first_day",
        "cast(year(first_day) as string) as year",
        "lpad(month(first_day), 2, '0') as month",
        "has_yellow and month(first_day) not in (7, 11) as landed",
        "month(first_day) <> 11 as available",
    )
