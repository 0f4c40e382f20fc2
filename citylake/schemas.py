"""Schemas of sources and tables, and the check that guards an overwrite."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Pollutant columns of the wide air-quality table, and their names in the daily fact.
PARAMETERS = ["pm25", "no2", "o3", "co", "so2", "pm10", "temperature"]
AQ_METRICS = {
    "pm25": "avg_pm25",
    "no2": "avg_no2",
    "o3": "avg_o3",
    "co": "avg_co",
    "so2": "avg_so2",
    "pm10": "avg_pm10",
    "temperature": "avg_temp",
}
MAJOR_POLLUTANTS = ["avg_pm25", "avg_no2", "avg_o3"]

INT, LONG, DOUBLE, STRING, DATE = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType(), T.DateType()
TIMESTAMP, LOCAL_TIME = T.TimestampType(), T.TimestampNTZType()


def struct(**fields: T.DataType) -> T.StructType:
    """Nullable fields in the order given."""
    return T.StructType([T.StructField(name, data_type) for name, data_type in fields.items()])


TRIP = struct(
    VendorID=LONG,
    tpep_pickup_datetime=LOCAL_TIME,
    tpep_dropoff_datetime=LOCAL_TIME,
    lpep_pickup_datetime=LOCAL_TIME,
    lpep_dropoff_datetime=LOCAL_TIME,
    passenger_count=DOUBLE,
    trip_distance=DOUBLE,
    PULocationID=INT,
    DOLocationID=INT,
    fare_amount=DOUBLE,
    tip_amount=DOUBLE,
    total_amount=DOUBLE,
    payment_type=LONG,
    trip_type=LONG,
    RatecodeID=DOUBLE,
    airport_fee=DOUBLE,
    ehail_fee=DOUBLE,
)

ZONE_CSV = struct(LocationID=INT, Borough=STRING, Zone=STRING, service_zone=STRING)

SENSOR_LOCATIONS = struct(
    results=T.ArrayType(
        struct(
            name=STRING,
            coordinates=struct(latitude=DOUBLE, longitude=DOUBLE),
            sensors=T.ArrayType(struct(id=LONG, parameter=struct(name=STRING, units=STRING))),
        )
    )
)

SENSOR_DAYS = struct(
    sensor_id=LONG,
    results=T.ArrayType(
        struct(
            value=DOUBLE,
            period=struct(datetimeFrom=struct(utc=STRING), datetimeTo=struct(utc=STRING)),
        )
    ),
)

GDP_ROW = struct(
    country=struct(id=STRING, value=STRING),
    indicator=struct(id=STRING, value=STRING),
    countryiso3code=STRING,
    date=STRING,
    value=DOUBLE,
    obs_status=STRING,
)

FORECAST = struct(
    list=T.ArrayType(
        struct(
            dt=LONG,
            main=struct(temp=DOUBLE, feels_like=DOUBLE, humidity=LONG, pressure=LONG),
            weather=T.ArrayType(struct(description=STRING)),
            wind=struct(speed=DOUBLE),
        )
    )
)

DIM_ZONE = struct(location_id=INT, borough=STRING, zone_name=STRING, service_zone=STRING)
DIM_DATE = struct(date_key=DATE, year=INT, month=INT, month_name=STRING, day_name=STRING, is_weekend=INT)
DIM_GDP = struct(
    country_name=STRING,
    countryiso3code=STRING,
    indicator_name=STRING,
    gdp_year=INT,
    gdp_value=DOUBLE,
    obs_status=STRING,
)
DIM_FX = struct(fx_date=DATE, CURRENCY=STRING, exchange_rate_to_eur=DOUBLE)
SILVER_AQ = struct(
    location_name=STRING, reading_date=DATE, lat=DOUBLE, lon=DOUBLE, **{p: DOUBLE for p in PARAMETERS}
)
FACT_AQ = struct(
    reading_date=DATE, location_name=STRING, lat=DOUBLE, lon=DOUBLE, **{m: DOUBLE for m in AQ_METRICS.values()}
)
WEATHER = struct(
    forecast_time=TIMESTAMP,
    temperature=DOUBLE,
    feels_like=DOUBLE,
    humidity=LONG,
    pressure=LONG,
    condition=STRING,
    wind_speed=DOUBLE,
    ingested_at=TIMESTAMP,
)

# How the model summarises a numeric column unless told otherwise. Columns that are not
# listed are grouping attributes.
DEFAULT_SUMMARY = {
    "year": "sum",
    "month": "sum",
    "is_weekend": "sum",
    "exchange_rate_to_eur": "sum",
    "gdp_year": "sum",
    "gdp_value": "sum",
    "lat": "sum",
    "lon": "sum",
    "avg_pm25": "sum",
    "avg_no2": "sum",
    "avg_o3": "sum",
    "avg_co": "sum",
    "avg_so2": "sum",
    "avg_pm10": "sum",
    "avg_temp": "sum",
    "total_trips": "sum",
    "daily_revenue_usd": "sum",
    "avg_trip_distance": "sum",
    "temperature": "sum",
    "feels_like": "sum",
    "humidity": "sum",
    "pressure": "sum",
    "wind_speed": "sum",
}


class SchemaMismatch(ValueError):
    """Rows do not have the columns a table requires."""


def enforce_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; raises on a missing, extra or unrelated one.

    Widening (int to bigint, date to timestamp, ...) is done; a change that can lose values is refused,
    so the mismatch shows when the plan is built and not as NULLs in the table.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in schema.fields}
    missing = [n for n in want if n not in have]
    extra = [n for n in have if n not in want]
    if missing or extra:
        raise SchemaMismatch(f"missing columns {missing}, unexpected columns {extra}")
    wrong = [
        f"{n}: {have[n].simpleString()} is not {want[n].simpleString()}"
        for n in want
        if not _widens(have[n], want[n])
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return df.select([F.col(n).cast(t).alias(n) for n, t in want.items()])


_INTEGRAL = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def _widens(source: T.DataType, target: T.DataType) -> bool:
    if source == target or isinstance(source, T.NullType):
        return True
    if type(source) in _INTEGRAL and type(target) in _INTEGRAL:
        return _INTEGRAL.index(type(source)) <= _INTEGRAL.index(type(target))
    if isinstance(target, T.DoubleType):
        return isinstance(source, (T.FloatType, T.ByteType, T.ShortType, T.IntegerType))
    if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
        return isinstance(source, _MOMENTS)
    return False
