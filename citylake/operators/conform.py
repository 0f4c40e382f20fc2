"""Renaming, typing, filtering and flattening: what turns landed rows into conformed ones."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions import cast_to, duration_minutes


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename columns; all others stay."""
    return df.withColumnsRenamed(dict(mapping))


def tag(df: DataFrame, name: str, value: object) -> DataFrame:
    """Constant column."""
    return df.withColumn(name, F.lit(value))


def with_audit(
    df: DataFrame, run_ts: dt.datetime | None, source: str, column: str = "source_file", **tags: object
) -> DataFrame:
    """Load time, source and constant tags. ``run_ts=None`` takes the wall clock."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    added: dict[str, Column] = {"ingestion_timestamp": stamp, column: F.lit(source)}
    added.update({name: F.lit(value) for name, value in tags.items()})
    return df.withColumns(added)


def cast_all(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns in place; a value that does not fit becomes NULL."""
    return df.withColumns({name: cast_to(name, t) for name, t in types.items() if name in df.columns})


def union_conformed(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, matched by column name; absent columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def keep_any_not_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the columns has a value."""
    return df.filter(F.coalesce(*[F.col(c) for c in cols]).isNotNull())


def flatten(df: DataFrame, paths: Mapping[str, str | Column]) -> DataFrame:
    """Project struct paths (or expressions) to top-level columns."""
    return df.select(
        *[(F.col(p) if isinstance(p, str) else p).alias(name) for name, p in paths.items()]
    )


def explode_rows(df: DataFrame, column: str, alias: str | None = None, keep_empty: bool = False) -> DataFrame:
    """One row per array element; ``keep_empty`` keeps a row for a null or empty array."""
    generate = F.explode_outer if keep_empty else F.explode
    others = [F.col(c) for c in df.columns if c != column]
    return df.select(*others, generate(column).alias(alias or column))


def in_bbox(
    df: DataFrame, west: float, south: float, east: float, north: float, lat: str = "lat", lon: str = "lon"
) -> DataFrame:
    """Rows inside a box, edges included."""
    return df.filter(F.col(lon).between(west, east) & F.col(lat).between(south, north))


def trailing_days(df: DataFrame, column: str, days: int, as_of: dt.date | str) -> DataFrame:
    """Rows of the last ``days`` days before ``as_of``; the bound is a literal, so it reaches the scan."""
    as_of = dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of
    return df.filter(F.col(column) >= F.lit(as_of - dt.timedelta(days=days)))


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the first by ``order_by`` (all other columns by default).

    An aggregate and not a ranked window: copies of one key are reduced in the map tasks, so a key that
    holds a large part of the rows never meets in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    order = list(order_by) if order_by else rest
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    kept = df.groupBy(*keys).agg(first)
    return kept.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])


def valid_trips(df: DataFrame) -> DataFrame:
    """Trips with a distance, an amount, and an end after the start; a NULL in any of them drops the row."""
    return df.where("trip_distance > 0 and total_amount > 0 and pickup_datetime < dropoff_datetime")


# Types of the conformed trip columns that drift between files.
TRIP_CASTS = {
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "total_amount": "double",
    "tip_amount": "double",
    "payment_type": "int",
    "trip_type": "int",
    "RatecodeID": "int",
}


def conform_trips(bronze: DataFrame, run_ts: dt.datetime | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Valid trips of every taxi type with one set of names and types, and the duration.

    Columns that only some inputs have (``tip_amount`` and others) are kept when present; ``keep`` names further ones.
    """
    have = set(bronze.columns)

    def variants(*names: str) -> str:
        found = [n for n in names if n in have]
        if not found:
            raise ValueError(f"no column of {', '.join(names)}")
        return f"coalesce({', '.join(found)})"

    picked = {
        "VendorID": "VendorID",
        "taxi_type": "taxi_type",
        "pickup_datetime": variants("tpep_pickup_datetime", "lpep_pickup_datetime"),
        "dropoff_datetime": variants("tpep_dropoff_datetime", "lpep_dropoff_datetime"),
        "pickup_location_id": "PULocationID",
        "dropoff_location_id": "DOLocationID",
    }
    picked.update({name: f"try_cast({name} as {t})" for name, t in TRIP_CASTS.items() if name in have})
    picked.update({name: f"`{name}`" for name in keep if name not in picked})
    trips = valid_trips(bronze.selectExpr(*[f"{text} as {name}" for name, text in picked.items()]))
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    return trips.withColumns(
        {
            "trip_duration_minutes": duration_minutes("pickup_datetime", "dropoff_datetime"),
            "silver_processing_time": stamp,
        }
    )
