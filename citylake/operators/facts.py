"""Daily facts and the long-to-wide pivot."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.functions import as_date
from citylake.operators.conform import keep_any_not_null
from citylake.operators.exact import average, exact_aggregate, partial_states, total
from citylake.schemas import AQ_METRICS, DEFAULT_SUMMARY, MAJOR_POLLUTANTS, PARAMETERS


def fact_taxi_daily(trips: DataFrame) -> DataFrame:
    """Trips, revenue and averages per day, pickup zone and taxi type."""
    return taxi_fact_of(taxi_states(trips))


# Key of the daily fact.
TAXI_KEY = ["pickup_date", "pickup_location_id", "taxi_type"]


def taxi_states(trips: DataFrame, slot: Sequence[str] = ()) -> DataFrame:
    """Mergeable states of the daily fact by its key, and by the slot that the trips were loaded from."""
    amounts = {"revenue": "total_amount", "distance": "trip_distance"}
    if "tip_amount" in trips.columns:
        amounts["tip"] = "tip_amount"
    dated = trips.withColumn("pickup_date", F.to_date("pickup_datetime"))
    return partial_states(dated, [*TAXI_KEY, *[c for c in slot if c not in TAXI_KEY]], amounts, {"total_trips": "count(1)"})


def taxi_fact_of(states: DataFrame, keys: Sequence[str] = TAXI_KEY) -> DataFrame:
    """The daily fact that states stand for; they have one row per key."""
    tip = average(states, "tip") if "tip__n" in states.columns else F.lit(0.0)
    return states.select(
        *keys, "total_trips", total(states, "revenue").alias("daily_revenue_usd"),
        average(states, "distance").alias("avg_trip_distance"), tip.alias("avg_tip_amount"),
    )


def taxi_daily_by_zone(fact: DataFrame, also_by: Sequence[str] = ()) -> DataFrame:
    """The daily fact without taxi type, under the column names the measures use; ``also_by`` names columns that day and
    zone determine."""
    sums = {"daily_revenue_usd": "daily_revenue_usd", "weighted": "avg_trip_distance * total_trips"}
    named = fact.withColumnRenamed("pickup_location_id", "pickup_zone_id")
    found = exact_aggregate(named, ["pickup_date", "pickup_zone_id", *also_by], sums, also={"total_trips": "sum(total_trips)"})
    return found.withColumn("avg_trip_distance", F.try_divide("weighted", "total_trips")).drop("weighted")


def pivot_parameters(
    readings: DataFrame,
    values: Sequence[str] = tuple(PARAMETERS),
    keys: Sequence[str] = ("location_name", "reading_date", "lat", "lon"),
) -> DataFrame:
    """Long readings to one column per parameter, averaged.

    The value list is given, so no job has to look for it, a parameter without readings still has its
    column, and all columns are conditional averages of one aggregation: one shuffle, after the map side
    has combined.
    """
    cells = {f"_cell_{k}": F.when(F.col("parameter") == v, F.col("value")) for k, v in enumerate(values)}
    wide = readings.select(*keys, *[c.alias(cell) for cell, c in cells.items()])
    return exact_aggregate(wide, keys, averages=dict(zip(values, cells)))


def silver_air_quality(
    readings: DataFrame, date_field: str = "date_utc", drop_copies: bool = False
) -> DataFrame:
    """Wide air-quality table by location and day.

    A reading belongs to the day of ``date_field``, the end of its period. Copies count towards the
    average unless ``drop_copies`` removes rows that are equal in every column first.
    """
    rows = readings.dropDuplicates() if drop_copies else readings
    return pivot_parameters(rows.withColumn("reading_date", as_date(date_field)))


def fact_aq_daily(wide: DataFrame, metrics: Mapping[str, str] = AQ_METRICS, unique: bool = False) -> DataFrame:
    """Average pollutants per day and place; rows with none of the major ones are left out.

    With ``unique`` the rows have one per day and place already, as :func:`silver_air_quality` makes them: a value is its
    own average, and nothing is shuffled again.
    """
    keys = ["reading_date", "location_name", "lat", "lon"]
    if unique:
        doubles = [F.col(source).cast("double").alias(name) for source, name in metrics.items()]
        return keep_any_not_null(wide.select(*keys, *doubles), MAJOR_POLLUTANTS)
    fact = exact_aggregate(wide, keys, averages={name: source for source, name in metrics.items()})
    return keep_any_not_null(fact, MAJOR_POLLUTANTS)


def summarize(df: DataFrame, by: Sequence[str] | str, cols: Sequence[str] | None = None) -> DataFrame:
    """Default summary of numeric columns by category, as the model declares it."""
    keys = [by] if isinstance(by, str) else list(by)
    chosen = list(cols) if cols else [c for c in df.columns if c in DEFAULT_SUMMARY and c not in keys]
    unknown = [c for c in chosen if c not in DEFAULT_SUMMARY]
    if unknown:
        raise ValueError(f"columns without a default summary: {unknown}")
    types = dict(df.dtypes)
    doubles = [c for c in chosen if types[c] == "double"]
    found = exact_aggregate(df, keys, {c: c for c in doubles}, also={c: f"sum({c})" for c in chosen if c not in doubles})
    return found.select(*keys, *chosen)
