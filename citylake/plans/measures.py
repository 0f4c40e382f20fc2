"""Measures: aggregates that are evaluated anew at each grouping level.

A filter or grouping attribute reaches a table only along the star's many-to-one relations:

=============== ========= ======== =====
attribute of    taxi fact AQ fact  rates
=============== ========= ======== =====
date dimension  yes       yes      yes
zone dimension  yes       no       no
=============== ========= ======== =====

A table that an attribute does not reach gives its whole value to every member.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.functions import rate
from citylake.operators.exact import average, exact_aggregate, partial_states, rolled_up, total
from citylake.operators.joins import with_dim

DATE_ATTRS = ("date_key", "year", "month", "month_name", "day_name", "is_weekend")
ZONE_ATTRS = ("location_id", "borough", "zone_name", "service_zone")

# A filter value is a constant, a list of constants, or a predicate over the column.
Filters = Mapping[str, Any]


def _predicate(name: str, wanted: Any) -> Column:
    column = F.col(name)
    if callable(wanted):
        return wanted(column)
    if isinstance(wanted, (list, tuple, set)):
        return column.isin(list(wanted))
    return column.isNull() if wanted is None else column == wanted


def _filtered(df: DataFrame, where: Filters, names: Sequence[str]) -> DataFrame:
    return reduce(lambda d, n: d.filter(_predicate(n, where[n])), [n for n in names if n in where], df)


@dataclass(frozen=True)
class CityModel:
    """The star: the daily taxi fact, its two dimensions, and the exchange rates.

    ``taxi`` has ``pickup_date``, ``pickup_zone_id``, ``total_trips`` and ``daily_revenue_usd``; it may be
    finer, e.g. by taxi type, since measures add it up anyway.
    """

    taxi: DataFrame
    dates: DataFrame
    zones: DataFrame
    fx: DataFrame | None = None
    weather: DataFrame | None = None

    def _taxi_rows(self, by: Sequence[str], where: Filters | None) -> DataFrame:
        """Rows of the fact, reduced where possible, with the attributes ``by``.

        When only one of the fact's two foreign keys is in use, the fact is first reduced to that key: the
        join then sees one row per day or zone, and a busy zone is combined on the map side. With both
        keys in use, the days are joined first (the calendar is small), and what is shuffled into the zone
        join is one row per zone and combination of the days' attributes.
        """
        where = where or {}
        used = [*by, *[n for n in where if n not in by]]
        date_attrs = [n for n in used if n in DATE_ATTRS]
        zone_attrs = [n for n in used if n in ZONE_ATTRS]
        own = [n for n in used if n not in DATE_ATTRS and n not in ZONE_ATTRS]
        unknown = [n for n in own if n not in self.taxi.columns]
        if unknown:
            raise ValueError(f"no such attributes: {unknown}")

        keys = list(own)
        keys += ["pickup_date"] if date_attrs and "pickup_date" not in keys else []
        keys += ["pickup_zone_id"] if zone_attrs and "pickup_zone_id" not in keys else []
        # A fact that is partitioned by month is joined by it too, so that a filter on days prunes its files at run time.
        by_month = ["pickup_month"] if date_attrs and "pickup_month" in self.taxi.columns else []
        keys += [c for c in by_month if c not in keys]
        rows = _filtered(self.taxi, where, own)
        if bool(date_attrs) != bool(zone_attrs):
            rows = _totals(rows, keys)
        if date_attrs:
            rows = with_dim(rows, self.dates, "pickup_date", "date_key", date_attrs, by_month)
        if date_attrs and zone_attrs:
            rows = _filtered(rows, where, date_attrs)
            reached = [n for n in by if n in date_attrs]
            rows = _totals(rows, list(dict.fromkeys([*own, *reached, "pickup_zone_id"])))
            date_attrs = []
        if zone_attrs:
            rows = with_dim(rows, self.zones, "pickup_zone_id", "location_id", zone_attrs)
        return _filtered(rows, where, [*date_attrs, *zone_attrs])

    def taxi_totals(self, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
        """Revenue and trips by any attributes the taxi fact can be reached from."""
        return _totals(self._taxi_rows(by, where), list(by))

    def taxi_levels(self, by: Sequence[str], where: Filters | None = None) -> DataFrame:
        """As :func:`taxi_totals` at every level: all attributes, all but the last, and so on to none.

        The fact is read and joined once, the finest level is reduced to states, and coarser levels are merged from
        those. ``level`` is the number of attributes a row is by; the others are NULL in it.
        """
        states = partial_states(self._taxi_rows(by, where), list(by), _REVENUE, _TRIPS)
        levels = rolled_up(states, list(by), list(_REVENUE), list(_TRIPS))
        return levels.select(*by, "level", "total_trips", total(levels, "daily_revenue_usd").alias("daily_revenue_usd"))

    def _rate_rows(self, by: Sequence[str], where: Filters | None) -> DataFrame:
        if self.fx is None:
            raise ValueError("the model has no exchange rates")
        where = where or {}
        used = list(dict.fromkeys([*by, *[n for n in where if n in DATE_ATTRS]]))
        rows = with_dim(self.fx, self.dates, "fx_date", "date_key", used) if used else self.fx
        return _filtered(rows, where, used)

    def average_rate(self, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
        """Average exchange rate by date attributes."""
        return exact_aggregate(self._rate_rows(by, where), list(by), averages={"average_rate": "exchange_rate_to_eur"})

    def avg_fare(self, by: Sequence[str] = (), where: Filters | None = None, totals: bool = False) -> DataFrame:
        """Revenue per trip: a ratio of sums, NULL without trips. ``totals`` adds every coarser level, told by ``level``."""
        found = self.taxi_levels(by, where) if totals else self.taxi_totals(by, where)
        level = ["level"] if totals else []
        return found.select(*by, *level, rate("daily_revenue_usd", "total_trips").alias("avg_fare"))

    def revenue_eur(
        self, by: Sequence[str] = (), where: Filters | None = None, mode: str = "multiply", totals: bool = False
    ) -> DataFrame:
        """Sum of revenue and average of rates, each in its own filter context, then combined.

        ``multiply`` is how the measure is defined. The rates are dollars per euro, so ``divide`` is the
        economic conversion. Not additive: a total is not the sum of its groups, so with ``totals`` each coarser level is
        evaluated for itself.
        """
        both = self.revenue_and_rate_levels(by, where) if totals else self.revenue_and_rate(by, where)
        combine: dict[str, Callable[[], Column]] = {
            "multiply": lambda: F.col("revenue_usd") * F.col("average_rate"),
            "divide": lambda: rate("revenue_usd", "average_rate"),
        }
        if mode not in combine:
            raise ValueError(f"mode is one of {list(combine)}")
        return both.select(*by, *(["level"] if totals else []), combine[mode]().alias("revenue_eur"))

    def revenue_and_rate(self, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
        """``revenue_usd`` and ``average_rate`` by group."""
        revenue = self.taxi_totals(by, where).withColumnRenamed("daily_revenue_usd", "revenue_usd")
        reached = [n for n in by if n in DATE_ATTRS]
        rates = self.average_rate(reached, where)
        if not reached:
            # One value for all groups: a scalar subquery, no join.
            return revenue.select(*by, "revenue_usd", rates.scalar().alias("average_rate"))
        return _beside(revenue, rates, reached).select(*by, "revenue_usd", "average_rate")

    def revenue_and_rate_levels(self, by: Sequence[str], where: Filters | None = None) -> DataFrame:
        """``level``, ``revenue_usd`` and ``average_rate`` at every level of ``by``; both sides are rolled up from states.

        A level of the revenue meets the rates at the level of the date attributes it is by.
        """
        reached = [n for n in by if n in DATE_ATTRS]
        revenue = self.taxi_levels(by, where).withColumnRenamed("daily_revenue_usd", "revenue_usd")
        by_rate = [sum(n in reached for n in by[:level]) for level in range(len(by) + 1)]
        revenue = revenue.withColumn("rate_level", F.element_at(F.array(*map(F.lit, by_rate)), F.col("level").cast("int") + 1))
        states = partial_states(self._rate_rows(reached, where), reached, {"rate": "exchange_rate_to_eur"})
        rates = rolled_up(states, reached, ["rate"])
        rates = rates.select(*reached, F.col("level").alias("rate_level"), average(rates, "rate").alias("average_rate"))
        return _beside(revenue, rates, [*reached, "rate_level"]).select(*by, "level", "revenue_usd", "average_rate")

    def latest(self, column: str, by: Sequence[str] = (), where: Filters | None = None) -> DataFrame:
        """A forecast column at the latest forecast time. The forecast has no relations, only own columns."""
        if self.weather is None:
            raise ValueError("the model has no forecast")
        where = where or {}
        rows = _filtered(self.weather, where, list(where))
        return latest_value(rows, "forecast_time", column, by).drop("latest_time")


# What the taxi fact adds up.
_REVENUE, _TRIPS = {"daily_revenue_usd": "daily_revenue_usd"}, {"total_trips": "sum(total_trips)"}


def _totals(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return exact_aggregate(rows, list(keys), _REVENUE, also=_TRIPS)


def _beside(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join by attributes. Dates outside the calendar form the blank member on both sides, and blanks match."""
    renamed = right.withColumnsRenamed({n: f"_r_{n}" for n in keys})
    same = reduce(lambda a, b: a & b, [F.col(n).eqNullSafe(F.col(f"_r_{n}")) for n in keys])
    return left.join(renamed, same, "left")


def measure(
    model: CityModel, name: str, by: Sequence[str] = (), where: Filters | None = None, **options: Any
) -> DataFrame:
    """Evaluate a measure by name."""
    measures: dict[str, Callable[..., DataFrame]] = {
        "avg_fare": model.avg_fare,
        "revenue_eur": model.revenue_eur,
        "latest_temperature": partial(model.latest, "temperature"),
        "latest_humidity": partial(model.latest, "humidity"),
        "latest_condition": partial(model.latest, "condition"),
    }
    if name not in measures:
        raise ValueError(f"measure is one of {list(measures)}")
    return measures[name](by=by, where=where, **options)


def latest_value(
    df: DataFrame, time: str, column: str | Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """Value at the latest time of each group, if the rows of that time agree on one, else NULL.

    NULL counts as a value, so a NULL beside a value is a disagreement. Columns are ``latest_time`` and
    ``latest_<column>``.

    One aggregation, combined on the map side and without a join back to the maximum: among rows ordered
    by time and value the greatest has the latest time and its largest value; ordered by reversed time
    and value, the least has the latest time and its smallest value. The two agree when there is one.
    """
    columns = [column] if isinstance(column, str) else list(column)
    at = F.unix_micros(F.col(time).cast("timestamp"))
    timed = F.col(time).isNotNull()
    aggregates = [F.max(time).alias("latest_time")]
    for c in columns:
        largest = F.struct(at.alias("at"), F.col(c).alias("v"))
        smallest = F.struct((-at).alias("at"), F.col(c).alias("v"))
        aggregates.append(F.max(F.when(timed, largest)).alias(f"_hi_{c}"))
        aggregates.append(F.min(F.when(timed, smallest)).alias(f"_lo_{c}"))
    found = df.groupBy(*by).agg(*aggregates)
    values = [
        F.when(F.col(f"_hi_{c}.v").eqNullSafe(F.col(f"_lo_{c}.v")), F.col(f"_hi_{c}.v")).alias(f"latest_{c}")
        for c in columns
    ]
    return found.select(*by, "latest_time", *values)
