"""Scalar and aggregate column expressions shared by the layers.

Spark 4 runs with ANSI on, where a bad cast, a bad date text, an index past the end of an array and a
division by zero all raise. The helpers below give NULL instead, as the data model asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_of(*cols: Column | str) -> Column:
    """First non-null of several variants of the same column."""
    return F.coalesce(*[_col(c) for c in cols])


def cast_to(c: Column | str, data_type: str) -> Column:
    """Cast that gives NULL for a value that does not fit."""
    return _col(c).try_cast(data_type)


def as_date(c: Column | str) -> Column:
    """Calendar date of a timestamp or of ISO text; NULL for text that is no date."""
    return _col(c).try_cast("date")


def duration_minutes(start: Column | str, end: Column | str) -> Column:
    """Minutes between two timestamps, counted in whole seconds."""
    return (F.unix_timestamp(_col(end)) - F.unix_timestamp(_col(start))) / 60


def is_weekend(c: Column | str) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return F.when(F.dayofweek(_col(c)).isin(1, 7), F.lit(1)).otherwise(F.lit(0))


def array_at(c: Column | str, index: int) -> Column:
    """Element of an array, NULL when the array is too short."""
    return F.get(_col(c), F.lit(index))


def first_element(c: Column | str) -> Column:
    """First element of an array, NULL when it is empty."""
    return array_at(c, 0)


def nan_to_null(c: Column | str) -> Column:
    """NaN is a value to Spark and would be carried forward by a fill; make it NULL."""
    return F.when(~F.isnan(_col(c)), _col(c))


def rate(part: Column | str, whole: Column | str) -> Column:
    """Quotient, NULL when the divisor is zero or NULL."""
    if isinstance(part, str) and isinstance(whole, str):
        return F.expr(f"try_divide(cast({part} as double), {whole})")
    return F.try_divide(_col(part).cast("double"), _col(whole))


def avg_or_zero(df: DataFrame, column: str, alias: str) -> Column:
    """Average of a column that only some inputs have; 0.0 where it is absent."""
    if column in df.columns:
        return exact_avg(column).alias(alias)
    return F.lit(0.0).alias(alias)


def exact_sum(amount: str) -> Column:
    """Sum (double) of amounts, a column or SQL expression, that does not depend on the order in which rows arrive.

    Adding doubles in another order changes the last digits, so a retried task could change a revenue. An amount is
    taken apart at powers of two, which is exact: multiples of 2^20, units, multiples of 2^-20, and what is
    left. The first three are summed as longs (9e12 rows in one group), the rest as a double; of a total above 1e-6
    it reaches no digit. Amounts of 2^40 and more, NaN and the infinities go to the last sum whole, so they
    come out as in ``sum``; without any amount the sum is NULL. Decimals are summed as decimals.
    """
    a = f"({amount})"
    x = f"cast({a} as double)"
    high = f"cast({x} / 1048576D as bigint)"
    rest = f"({x} - {high} * 1048576D)"
    unit = f"cast({rest} as bigint)"
    low = f"cast(({rest} - {unit}) * 1048576D as bigint)"
    left = f"({rest} - {unit} - {low} / 1048576D)"
    # The type is known when the plan is optimised, so the branch that does not apply costs nothing.
    decimal, small = f"typeof({a}) like 'decimal%'", f"abs({x}) < 1099511627776D"
    limb = lambda part: f"sum(case when {a} is null then null when {decimal} or not {small} then 0L else {part} end)"
    return F.expr(
        f"""cast(cast({limb(high)} as decimal(19,0)) * 1048576BD + {limb(unit)} + {limb(low)} div 1048576L as double)
            + ({limb(low)} % 1048576L / 1048576D
               + sum(case when {decimal} then 0D when {small} then {left} else {x} end)
               + coalesce(cast(sum(case when {decimal} then {a} end) as double), 0D))"""
    )


def exact_avg(amount: str) -> Column:
    """Average by ``exact_sum``; NULL without an amount."""
    return F.try_divide(exact_sum(amount), F.expr(f"count({amount})"))


def pad2(c: Column | str) -> Column:
    """Two-digit text of a small number, e.g. a month."""
    return F.lpad(_col(c).cast("string"), 2, "0")


def percent_text(c: Column | str, digits: int = 4) -> Column:
    """Fraction as percent text, e.g. 0.0123 -> '1.2300%'."""
    return F.concat(F.format_number(_col(c) * F.lit(100), digits), F.lit("%"))


def slot_path_text(taxi_type: Column | str, year: Column | str, month: Column | str) -> Column:
    """Landing folder of a slot as text."""
    return F.format_string("%s/%04d/%02d", _col(taxi_type), cast_to(year, "int"), cast_to(month, "int"))
