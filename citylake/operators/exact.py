"""Sums and averages of doubles that do not depend on the order of rows, by way of states that can be merged.

An amount is taken apart once per row, at powers of two, which is exact: multiples of 2^20, units, multiples of 2^-20 and
what is left. A state holds the sums of the four parts and the number of amounts, as plain columns. States of disjoint sets of
rows add up to the state of all of them, so they can be stored, and a coarser level is merged from a finer one.

What is promised: amounts that are multiples of 2^-20 and below 2^40 give their true sum, rounded once (9e12 rows in one
group). Others leave a rest below 2^-20 each, and the rests are added as doubles. Amounts of 2^40 and more, NaN and
the infinities are added with the rests, so they come out as in ``sum``. Decimals are added as decimals. Without any amount the sum
and the average are NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTS = ("high", "unit", "low", "rest")

Keys = Sequence[str | Column]


def _decimals(df: DataFrame, amounts: Mapping[str, str]) -> list[str]:
    """Names of the amounts that are decimals."""
    typed = df.selectExpr(*amounts.values()).schema if amounts else []
    return [n for n, f in zip(amounts, typed) if isinstance(f.dataType, T.DecimalType)]


# An amount's parts, step by step; an amount of 2^40 and more, or no number, is left whole in ``x - y``.
_STEPS = [
    {"x": "cast(({a}) as double)"},
    {
        "y": "if(abs(`{n}__x`) >= 1099511627776D, 0D, `{n}__x`)",
        "high": "cast(if(abs(`{n}__x`) >= 1099511627776D, 0D, `{n}__x`) / 1048576D as bigint)",
    },
    {"fine": "`{n}__y` - `{n}__high` * 1048576D", "unit": "cast(`{n}__y` - `{n}__high` * 1048576D as bigint)"},
    {"low": "cast((`{n}__fine` - `{n}__unit`) * 1048576D as bigint)"},
]
_SUMS = {
    "high": "sum(`{n}__high`)",
    "unit": "sum(`{n}__unit`)",
    "low": "sum(`{n}__low`)",
    "rest": "sum(`{n}__fine` - `{n}__unit` - `{n}__low` / 1048576D + (`{n}__x` - `{n}__y`))",
    "n": "count(`{n}__x`)",
}


def _taken_apart(df: DataFrame, amounts: Mapping[str, str]) -> DataFrame:
    """``df`` with the parts of every amount as columns, each computed once from the one before."""
    for step in _STEPS if amounts else []:
        df = df.selectExpr("*", *[f"{text.format(a=a, n=n)} as `{n}__{p}`" for n, a in amounts.items() for p, text in step.items()])
    return df


def partial_states(df: DataFrame, keys: Keys, amounts: Mapping[str, str], also: Mapping[str, str] | None = None) -> DataFrame:
    """One row per key with the state of every amount (a column or SQL expression), and ``also``: aggregates that can
    themselves be added up, such as counts."""
    decimals = _decimals(df, amounts)
    rows = _taken_apart(df, {n: a for n, a in amounts.items() if n not in decimals})
    sums = [F.expr(text).alias(n) for n, text in (also or {}).items()]
    for n, a in amounts.items():
        if n in decimals:
            sums += [F.sum(F.expr(a)).alias(f"{n}__dec"), F.count(F.expr(a)).alias(f"{n}__n")]
        else:
            sums += [F.expr(f"{text.format(n=n)} as `{n}__{p}`") for p, text in _SUMS.items()]
    return rows.groupBy(*keys).agg(*sums)


def state_columns(states: DataFrame, amounts: Sequence[str], also: Sequence[str] = ()) -> list[str]:
    """The columns of a table of states that add up."""
    return [*also, *[c for n in amounts for c in states.columns if c.startswith(f"{n}__")]]


def merged(states: DataFrame, keys: Keys, amounts: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """States of a coarser level, or of several loads together."""
    return states.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in state_columns(states, amounts, also)])


def rolled_up(states: DataFrame, keys: Sequence[str], amounts: Sequence[str], also: Sequence[str] = ()) -> DataFrame:
    """States of every level: all keys, all but the last, and so on to none. ``level`` tells how many keys a row is by.

    The other keys are NULL in it, as they are for a blank member, which is why the level is told.
    """
    sums = [F.sum(c).alias(c) for c in state_columns(states, amounts, also)]
    if not keys:
        return states.agg(*sums).withColumn("level", F.lit(0))
    level = F.lit(len(keys)) - F.bit_count(F.grouping_id(*keys))
    return states.rollup(*keys).agg(*sums, level.alias("level"))


def total(states: DataFrame, name: str) -> Column:
    """The sum that a state stands for, as a double."""
    if f"{name}__dec" in states.columns:
        return F.col(f"{name}__dec").cast("double")
    high, unit, low, rest = (f"`{name}__{p}`" for p in PARTS)
    return F.expr(
        f"cast(cast({high} as decimal(19,0)) * 1048576BD + {unit} + {low} div 1048576L as double) + ({low} % 1048576L / 1048576D + {rest})"
    )


def average(states: DataFrame, name: str) -> Column:
    """The average that a state stands for; NULL without an amount."""
    return F.try_divide(total(states, name), F.col(f"{name}__n"))


def exact_aggregate(
    df: DataFrame,
    keys: Keys,
    sums: Mapping[str, str] | None = None,
    averages: Mapping[str, str] | None = None,
    also: Mapping[str, str] | None = None,
) -> DataFrame:
    """Keys, ``also`` (aggregates in SQL), and exact sums and averages by name of column or SQL expression.

    An expression that is both summed and averaged is taken apart once.
    """
    sums, averages, also = sums or {}, averages or {}, also or {}
    texts = list(dict.fromkeys([*sums.values(), *averages.values()]))
    of = {text: f"_a{i}" for i, text in enumerate(texts)}
    states = partial_states(df, keys, {n: text for text, n in of.items()}, also)
    names = states.columns[: len(keys)]
    return states.select(
        *names, *also, *[total(states, of[t]).alias(n) for n, t in sums.items()], *[average(states, of[t]).alias(n) for n, t in averages.items()]
    )
