"""Forward fill of a series: for short series, by periods of time, and for series of any length."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.session import durable_checkpoint


def forward_fill(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str) -> DataFrame:
    """Replace NULL by the latest earlier value of the same key; leading NULLs stay.

    Each key is sorted in one task: right where a key is bounded, e.g. one row per calendar day.
    ``order`` must be total within a key. For longer series see :func:`forward_fill_bucketed`.
    """
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(column, F.last(column, ignorenulls=True).over(window))


# Columns of the closing and opening values of a period.
PERIOD, CLOSING, OPENING = "_period", "_closing", "_opening"


def closing_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, period: str) -> DataFrame:
    """Last known value of each key in each period that it has rows in; NULL where the period knows none."""
    last = F.max_by(F.col(column), F.when(F.col(column).isNotNull(), F.struct(*order)))
    return df.groupBy(*keys, F.expr(period).alias(PERIOD)).agg(last.alias(CLOSING))


def opening_values(closings: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The value that each key brings into a period from earlier ones, where there is one.

    A key has one row per period here, so the window is bounded by the calendar.
    """
    earlier = Window.partitionBy(*keys).orderBy(PERIOD).rowsBetween(Window.unboundedPreceding, -1)
    carried = closings.withColumn(OPENING, F.last(CLOSING, ignorenulls=True).over(earlier))
    return carried.filter(F.col(OPENING).isNotNull()).select(*keys, PERIOD, OPENING)


def filled_from(
    df: DataFrame, openings: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, period: str
) -> DataFrame:
    """Fill each key and period by itself, beginning with its opening value.

    The opening value comes in as a row ahead of the period's own. So it needs no join, a key that is NULL
    is a key like any other, and the rows are shuffled once.
    """
    rows = df.withColumns({PERIOD: F.expr(period), "_own": F.lit(True)})
    ahead = openings.withColumnRenamed(OPENING, column).withColumn("_own", F.lit(False))
    inside = Window.partitionBy(*keys, PERIOD).orderBy("_own", *order).rowsBetween(Window.unboundedPreceding, 0)
    both = rows.unionByName(ahead, allowMissingColumns=True).repartition(*keys, PERIOD)
    filled = both.withColumn(column, F.last(column, ignorenulls=True).over(inside))
    return filled.filter("_own").select(*df.columns)


def forward_fill_by_period(df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, period: str) -> DataFrame:
    """As :func:`forward_fill`, with a key cut into periods of time.

    ``period`` is SQL text over the rows, such as ``trunc(day, 'MM')``; it must not fall along ``order``. Only the last known
    value of each key and period, found in the map tasks first, goes through a second, small window. Periods are a
    function of the rows, so nothing has to be fixed by a checkpoint, and the rows are read twice instead. One task sorts the
    rows of one key in one period: take periods short enough, or :func:`forward_fill_bucketed` where a
    single instant may hold rows without bound.
    """
    openings = opening_values(closing_values(df, keys, order, column, period), keys)
    return filled_from(df, openings, keys, order, column, period)


def forward_fill_bucketed(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], column: str, buckets: int | None = None
) -> DataFrame:
    """As :func:`forward_fill`, for keys of any size, down to all rows having one key.

    The rows are range-partitioned by key and order, which cuts a long key into even slices (a day or
    an instant that holds very many rows is cut as well, since ``order`` is total). The fill then runs
    inside each slice, and the last value of the earlier slices is carried in. A slice passes a value on
    only to a key that continues in the next one, so there are fewer carried rows than slices: that is
    the bound that makes broadcasting them safe at any data size.

    Acts: slice numbers come from a sampled range partitioner, so they are fixed by a reliable
    checkpoint before two branches use them.
    """
    ranged = df.repartitionByRange(*([buckets] if buckets else []), *keys, *order)
    sliced = durable_checkpoint(ranged.withColumn("_slice", F.spark_partition_id()))

    position = F.struct(*order) if len(order) > 1 else F.col(order[0])
    closing = F.max_by(F.col(column), F.when(F.col(column).isNotNull(), position))
    per_slice = sliced.groupBy(*keys, "_slice").agg(closing.alias("_closing"))
    earlier = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_slice.withColumn("_carry", F.last("_closing", ignorenulls=True).over(earlier))
        .filter(F.col("_carry").isNotNull())
        .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_slice").alias("_s"), "_carry")
    )

    inside = Window.partitionBy(*keys, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    filled = sliced.withColumn(column, F.last(column, ignorenulls=True).over(inside))
    same: list[Column] = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    same.append(F.col("_slice") == F.col("_s"))
    joined = filled.join(F.broadcast(carried), reduce(lambda a, b: a & b, same), "left")
    value = F.coalesce(F.col(column), F.col("_carry")).alias(column)
    return joined.select(*[value if c == column else F.col(c) for c in df.columns])
