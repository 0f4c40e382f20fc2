"""A filled series kept up to date: a new period is filled from the values stored at the close of the ones before it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.operators.series import OPENING, PERIOD, closing_values, filled_from, opening_values
from citylake.plans.gold import drop_partitions, slot_digests
from citylake.session import staging_path
from citylake.sources.sinks import overwrite_partitions, overwrite_table
from citylake.sources.store import exists, read_text, remove, write_text


class FilledSeries:
    """The fill of ``column`` in a table of raw rows that is partitioned by ``period``, a text column that sorts by time.

    Beside the filled rows, the last known value of each key and period is stored. A run reads the raw rows of changed periods,
    and of later ones where the value that a key brings into them has changed by it; no others are read or written.
    The result is that of filling the whole history.

    A note holds a digest of each period's files and the periods still to be filled. Filled rows are written before the closing
    values they were made with, and the note last, so a run that breaks off is made up for by the next.
    """

    def __init__(
        self, spark: SparkSession, note: str, raw: str, filled: str, closings: str,
        keys: Sequence[str], order: Sequence[str], column: str, period: str = "period",
    ):
        self.spark, self.note = spark, note
        self.raw, self.filled, self.closings = raw, filled, closings
        self.keys, self.order, self.column, self.period = list(keys), list(order), column, period

    def _closings_of(self, rows: DataFrame) -> DataFrame:
        return closing_values(rows, self.keys, self.order, self.column, self.period)

    def _fill(self, rows: DataFrame, openings: DataFrame) -> DataFrame:
        return filled_from(rows, openings, self.keys, self.order, self.column, self.period)

    def _say(self, digests: dict[tuple[str, ...], str], periods: set[str]) -> None:
        told = {"periods": {p: d for (p,), d in digests.items()}, "open": sorted(periods)}
        write_text(self.spark, self.note, json.dumps(told))

    def _build(self) -> None:
        rows = self.spark.table(self.raw)
        overwrite_table(self._closings_of(rows), self.closings, [PERIOD])
        openings = opening_values(self.spark.table(self.closings), self.keys)
        overwrite_table(self._fill(rows, openings), self.filled, [self.period])

    def _moved(self, before: DataFrame, after: DataFrame) -> list[str]:
        """Periods that some key enters with another value than before; months or days, not rows."""
        new = after.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], F.col(PERIOD).alias("_p"), F.col(OPENING).alias("_new"))
        same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(self.keys)]
        joined = before.join(new, reduce(Column.__and__, same, F.col(PERIOD) == F.col("_p")), "full")
        unlike = joined.filter(~F.col(OPENING).eqNullSafe(F.col("_new")))
        return [r[0] for r in unlike.select(F.coalesce(PERIOD, "_p")).distinct().collect()]

    def refresh(self) -> list[str] | None:
        """Bring the filled rows up to date; the periods that were written, or None for a full build."""
        spark, now = self.spark, slot_digests(self.spark, self.raw, [self.period])
        there = all(spark.catalog.tableExists(t) for t in (self.filled, self.closings)) and exists(spark, self.note)
        if not there or set(spark.table(self.filled).columns) != set(spark.table(self.raw).columns):
            if exists(spark, self.note):
                remove(spark, self.note)
            self._build()
            self._say(now, set())
            return None
        note = json.loads(read_text(spark, self.note))
        old = {(p,): d for p, d in note["periods"].items()}
        changed = [p for (p,) in sorted({*now, *old}) if now.get((p,)) != old.get((p,))]
        if not changed and not note["open"]:
            return []
        path = staging_path(spark, "closings")
        rows = spark.table(self.raw)
        found = self._closings_of(rows.filter(F.col(self.period).isin(changed)))
        found.write.parquet(path)
        fresh = spark.read.schema(found.schema).parquet(path)

        stored = spark.table(self.closings)
        kept = stored.filter(~F.col(PERIOD).isin(changed))
        before = opening_values(stored, self.keys)
        after = opening_values(kept.unionByName(fresh), self.keys)
        periods = {*changed, *note["open"], *self._moved(before, after)}
        self._say(old, periods)
        touched = sorted(periods)
        openings = after.filter(F.col(PERIOD).isin(touched)).select(*self.keys, PERIOD, OPENING)
        overwrite_partitions(self._fill(rows.filter(F.col(self.period).isin(touched)), openings), self.filled, [self.period])
        overwrite_partitions(fresh, self.closings, [PERIOD])
        gone = {(p,) for p in periods} - set(now)
        drop_partitions(spark, self.filled, [self.period], gone)
        drop_partitions(spark, self.closings, [PERIOD], gone)
        self._say(now, set())
        remove(spark, path)
        return touched
