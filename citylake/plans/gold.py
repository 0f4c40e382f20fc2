"""The taxi facts kept up to date: states per slot, facts per month, and only what a run has changed.

States of the daily fact are stored by the slot that the trips came from and by the month of their pickups. A slot whose
conformed files have changed has its states computed again, from its own trips only. Facts are then merged from the states of
the months that the slot's old or new states have rows for; all other partitions stay as they are, files and all. The result
is that of a full build, since states add up (``operators.exact``).

A note beside the data holds a digest of each slot's files and the months still to be merged. It is written before
tables change and after, so a run that breaks off is made up for by the next.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.operators.exact import merged
from citylake.operators.facts import TAXI_KEY, taxi_daily_by_zone, taxi_fact_of, taxi_states
from citylake.session import path_bytes, staging_path
from citylake.sources.manifest import SLOT
from citylake.sources.sinks import overwrite_partitions, overwrite_table, table_location
from citylake.sources.store import exists, read_text, remove, write_text

MONTH = "pickup_month"
# The zones of a month are dealt in parts that stand for about so many bytes of stored states.
PART, PART_BYTES = "_part", 4 * 1024 * 1024
# Marks the file a trip was read from, and a part of its zones that stands for about so many bytes of stored trips.
PIECE, PIECE_BYTES = "_piece", 4 * 1024 * 1024
# Parts share a task where it would stand for fewer bytes than these, and where there would be more tasks than these.
TASK_BYTES, MOST_TASKS = 1024 * 1024, 32_768
Slot = tuple[str, ...]


def month_of(day: Column | str) -> Column:
    """The month of a day, as facts are partitioned by it."""
    return F.date_format(day, "yyyy-MM")


def _values(folders: Sequence[str]) -> Slot:
    """Values of partition folders ``name=value``."""
    return tuple(unquote(f.split("=", 1)[1]) for f in folders)


def slot_digests(spark: SparkSession, table: str, columns: Sequence[str] = SLOT) -> dict[Slot, str]:
    """A digest of the file names of each partition; a rewritten one has other names. Lists files only."""
    found: dict[Slot, list[str]] = defaultdict(list)
    for path in spark.table(table).inputFiles():
        *folders, name = path.split("/")[-len(columns) - 1 :]
        found[_values([unquote(f) for f in folders])].append(name)
    return {slot: hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest() for slot, names in found.items()}


def partitions(spark: SparkSession, table: str) -> set[Slot]:
    """Partition values of a table, from the catalog."""
    return {_values(r[0].split("/")) for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def drop_partitions(spark: SparkSession, table: str, columns: Sequence[str], gone: set[Slot]) -> None:
    for values in gone:
        literal = ", ".join(f"`{c}` = '{v.replace(chr(92), chr(92) * 2).replace(chr(39), chr(92) + chr(39))}'" for c, v in zip(columns, values))
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({literal})")


def of_slots(df: DataFrame, slots: Sequence[Slot], columns: Sequence[str] = SLOT) -> DataFrame:
    """Rows of some partitions; equalities on partition columns, so that only their files are read."""
    one = [reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(columns, slot)], F.lit(True)) for slot in slots]
    return df.filter(reduce(lambda a, b: a | b, one, F.lit(False)))


class TaxiGold:
    """The stored states and the two facts of a table of conformed trips that is partitioned by slot (text columns)."""

    def __init__(
        self,
        spark: SparkSession,
        note: str,
        silver: str = "silver_nyc_taxi",
        states: str = "gold_taxi_states",
        fact: str = "gold_fact_nyc_taxi_daily",
        by_zone: str = "gold_fact_taxi_daily",
    ):
        self.spark, self.note = spark, note
        self.silver, self.states, self.fact, self.by_zone = silver, states, fact, by_zone

    def _states_of(self, trips: DataFrame) -> DataFrame:
        """States of each file of trips. A slot of several files may have several rows of one key, which add up.

        Trips are dealt once, by their file, of which each holds one slot and is of a bounded size, and by a part of its
        zones: a key with very many trips is grouped file by file, and the states are written as they lie. The tasks are
        as many as the parts need, so that each groups its own in memory. Adaptive execution would merge tasks by the
        bytes dealt, and groups take up many times those. States are written in order of their key, which makes them
        smaller, and smaller to deal by month.
        """
        stored, files = self._stored(self.silver), len(self.spark.table(self.silver).inputFiles())
        parts = max(1, -(-stored // (PIECE_BYTES * max(1, files))))
        tasks = self._tasks(len(trips.inputFiles()) * parts, stored)
        file, part = F.xxhash64("_metadata.file_path"), F.pmod(F.xxhash64("pickup_location_id"), F.lit(parts))
        pieces = trips.withColumn(PIECE, F.xxhash64(file, part)).repartition(tasks, PIECE)
        states = taxi_states(pieces, [*SLOT, PIECE]).drop(PIECE).withColumn(MONTH, month_of("pickup_date"))
        return states.sortWithinPartitions(*SLOT, MONTH, *TAXI_KEY)

    def _stored(self, table: str) -> int:
        return path_bytes(self.spark, table_location(self.spark, table))

    def _tasks(self, parts: int, stored: int) -> int:
        """Tasks for the parts of a table of so many bytes."""
        enough = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-stored // TASK_BYTES))
        return max(1, min(parts, enough, MOST_TASKS))

    def _parts(self) -> int:
        """Parts of a month of states, for tasks of about a bounded size."""
        months = {p[-1] for p in partitions(self.spark, self.states)}
        return max(1, -(-self._stored(self.states) // (PART_BYTES * max(1, len(months)))))

    def _facts_of(self, states: DataFrame) -> Iterator[tuple[str, DataFrame]]:
        """Name and rows of the fact, then, read from what has been written of it, of the fact without taxi type.

        Rows are dealt once, by month and a part of its zones, and parts are spread evenly over tasks. That is enough
        to group by key, and they are written as they lie. A zone has few states in a month, so no part is hot.
        """
        amounts = ["revenue", "distance", *(["tip"] if "tip__n" in states.columns else [])]
        keys, parts = [*TAXI_KEY, MONTH, PART], self._parts()
        months = {path.split("/")[-2] for path in states.inputFiles()}
        tasks = self._tasks(len(months) * parts, self._stored(self.states))
        # The parts of months that follow each other have numbers that do, too.
        month = 12 * F.year("pickup_date") + F.month("pickup_date")
        number = month * parts + F.pmod(F.xxhash64("pickup_location_id"), F.lit(parts))
        part = F.coalesce(F.pmod(number, F.lit(tasks)), F.lit(0)).cast("int")
        dealt = lambda df: df.withColumn(PART, part).repartitionById(tasks, PART)
        fact = taxi_fact_of(merged(dealt(states), keys, amounts, ["total_trips"]), keys).drop(PART)
        yield self.fact, fact.sortWithinPartitions(MONTH, *TAXI_KEY)
        written = self.spark.table(self.fact).drop("avg_tip_amount")
        yield self.by_zone, taxi_daily_by_zone(dealt(written), [MONTH, PART]).drop(PART)

    def _build(self) -> None:
        overwrite_table(self._states_of(self.spark.table(self.silver)), self.states, [*SLOT, MONTH], together=True)
        for name, df in self._facts_of(self.spark.table(self.states)):
            overwrite_table(df, name, [MONTH], together=True)

    def _say(self, slots: dict[Slot, str], months: set[str]) -> None:
        told = {"slots": {"/".join(s): d for s, d in slots.items()}, "months": sorted(months)}
        write_text(self.spark, self.note, json.dumps(told))

    def refresh(self) -> list[str] | None:
        """Bring the facts up to date; the months that were rewritten, or None for a full build.

        All is built anew where a table or the note is missing, or the columns of the states have changed.
        """
        spark, now = self.spark, slot_digests(self.spark, self.silver)
        there = all(spark.catalog.tableExists(t) for t in (self.states, self.fact, self.by_zone)) and exists(spark, self.note)
        wanted = set(self._states_of(spark.table(self.silver)).columns)
        if not there or set(spark.table(self.states).columns) != wanted:
            if exists(spark, self.note):
                remove(spark, self.note)
            self._build()
            self._say(now, set())
            return None
        note = json.loads(read_text(spark, self.note))
        old = {tuple(s.split("/")): d for s, d in note["slots"].items()}
        changed = [slot for slot in sorted({*now, *old}) if now.get(slot) != old.get(slot)]
        months = set(note["months"])
        if changed:
            stored = {p for p in partitions(spark, self.states) if p[: len(SLOT)] in set(changed)}
            months |= {p[-1] for p in stored}
            self._say(old, months)
            fresh, path = self._staged(changed)
            kept = {tuple(r) for r in fresh.select(*SLOT, MONTH).distinct().collect()}  # slots times their months
            months |= {p[-1] for p in kept}
            self._say(old, months)
            overwrite_partitions(fresh, self.states, [*SLOT, MONTH])
            drop_partitions(spark, self.states, [*SLOT, MONTH], stored - kept)
            remove(spark, path)
        if months:
            self._merge(months)
        self._say(now, set())
        return sorted(months)

    def _staged(self, changed: list[Slot]) -> tuple[DataFrame, str]:
        """States of the changed slots, written aside: their partitions are looked at before they are loaded."""
        path = staging_path(self.spark, "slot-states")
        found = self._states_of(of_slots(self.spark.table(self.silver), changed))
        found.write.parquet(path)
        return self.spark.read.schema(found.schema).parquet(path), path

    def _merge(self, months: set[str]) -> None:
        spark = self.spark
        touched = spark.table(self.states).filter(F.col(MONTH).isin(sorted(months)))
        left = {p[-1] for p in partitions(spark, self.states)}
        for name, df in self._facts_of(touched):
            overwrite_partitions(df.filter(F.col(MONTH).isin(sorted(months & left))), name, [MONTH], together=True)
            drop_partitions(spark, name, [MONTH], {(m,) for m in months - left})
