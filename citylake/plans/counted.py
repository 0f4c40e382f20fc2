"""Quality counts of tables, taken while they are written and summed over the partitions that are there now."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from citylake.operators.quality import Counts, RowCounts
from citylake.plans.gold import Slot, of_slots, slot_digests
from citylake.sources.store import exists, read_text, write_text


class CountedTable:
    """Counts of ``rules`` over a table, which may be partitioned by ``columns`` (text columns).

    A note holds the counts of each write together with the partitions it wrote and a digest of their files. Counts whose
    files are all still there are summed; partitions that no such counts cover (one of several written together has been replaced,
    a run broke off before it made its note, another program wrote) are counted by a scan of their files alone, and each
    gets counts of its own by it. So the answer is always that of a whole scan.
    """

    def __init__(self, spark: SparkSession, note: str, table: str, rules: Mapping[str, Column], columns: Sequence[str] = ()):
        self.spark, self.note, self.table = spark, note, table
        self.rules, self.columns = dict(rules), list(columns)

    def _digests(self) -> dict[Slot, str]:
        there = self.spark.catalog.tableExists(self.table)
        return slot_digests(self.spark, self.table, self.columns) if there else {}

    def _groups(self, now: dict[Slot, str]) -> list[dict]:
        """Noted writes of which every partition is as it was written."""
        noted = json.loads(read_text(self.spark, self.note)) if exists(self.spark, self.note) else []
        return [
            g for g in noted
            if g["rules"] == sorted(self.rules) and all(now.get(tuple(slot)) == digest for slot, digest in g["slots"])
        ]

    def _group(self, slots: Mapping[Slot, str], counts: Counts) -> dict:
        return {"rules": sorted(self.rules), "slots": [[list(s), d] for s, d in sorted(slots.items())], "counts": counts}

    @contextmanager
    def writing(self) -> Iterator[RowCounts]:
        """For one write of the table: hand what is given to the sink. The partitions that it replaces are noted with their counts."""
        before, counts = self._digests(), RowCounts(self.rules)
        yield counts
        now = self._digests()
        written = {slot: digest for slot, digest in now.items() if before.get(slot) != digest}
        if written:
            write_text(self.spark, self.note, json.dumps([*self._groups(now), self._group(written, counts.counts())]))

    def _scanned(self, slots: Mapping[Slot, str]) -> list[dict]:
        """Counts of each of some partitions, from their files."""
        failing = [F.count_if(failed).alias(f"_f{i}") for i, failed in enumerate(self.rules.values())]
        rows = of_slots(self.spark.table(self.table), list(slots), self.columns)
        found = {
            tuple(r[c] for c in self.columns): {n: (r["_n"], r[f"_f{i}"]) for i, n in enumerate(self.rules)}
            for r in rows.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("_n"), *failing).collect()  # a row per partition
        }
        none = {n: (0, 0) for n in self.rules}
        return [self._group({slot: digest}, found.get(slot, none)) for slot, digest in slots.items()]

    def counts(self) -> Counts:
        """Counts of the whole table as it is now."""
        now = self._digests()
        groups = self._groups(now)
        covered = {tuple(slot) for g in groups for slot, _ in g["slots"]}
        if left := {slot: digest for slot, digest in now.items() if slot not in covered}:
            groups += self._scanned(left)
            write_text(self.spark, self.note, json.dumps(groups))
        return {n: tuple(sum(g["counts"][n][part] for g in groups) for part in (0, 1)) for n in self.rules}
