"""Which monthly files should exist, which have landed, and what is left to load.

A slot is one taxi type in one month: ``taxi_type, year, month`` with year and month as text, the way
they appear in paths.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylake.functions import pad2

SLOT = ["taxi_type", "year", "month"]


def slot_path(taxi: str, year: str | int, month: str | int, root: str = "") -> str:
    """Landing folder of a slot."""
    return f"{root.rstrip('/') + '/' if root else ''}{taxi}/{int(year):04d}/{int(month):02d}"


def folders_of_path(path: Column) -> dict[str, Column]:
    """The three folders above a landed file, in the places of a slot's columns; whether they are one is not looked at."""
    return {name: F.substring_index(F.substring_index(path, "/", i - 4), "/", 1) for i, name in enumerate(SLOT)}


def slot_of_path(path: Column) -> dict[str, Column]:
    """Slot columns of a landed file's path; empty where the folders above it are no type, year and month.

    Cut by position and checked on the short year and month only: for every row this costs little, a pattern over the
    whole path would cost a hundred times as much.
    """
    folders = folders_of_path(path)
    is_number = lambda c, n: (F.length(c) == n) & (F.translate(c, "0123456789", "") == "")
    deep = F.length(path) - F.length(F.translate(path, "/", "")) >= len(SLOT)
    good = deep & is_number(folders["year"], 4) & is_number(folders["month"], 2) & (folders["taxi_type"] != "")
    return {name: F.when(good, folder).otherwise("") for name, folder in folders.items()}


def _month_columns(first_day: Column) -> list[Column]:
    return [F.year(first_day).cast("string").alias("year"), pad2(F.month(first_day)).alias("month")]


def _months(start: Column, end: Column) -> Column:
    first, last = F.trunc(start, "month"), F.trunc(end, "month")
    return F.explode(F.sequence(first, last, F.expr("interval 1 month"))).alias("_first_day")


def ingest_manifest(
    spark: SparkSession, types: Sequence[str], years: Sequence[int], as_of: dt.date
) -> DataFrame:
    """All slots of the types and years, up to the month of ``as_of`` within its year."""
    one = spark.range(0, 1, 1, 1)
    by_type = one.select(F.explode(F.array(*[F.lit(t) for t in types])).alias("taxi_type"))
    by_year = by_type.select("taxi_type", F.explode(F.array(*[F.lit(y) for y in years])).alias("_year"))
    start = F.make_date("_year", F.lit(1), F.lit(1))
    last_month = F.when(F.col("_year") == as_of.year, F.lit(as_of.month)).otherwise(F.lit(12))
    end = F.make_date("_year", last_month, F.lit(1))
    return by_year.select("taxi_type", _months(start, end)).select("taxi_type", *_month_columns(F.col("_first_day")))


def manifest_over(df: DataFrame, type_column: str, date_column: str) -> DataFrame:
    """Slots that data of this span should have: every type seen, every month of the whole range.

    One pass over the data gives one row per type; only those few rows are looked at together.
    """
    per_type = df.groupBy(F.col(type_column).alias("taxi_type")).agg(
        F.min(date_column).cast("date").alias("first"), F.max(date_column).cast("date").alias("last")
    )
    together = Window.partitionBy()
    spanned = per_type.select(
        "taxi_type", F.min("first").over(together).alias("first"), F.max("last").over(together).alias("last")
    )
    return spanned.select("taxi_type", _months(F.col("first"), F.col("last"))).select(
        "taxi_type", *_month_columns(F.col("_first_day"))
    )


def landed_slots(spark: SparkSession, root: str) -> DataFrame:
    """Slots with a non-empty file below ``root``. Lists files only; an empty folder does not count."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(root)
        .filter(F.col("length") > 0)
        .select("path")
    )
    slots = files.select(*[c.alias(n) for n, c in slot_of_path(F.col("path")).items()])
    return slots.filter(F.col("taxi_type") != "").distinct()


def pending_slots(manifest: DataFrame, landed: DataFrame, available: DataFrame | None = None) -> DataFrame:
    """Slots of the manifest that have not landed and, when known, are available at the source."""
    pending = manifest.join(landed, SLOT, "left_anti")
    return pending if available is None else pending.join(available, SLOT, "left_semi")


def slot_status(
    manifest: DataFrame, landed: DataFrame, available: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """Status of each slot in this run: skipped (had landed), failed, loaded or missing."""

    def flagged(df: DataFrame, name: str) -> DataFrame:
        return df.select(*SLOT).distinct().withColumn(name, F.lit(True))

    out = manifest.join(flagged(landed, "_landed"), SLOT, "left")
    out = out.join(flagged(available, "_available"), SLOT, "left")
    broke = F.lit(False)
    if failed is not None:
        out = out.join(flagged(failed, "_failed"), SLOT, "left")
        broke = F.col("_failed").isNotNull()
    status = (
        F.when(F.col("_landed").isNotNull(), "skipped")
        .when(broke, "failed")
        .when(F.col("_available").isNotNull(), "loaded")
        .otherwise("missing")
    )
    return out.select(*SLOT, status.alias("status"))


def load_summary(
    manifest: DataFrame, landed: DataFrame, available: DataFrame, failed: DataFrame | None = None
) -> DataFrame:
    """Number of slots by status."""
    return slot_status(manifest, landed, available, failed).groupBy("status").agg(
        F.count(F.lit(1)).alias("n")
    )


FLAGS = ["landed", "available", "failed"]


def flagged_slots(manifest: DataFrame, slots: DataFrame) -> DataFrame:
    """Slots of the manifest with the flags of a table of one row per slot, in one join; no row means no flag."""
    joined = manifest.join(slots.select(*SLOT, *FLAGS), SLOT, "left")
    return joined.select(*SLOT, *[F.coalesce(flag, F.lit(False)).alias(flag) for flag in FLAGS])


def pending_of(flagged: DataFrame) -> DataFrame:
    """Slots that are available and have not landed."""
    return flagged.filter("available AND NOT landed").select(*SLOT)


def status_counts(flagged: DataFrame) -> DataFrame:
    """Number of slots by status: skipped (had landed), failed, loaded or missing."""
    status = "CASE WHEN landed THEN 'skipped' WHEN failed THEN 'failed' WHEN available THEN 'loaded' ELSE 'missing' END"
    return flagged.groupBy(F.expr(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))
