"""Sinks. These functions act."""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.ordering import ordered
from citylake.operators.quality import RowCounts
from citylake.schemas import SchemaMismatch, enforce_schema
from citylake.sources.store import exists, names, read_text, remove, write_text


def balanced(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Bring rows of one output partition together, so that each gets few files.

    A rebalance and not a repartition: adaptive execution splits a partition value that holds very many
    rows over several tasks, and merges small ones.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def _prepared(df: DataFrame, partition_by: Sequence[str], counts: RowCounts | None, together: bool = False) -> DataFrame:
    """``together`` tells that rows of one output partition lie in few tasks already; they are not shuffled again."""
    rows = df if together else balanced(df, partition_by)
    return counts.on(rows) if counts else rows


def _columns(spark: SparkSession, path: str) -> T.StructType | None:
    note = f"{path.rstrip('/')}/_columns.json"
    return T.StructType.fromJson(json.loads(read_text(spark, note))) if exists(spark, note) else None


def append_evolving(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append rows that may bring new columns, or lack some; a column keeps its type.

    The columns of all appends lie beside the rows, so that no read has to open every file for them. They are written ahead
    of the rows; a new column whose rows never come is NULL. Appends must not run at the same time.
    """
    spark, here = df.sparkSession, T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    known = _columns(spark, path)
    if known is None:  # rows from before the columns were noted
        known = read_evolving(spark, path).schema if names(spark, path) else T.StructType([])
    types = {f.name: f.dataType for f in known.fields}
    if unlike := [f.name for f in here.fields if types.get(f.name, f.dataType) != f.dataType]:
        raise SchemaMismatch(f"{path} has other types of {unlike}")
    merged = T.StructType([*known.fields, *[f for f in here.fields if f.name not in types]])
    if merged != _columns(spark, path):
        write_text(spark, f"{path.rstrip('/')}/_columns.json", merged.json())
    balanced(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read what :func:`append_evolving` wrote; rows from before a column existed have NULL."""
    known = _columns(spark, path)
    return spark.read.schema(known).parquet(path) if known else spark.read.option("mergeSchema", "true").parquet(path)


def _versions_folder(spark: SparkSession, name: str) -> str:
    """Folder for the files of a table's contents, one folder below it for each replacement."""
    *database, table = name.split(".")
    root = spark.catalog.getDatabase(database[0] if database else spark.catalog.currentDatabase()).locationUri
    return f"{root.rstrip('/')}/{table}.contents"


def _layout(df: DataFrame, partition_by: Sequence[str]) -> list[tuple[str, str]]:
    """Columns in the order a written table has them: those it is partitioned by come last."""
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return [(n, fields[n]) for n in [*[n for n in fields if n not in partition_by], *partition_by]]


def overwrite_table(
    df: DataFrame, name: str, partition_by: Sequence[str] = (), counts: RowCounts | None = None, together: bool = False
) -> None:
    """Replace a table, its schema too; ``df`` may read the table itself.

    The rows are written beside the old ones, as a table of another name. Only when all are there does ``name`` point at
    them: in one step of the catalog where an unpartitioned table keeps its columns, else by dropping the old entry and
    renaming the new one. A write that fails leaves the table as it was. The contents before are kept until the next
    replacement, for queries that still read them; older ones are removed. ``counts`` sees the rows that are written.
    Rows are brought together by partition, unless they lie ``together``.
    """
    spark = df.sparkSession
    folder, version = _versions_folder(spark, name), uuid.uuid4().hex
    fresh, path = f"{name}_{version}", f"{folder}/{version}"
    try:
        _prepared(df, partition_by, counts, together).write.partitionBy(*partition_by).option("path", path).saveAsTable(fresh)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        remove(spark, path)
        raise
    before = None
    if spark.catalog.tableExists(name):
        before = table_location(spark, name)
        kept = not partition_by and not _partitioned(spark, name)
        if kept and before.startswith(folder) and _layout(spark.table(name), ()) == _layout(spark.table(fresh), ()):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.sql(f"DROP TABLE {fresh}")  # of a table whose path was given only the entry goes
            fresh = ""
        else:
            spark.sql(f"DROP TABLE {name}")
    if fresh:
        spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")
    spark.catalog.refreshTable(name)
    for other in names(spark, folder):
        if other != version and f"{folder}/{other}" != before:
            remove(spark, f"{folder}/{other}")


def table_location(spark: SparkSession, name: str) -> str:
    """Folder of a table's files."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'")
    return described.first()["data_type"]


def _partitioned(spark: SparkSession, name: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(name))


def overwrite_partitions(
    df: DataFrame, name: str, partition_by: Sequence[str], counts: RowCounts | None = None, together: bool = False
) -> None:
    """Replace the partitions of a table that ``df`` has rows for; the others stay. Columns must be the table's.

    ``together`` is as for :func:`overwrite_table`.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name) or set(spark.table(name).columns) != set(df.columns):
        raise SchemaMismatch(f"{name} does not have the columns {df.columns}")
    key = "spark.sql.sources.partitionOverwriteMode"  # inserting into a table heeds the session's setting only
    before = spark.conf.get(key)
    spark.conf.set(key, "dynamic")
    try:
        _prepared(df.select(*spark.table(name).columns), partition_by, counts, together).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(key, before)


def overwrite_enforced(df: DataFrame, name: str, schema: T.StructType, counts: RowCounts | None = None) -> None:
    """Replace the rows of a table whose schema is fixed; raises before writing on a mismatch."""
    overwrite_table(enforce_schema(df, schema), name, counts=counts)


def promote(spark: SparkSession, src: str, dst: str) -> None:
    """Copy a table unchanged to the next layer."""
    overwrite_table(spark.table(src), dst)


def write_report(df: DataFrame, path: str, run_ts: dt.datetime | None = None) -> None:
    """Write a one-row status as one file that holds a single JSON object, replacing the last one."""
    stamp = F.current_timestamp() if run_ts is None else F.lit(run_ts).cast("timestamp")
    stamped = df.withColumn("timestamp", stamp.cast("string"))
    rows = stamped.select(F.to_json(F.struct(*stamped.columns), {"ignoreNullFields": "false"})).take(2)
    if len(rows) != 1:
        raise ValueError("a report has one row")
    write_text(df.sparkSession, path, rows[0][0] + "\n")


def export_name(day: dt.date) -> str:
    """Dated name of the forecast export."""
    return f"Weather_Report_{day:%Y-%m-%d}.json"


def export_top_n(
    df: DataFrame, n: int, order_by: str | Sequence[str], path: str | None = None, day: dt.date | None = None
) -> DataFrame:
    """First ``n`` records by a total order; with ``path``, written as one file that holds a JSON array.

    Times are in ISO form. The records pass through the driver: ``n`` is the size of a report.
    """
    rows = ordered(df, order_by, limit=n)
    if path is not None:
        lines = [r[0] for r in rows.select(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})).collect()]
        name = f"{path.rstrip('/')}/{export_name(day or dt.date.today())}"
        write_text(df.sparkSession, name, "[" + ",\n ".join(lines) + "]\n")
    return rows
