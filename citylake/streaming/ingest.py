"""Each landed file is loaded exactly once, however often the job runs."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader, StreamingQuery

from citylake.session import OPEN_FILES, session_for
from citylake.sources.files import read_trip_slots
from citylake.sources.manifest import SLOT, folders_of_path, slot_of_path
from citylake.sources.sinks import balanced
from citylake.sources.store import WideningTable, exists, names, read_text, write_text


def landed_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    slot: Mapping[str, Column] | None = None,
    files_per_batch: int = 10_000,
) -> DataFrame:
    """New files below ``landing`` with load time, file name and slot; by default the path tells the slot."""
    path = F.col("_metadata.file_path")
    columns = dict(slot) if slot is not None else {n: _slot_or_error(c, path) for n, c in slot_of_path(path).items()}
    landed = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
    )
    return landed.select(
        "*",
        F.current_timestamp().alias("ingestion_timestamp"),
        path.alias("source_file"),
        *[c.alias(n) for n, c in columns.items()],
    )


def _slot_or_error(part: Column, path: Column) -> Column:
    """A file that lies in no slot's folder stops the load, instead of going to a slot without a name."""
    return F.when(part != "", part).otherwise(F.raise_error(F.concat(F.lit("no slot in path "), path)))


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the query a checkpoint belongs to; it stays the same over restarts."""
    return json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]


def refuse_new_checkpoint(spark: SparkSession, out: str, checkpoint: str) -> None:
    """A table that has rows must not be loaded by a query that does not know of them."""
    if not exists(spark, f"{checkpoint}/metadata") and names(spark, out):
        raise ValueError(f"{out} has been loaded before, but {checkpoint} is new: landed files would be loaded again")


def ingest_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    slot: Mapping[str, Column] | None = None,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Append new files to the table at ``out`` and stop when all are in. For files that hold one slot each.

    The stream's checkpoint, not the existence of a folder, says what has been loaded, and the sink's
    commit log hides files of a batch that did not finish. One slot per file means that the output is
    partitioned without a shuffle. Nor are rows sorted: a task keeps a file open for each slot it meets
    (``files_kept_open``), for which the stream runs in a session of its own.
    """
    own = session_for(spark)
    own.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FILES))
    loaded = landed_stream(own, landing, schema, slot, files_per_batch)
    return (
        loaded.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*(slot or slot_of_path(F.lit(""))))
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def ingest_mixed_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    slot: Mapping[str, Column],
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """As :func:`ingest_stream`, for files that mix slots.

    Written as they come, every task would open a file for every slot. Each batch is therefore
    rebalanced by slot, which also splits a slot that holds very many rows. A batch is written to a
    folder of its own, ``batch=<query>-<id>``: when a batch is repeated after a failure it replaces itself.
    A new checkpoint on a table that has rows is refused.
    """
    refuse_new_checkpoint(spark, out, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        folder = f"{out}/batch={query_id(spark, checkpoint)}-{batch_id}"
        balanced(batch, list(slot)).write.mode("overwrite").partitionBy(*slot).parquet(folder)

    return (
        landed_stream(spark, landing, schema, slot, files_per_batch)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# Columns of a file listing.
LISTING = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


# What is kept of each file: the load that took it last, or why none did.
FILE = "path string, length long, modified long, load string, reason string, noted_at double"
NO_SLOT, NO_PARQUET, GONE = "in no slot's folder", "no Parquet file", "no longer landed"


def _listing(files: DataFrame) -> DataFrame:
    return files.select("path", "length", F.unix_micros("modificationTime").alias("modified"))


def _note_files(spark: SparkSession, out: str, load: str, noted: list[tuple[Row, str | None]]) -> None:
    """Keep what a load has made of its files; a repeated load replaces its note."""
    now = time.time()
    lines = [
        json.dumps({**{c: f[c] for c in ("path", "length", "modified")}, "load": load, "reason": reason, "noted_at": now})
        for f, reason in noted
    ]
    if lines:
        write_text(spark, f"{out}/_files/{load}.json", "\n".join(lines) + "\n")


def known_files(spark: SparkSession, out: str) -> DataFrame:
    """The latest note on each landed file: ``path, length, modified, load, reason``."""
    folder = f"{out}/_files"
    if not names(spark, folder):
        return spark.createDataFrame([], FILE).drop("noted_at")
    noted = spark.read.schema(FILE).json(folder)
    latest = noted.groupBy("path").agg(F.max_by(F.struct("length", "modified", "load", "reason"), "noted_at").alias("f"))
    return latest.select("path", "f.*")


def _in_slots(trips: DataFrame) -> DataFrame:
    """Rows with their load time and slot. Their paths have been checked; the rows only take the folders over."""
    return trips.withColumns({"ingestion_timestamp": F.current_timestamp(), **folders_of_path(F.col("source_file"))})


def ingest_drifting_stream(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """As :func:`ingest_stream`, for files whose columns or types change from month to month.

    The stream carries file names only (contents are not read by it), so at most ``files_per_batch``
    names reach the driver. The files of a batch are then read with their drift resolved and loaded to a
    ``WideningTable``, which keeps the schema beside the rows: read it with :func:`read_drifting`. Files
    whose path is no slot and files that are no Parquet files are listed by :func:`rejected_files` and not loaded. Files
    that were loaded before are left to :func:`reload_republished`. A new checkpoint on a table that has rows is refused.
    """
    refuse_new_checkpoint(spark, out, checkpoint)
    table = WideningTable(spark, out, SLOT)

    def write(batch: DataFrame, batch_id: int) -> None:
        name = f"{query_id(spark, checkpoint)}-{batch_id}"
        in_slot = slot_of_path(F.col("path"))[SLOT[0]] != ""
        listed = batch.withColumn("good", in_slot).collect()
        others = known_files(spark, out).filter(F.col("load") != name).select("path")
        known = {r["path"] for r in others.join(spark.createDataFrame([(f["path"],) for f in listed], "path string"), "path").collect()}
        new = [f for f in listed if f["path"] not in known]
        broken: list[str] = []
        trips = read_trip_slots(spark, [f["path"] for f in new if f["good"]], schema, broken)
        if trips is not None:
            table.load(_in_slots(trips), name)
        _note_files(spark, out, name, [(f, NO_PARQUET if f["path"] in broken else None if f["good"] else NO_SLOT) for f in new])

    return (
        _listing(_landed(spark.readStream.option("maxFilesPerTrigger", files_per_batch), landing))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _landed(reader: DataFrameReader | DataStreamReader, landing: str) -> DataFrame:
    """Landed files by name, length and time; contents are not read where they are not asked for."""
    listing = reader.schema(LISTING).format("binaryFile").option("recursiveFileLookup", "true")
    return listing.option("pathGlobFilter", "*.parquet").load(landing)


def republished_files(spark: SparkSession, landing: str, out: str) -> DataFrame:
    """Landed files that are not as they were loaded: ``path, slot columns, change`` (changed, new or gone).

    A file that is gone counts where its slot has other files: the slot was published under other names. A slot that
    has been cleared away keeps its rows.
    """
    landed = _listing(_landed(spark.read, landing)).withColumn("_there", F.lit(True))
    known = known_files(spark, out).withColumnsRenamed({"length": "_length", "modified": "_modified"})
    both = landed.join(known, "path", "full_outer").withColumns(slot_of_path(F.col("path")))
    same = F.col("length").eqNullSafe(F.col("_length")) & F.col("modified").eqNullSafe(F.col("_modified"))
    change = (
        F.when(F.col("_there").isNull(), F.when(F.coalesce("reason", F.lit("")) != GONE, "gone"))
        .when(F.col("load").isNull(), "new")
        .when(~same, "changed")
    )
    in_slot = F.max("_there").over(Window.partitionBy(*SLOT))
    marked = both.filter(F.col(SLOT[0]) != "").withColumns({"change": change, "_slot_there": in_slot})
    return marked.filter("change IS NOT NULL AND _slot_there").select("path", *SLOT, "change")


def reload_republished(
    spark: SparkSession, landing: str, schema: T.StructType, out: str, files_per_batch: int = 1000
) -> list[tuple[str, ...]]:
    """Load anew each slot whose files are not as they were loaded, in place of its older rows; gives the slots.

    For when the stream has taken all files that it has not seen. A path that the stream has seen is never given again,
    whatever is published there, so the listing is compared with the notes of the loads. A slot with a file that is no
    Parquet file keeps its rows, and the file is listed by :func:`rejected_files`. Slots are replaced in groups
    of about ``files_per_batch`` files; a run that breaks off is made up for by the next.
    """
    table = WideningTable(spark, out, SLOT)
    changes = republished_files(spark, landing, out)
    listed = _listing(_landed(spark.read, landing)).withColumns(slot_of_path(F.col("path")))
    slots = changes.select(*SLOT).distinct()
    counted = listed.join(slots, SLOT, "left_semi").groupBy(*SLOT).count().orderBy(*SLOT).collect()
    replaced: list[tuple[str, ...]] = []
    for group in _groups([(tuple(r[c] for c in SLOT), r["count"]) for r in counted], files_per_batch):
        wanted = spark.createDataFrame(group, ", ".join(f"{c} string" for c in SLOT))
        files = listed.join(wanted, SLOT, "left_semi").orderBy("path").collect()
        gone = changes.filter("change = 'gone'").join(wanted, SLOT, "left_semi").collect()
        name = "again-" + hashlib.sha256(repr([tuple(f) for f in files]).encode()).hexdigest()[:32]
        broken: list[str] = []
        trips = read_trip_slots(spark, [f["path"] for f in files], schema, broken)
        kept = {tuple(f[c] for c in SLOT) for f in files if f["path"] in broken}
        done = [slot for slot in group if slot not in kept]
        if done and trips is not None:
            rows = _in_slots(trips)
            if kept:
                rows = rows.join(spark.createDataFrame(done, wanted.schema), SLOT, "left_semi")
            table.replace(rows, name, done)
            replaced += done
        left = [Row(path=g["path"], length=None, modified=None) for g in gone if tuple(g[c] for c in SLOT) not in kept]
        taken = [(f, None) for f in files if tuple(f[c] for c in SLOT) not in kept]
        _note_files(spark, out, name, [*taken, *[(f, NO_PARQUET) for f in files if f["path"] in broken], *[(f, GONE) for f in left]])
    return replaced


def _groups(slots: list[tuple[tuple[str, ...], int]], files: int) -> Iterator[list[tuple[str, ...]]]:
    """Slots in groups of about as many files."""
    group: list[tuple[str, ...]] = []
    held = 0
    for slot, n in slots:
        if group and held + n > files:
            yield group
            group, held = [], 0
        group.append(slot)
        held += n
    if group:
        yield group


def ingest_drifting(
    spark: SparkSession, landing: str, schema: T.StructType, out: str, checkpoint: str, files_per_batch: int = 1000
) -> list[tuple[str, ...]]:
    """Load new files, then the slots that were published again; gives the latter."""
    ingest_drifting_stream(spark, landing, schema, out, checkpoint, files_per_batch).awaitTermination()
    return reload_republished(spark, landing, schema, out, files_per_batch)


def read_drifting(spark: SparkSession, out: str) -> DataFrame:
    """Rows that :func:`ingest_drifting_stream` loaded, in the newest schema. Slot columns are text."""
    return WideningTable(spark, out, SLOT).read()


def rejected_files(spark: SparkSession, out: str) -> DataFrame:
    """``path`` and ``reason`` of every landed file that was not loaded."""
    return known_files(spark, out).filter(F.col("reason") != GONE).select("path", "reason")


def failed_slots(spark: SparkSession, out: str) -> DataFrame:
    """Slots with a file that was not loaded, for the load summary."""
    slots = rejected_files(spark, out).select(*[c.alias(n) for n, c in slot_of_path(F.col("path")).items()])
    return slots.filter(F.col(SLOT[0]) != "").distinct()
