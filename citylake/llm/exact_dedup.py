"""Exact de-duplication against a persistent index of digests.

The index is a folder of one row per text, bucketed and sorted by digest, with its layout in a small file beside the
rows; any session that opens the folder goes on where the last one stopped. A batch is reduced to one row per
digest, joined to the index by sort-merge anti-join, and what is new is appended. The index side of that join
is read as it lies: only the batch, some forty bytes per text, is shuffled.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm.common import ascii_lower, staged, text_of, whole_rows
from citylake.session import scanned_bytes, shuffle_partitions_for, staging_path
from citylake.sources.store import names, read_text, write_text

INDEX_SCHEMA = "digest binary, keep_id bigint"
LAYOUT = "_layout.json"


def buckets_for(docs: DataFrame) -> int:
    """Buckets for an index of these documents: one for each 256 MB of text files, and one a shuffle partition at least."""
    spark = docs.sparkSession
    return shuffle_partitions_for(scanned_bytes(docs), int(spark.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class DigestIndex:
    """Rows ``digest, keep_id`` at ``path`` in ``buckets`` buckets. Make or reopen it with :meth:`open`.

    The folder is the index. A session's catalog only gets an entry for it, named after the path, because Spark reads
    buckets through a table; :meth:`close` takes the entry away and leaves the folder.
    """

    spark: SparkSession
    path: str
    buckets: int

    @classmethod
    def open(cls, spark: SparkSession, path: str, buckets: int | None = None) -> DigestIndex:
        """The index at ``path``, made where there is none (64 buckets unless told).

        A number of buckets other than the one that the index was made with is refused, and so is a folder that holds
        something else. Rows that are there stay.
        """
        path = path.rstrip("/")
        held = names(spark, path)
        if LAYOUT in held:
            layout = json.loads(read_text(spark, f"{path}/{LAYOUT}"))["buckets"]
            if buckets not in (None, layout):
                raise ValueError(f"{path} has {layout} buckets, not {buckets}")
            buckets = layout
        elif held:
            raise ValueError(f"{path} is not empty and no digest index")
        else:
            buckets = buckets or 64
            write_text(spark, f"{path}/{LAYOUT}", json.dumps({"buckets": buckets}))
        return cls(spark, path, buckets)._registered()

    @classmethod
    def temporary(cls, spark: SparkSession, docs: DataFrame) -> DigestIndex:
        """New, empty index below the shared folder, with buckets for these documents."""
        return cls.open(spark, staging_path(spark, "digest-index"), buckets_for(docs))

    @property
    def name(self) -> str:
        return f"digest_index_{hashlib.sha256(self.path.encode()).hexdigest()[:24]}"

    def _registered(self) -> DigestIndex:
        at = self.path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({INDEX_SCHEMA}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{at}'"
        )
        self.spark.catalog.refreshTable(self.name)  # files may have come from another session
        return self

    def close(self) -> None:
        """Take the entry out of the catalog; the rows stay at the path."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of a batch (one per digest) that the index lacks: sort-merge anti-join on the buckets."""
        dealt = groups.repartition(self.buckets, "digest")
        return dealt.join(self.read().hint("merge"), "digest", "left_anti")

    def add(self, groups: DataFrame) -> None:
        """Append what is new. Adding a batch again adds nothing."""
        rows = self.unseen(groups).select("digest", "keep_id")
        rows.write.format("parquet").mode("append").bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name)


def digest_of(column: str = "text"):
    """SHA-256 of the UTF-8 text with A-Z lower-cased."""
    return F.unhex(F.sha2(ascii_lower(text_of(column)), 256))


def digests(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``digest`` of every row."""
    return docs.select("doc_id", digest_of().alias("digest"))


def batch_groups(rows: DataFrame) -> DataFrame:
    """One row per digest: the largest ``doc_id``, all rows, and the rows that carry that ``doc_id``.

    Both steps combine before they shuffle, so a text that a third of all rows share is no hot key.
    """
    by_id = rows.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return by_id.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"),
        F.sum("n").alias("group_size"),
        F.coalesce(F.max_by("n", "doc_id"), F.sum("n")).alias("n_keep"),
    )


def load(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Add a batch's digests to the index. Gives its groups that the index lacked, as a written table."""
    fresh = staged(index.unseen(batch_groups(rows)), "fresh-digests")
    index.add(fresh)
    return fresh


def resolve(rows: DataFrame, index: DigestIndex) -> DataFrame:
    """Add a batch's digests to the index; per digest, the row that stays and whether it came with this batch."""
    fresh = load(rows, index)
    entries = batch_groups(rows).drop("keep_id").join(index.read(), "digest").join(
        fresh.select("digest", F.lit(True).alias("fresh")), "digest", "left"
    )
    return staged(entries.withColumn("fresh", F.coalesce("fresh", F.lit(False))), "digest-entries")


def _result(rows: DataFrame, entries: DataFrame) -> DataFrame:
    # Rows of a very frequent text meet one entry; both sides are plain shuffles, so AQE splits them.
    return rows.join(entries, "digest").select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("fresh") & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def annotate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """One row per document of a batch, with the id of the row that stays for its text.

    Null text equals empty text. Of equal texts in one batch the largest ``doc_id`` stays; a text that an
    earlier batch brought keeps that batch's id, and no row of the new batch stays. ``group_size`` counts the rows
    of the batch. A null ``doc_id`` loses against any other; rows that repeat a ``doc_id`` and its text are one
    document and all get its result. An empty batch gives no rows and leaves the index as it is. Very long texts are
    hashed whole. Further columns are not read.
    """
    rows = staged(digests(docs), "digests")
    return _result(rows, resolve(rows, index))


def annotate_table(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """As :func:`annotate` for a whole table and an index of its own, loaded in two batches, larger ids first.

    The ids are parted in the middle of their range. The second batch meets the first in the index, where the
    anti-join leaves its copies out; so the largest ``doc_id`` of the whole table stays, and ``group_size`` counts
    all its rows.
    """
    rows = staged(digests(docs), "digests")
    least, most = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    upper = F.col("doc_id") > F.lit(0 if least is None else (least + most) // 2)
    fresh = F.lit(True).alias("fresh")
    load(rows.filter(upper), index)
    load(rows.filter(~F.coalesce(upper, F.lit(False))), index)
    entries = batch_groups(rows).drop("keep_id").join(index.read(), "digest").select("digest", "keep_id", "group_size", fresh)
    return _result(rows, staged(entries, "digest-entries"))


def deduplicate(docs: DataFrame, index: DigestIndex) -> DataFrame:
    """The documents that stay, with all their columns; one of each text that the index lacked.

    Null text equals empty text; a null ``doc_id`` loses against any other, and a text of which all rows lack an id keeps
    one of them. Where rows repeat the ``doc_id`` and text that stay, one of them is taken (one of each if they differ in
    another column). No documents give no rows. Columns may have any names.
    """
    entries = resolve(digests(docs), index).filter("fresh").select("digest", "keep_id", "n_keep")
    rows = whole_rows(docs, "doc_id").withColumn("digest", digest_of("doc.text"))
    stays = rows["doc_id"].eqNullSafe(entries["keep_id"])
    single = rows.join(entries.filter("n_keep = 1"), "digest").filter(stays).select("doc.*")
    repeated = rows.join(entries.filter("n_keep > 1"), "digest").filter(stays).select("doc.*")
    return single.unionByName(repeated.dropDuplicates())
