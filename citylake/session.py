"""Session settings, shuffle sizing and the place for durable intermediate data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Bytes of input one shuffle partition should stand for. What is shuffled is smaller: pruned columns.
TARGET_PARTITION_BYTES = 256 * 1024 * 1024

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # With this on, a union of two differences of sets gave 5 rows in 4.1.2 where 1 is right, with adaptive execution and
    # without; with it off, 1. The cause inside Spark is not known here.
    "spark.sql.unionOutputPartitioning": "false",
    # Recording the Python line of every column expression doubles the time to build a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}

RESULT_SETTINGS = ["spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.unionOutputPartitioning"]


def build_session(app: str = "citylake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the layers rely on; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings that results depend on to a session somebody else built."""
    for key in RESULT_SETTINGS:
        spark.conf.set(key, DEFAULTS[key])
    return spark


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes below the given paths, from file status only."""
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(hadoop_conf)
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files a query reads. Spark has listed them already; nothing is listed again."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(n for n in sizes if n < 1 << 60)  # a leaf of unknown size counts as nothing


def session_for(spark: SparkSession) -> SparkSession:
    """A session of its own for one query or run: settings made for it do not reach the caller or the next query."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    return prepare(own)


def shuffle_partitions_for(input_bytes: int, floor: int, most: int = 32_768) -> int:
    """Partitions so that each holds about ``TARGET_PARTITION_BYTES`` of the input, ``most`` of them at most."""
    needed = -(-input_bytes // TARGET_PARTITION_BYTES)
    return int(min(max(floor, needed), most))


def size_for(
    spark: SparkSession, input_bytes: int, max_shuffle_partitions: int = 32_768, max_scan_tasks: int = 100_000
) -> tuple[int, int]:
    """Raise shuffle partitions and scan splits of a session to fit an input: ``(partitions, split bytes)``.

    Use it on a session made by ``session_for``. Adaptive execution merges partitions that turn out small. The driver
    keeps a few bits per pair of map task and shuffle partition, so both counts are bounded by the arguments: from
    8 TB of input on, partitions grow beyond their target (3 GB of input each at 100 TB), and from 12 TB on,
    splits do (1 GB each). What does not fit in memory is spilled; no rows are lost. Raise the bounds with the
    driver's memory.
    """
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = shuffle_partitions_for(input_bytes, partitions, max_shuffle_partitions)
    if wanted > partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    split = _bytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    wanted_split = -(-input_bytes // max_scan_tasks)
    if wanted_split > split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", f"{wanted_split}b")
    return wanted, max(split, wanted_split)


@contextmanager
def sized(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """For a run that acts: the session fits the input and gives the library's results, and is as before afterwards."""
    keys = [*RESULT_SETTINGS, "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"]
    before = {key: spark.conf.get(key) for key in keys}
    try:
        size_for(prepare(spark), input_bytes)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# Files that a task keeps open at once when it writes files of one slot each.
OPEN_FILES = 64


@contextmanager
def files_kept_open(spark: SparkSession) -> Iterator[None]:
    """For a write by slot of rows that lie together by slot: a task keeps a file open for each slot it meets.

    Spark would else sort the rows of every task by slot, and hold all of them for that. Rows of slots beyond
    ``OPEN_FILES`` in one task are still sorted. A stream looks at the setting in each batch, so it needs a session where it stays.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def listed_in_groups(spark: SparkSession) -> Iterator[None]:
    """For reading very many folders: a task lists many of them. Spark would start one for each, up to 10,000."""
    key = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), 8 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _bytes(text: str) -> int:
    """Number of bytes of a setting such as ``134217728b`` or ``128MB``."""
    number = text.lower().rstrip("b")
    scale = {"k": 10, "m": 20, "g": 30}.get(number[-1:], 0)
    return int(number.rstrip("kmg")) << scale


def durable_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and staged tables, which outlives any executor.

    It is the checkpoint folder of the context if one is set, else the one that ``spark.checkpoint.dir`` names. Only a
    local master may fall back to a folder of its own, because there driver and executors are the same machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            if not context.master.startswith("local") or context.master.startswith("local-cluster"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="citylake-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def durable_checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows are fixed on shared storage and survive lost executors."""
    durable_root(df.sparkSession)
    return df.checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """New, unique folder below the shared root."""
    return f"{durable_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
