"""A dimension that is stored as the rows each load has changed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.conform import dedup
from citylake.schemas import enforce_schema
from citylake.sources.store import exists, read_text, remove, write_text

VERSION, GONE = "version", "gone"


class VersionedDimension:
    """Rows by ``keys`` at ``path``. A load writes what is new, what has other attributes, and which keys are gone.

    Of rows with one key the first by its attributes counts; NULL is a key and a value like any other. A version counts from
    the moment the small file with the last version's number names it, so a load that breaks off changes nothing and is repeated.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], schema: T.StructType):
        self.spark, self.path, self.keys, self.schema = spark, path.rstrip("/"), list(keys), schema
        self.attributes = [f.name for f in schema.fields if f.name not in self.keys]

    @property
    def _last(self) -> str:
        return f"{self.path}/_last.txt"

    def version(self) -> int:
        """Number of the last version; 0 before the first load."""
        return int(read_text(self.spark, self._last)) if exists(self.spark, self._last) else 0

    def history(self, version: int | None = None) -> DataFrame:
        """All changes up to a version, with its number and whether the key is gone by it."""
        upto = self.version() if version is None else version
        stored = T.StructType([*self.schema.fields, T.StructField(GONE, T.BooleanType())])
        if not upto:
            return self.spark.createDataFrame([], T.StructType([*stored.fields, T.StructField(VERSION, T.IntegerType())]))
        parts = [f"{self.path}/{VERSION}={v}" for v in range(1, upto + 1)]
        read = self.spark.read.option("basePath", self.path).schema(T.StructType([*stored.fields, T.StructField(VERSION, T.IntegerType())]))
        return read.parquet(*parts)

    def current(self, version: int | None = None) -> DataFrame:
        """The dimension as of a version: each key's last change, combined in the map tasks."""
        rest = [*self.attributes, GONE]
        last = self.history(version).groupBy(*self.keys).agg(F.max_by(F.struct(*rest), VERSION).alias("_row"))
        live = last.filter(~F.col(f"_row.{GONE}"))
        return live.select(*[F.col(c) if c in self.keys else F.col(f"_row.{c}").alias(c) for c in self.schema.names])

    def load(self, rows: DataFrame) -> int:
        """Compare a whole lookup with the dimension and store what differs; the number of rows written. Acts.

        Nothing is stored, and no version made, where nothing differs.
        """
        version = self.version() + 1
        new = dedup(enforce_schema(rows, self.schema), self.keys).withColumn("_new", F.lit(True))
        old = self.current().withColumn("_old", F.lit(True)).select(*[F.col(c).alias(f"_{c}") for c in self.schema.names], "_old")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.keys]
        both = new.join(old, reduce(Column.__and__, same), "full")
        gone = F.col("_new").isNull()
        alike = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in self.attributes]
        kept = reduce(Column.__and__, alike, F.col("_new").isNotNull() & F.col("_old").isNotNull())
        changed = both.filter(~kept).select(
            *[F.when(gone, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in self.schema.names], gone.alias(GONE)
        )
        out = f"{self.path}/{VERSION}={version}"
        changed.write.mode("overwrite").parquet(out)
        written = self.spark.read.schema(changed.schema).parquet(out).count()
        if written:
            write_text(self.spark, self._last, str(version))
        else:
            remove(self.spark, out)
        return written
