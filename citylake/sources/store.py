"""Small files beside the data, and tables whose columns and types widen over the loads.

A widening table keeps each version of its schema as a small file, and every load under the version it was written
with. Older loads are read with their own version's schema and cast to the newest, so no read merges
footers, and no file is read with a type it was not written with. A load can also take the place of what older loads
hold of some slots.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.operators.conform import union_conformed
from citylake.session import files_kept_open


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run has staged."""
    fs, p = _file(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Give a staged folder its place."""
    fs, p = _file(spark, path)
    _, target = _file(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(p, target):
        raise OSError(f"{path} could not be renamed to {to}")


def is_parquet(spark: SparkSession, path: str) -> bool:
    """Whether a file has the length and the closing mark of a Parquet file."""
    fs, p = _file(spark, path)
    length = fs.getFileStatus(p).getLen()
    if length < 12:
        return False
    stream = fs.open(p)
    try:
        stream.seek(length - 4)
        return bytes(stream.read() for _ in range(4)) == b"PAR1"
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no folder."""
    fs, p = _file(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file: under another name first, so that a reader never sees half of it."""
    fs, p = _file(spark, path)
    _, part = _file(spark, f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    fs.rename(part, p)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, p = _file(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


_NUMBERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrower of the types that hold the values of both: numbers up to double, else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if type(a) in _NUMBERS and type(b) in _NUMBERS:
        widest = max(_NUMBERS.index(type(a)), _NUMBERS.index(type(b)))
        return T.DoubleType() if widest >= _NUMBERS.index(T.FloatType) else _NUMBERS[widest]()
    return T.StringType()


def widened(*schemas: T.StructType) -> T.StructType:
    """All columns of all schemas, each with a type that holds it everywhere."""

    def both(a: T.StructType, b: T.StructType) -> T.StructType:
        types = {f.name: f.dataType for f in a.fields}
        for f in b.fields:
            types[f.name] = wider(types[f.name], f.dataType) if f.name in types else f.dataType
        return T.StructType([T.StructField(n, t) for n, t in types.items()])

    return reduce(both, schemas, T.StructType([]))


def conformed_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``, cast where they are narrower, NULL where they are absent."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


class WideningTable:
    """Rows of loads at ``path``, partitioned by ``slot`` (text columns)."""

    def __init__(self, spark: SparkSession, path: str, slot: list[str]):
        self.spark, self.path, self.slot = spark, path.rstrip("/"), slot

    def versions(self) -> list[int]:
        return sorted(int(n.removesuffix(".json")) for n in names(self.spark, f"{self.path}/_schemas") if n.endswith(".json"))

    def schema(self, version: int) -> T.StructType:
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.path}/_schemas/{version}.json")))

    def _fitted(self, rows: DataFrame, name: str) -> tuple[DataFrame, str]:
        """Rows in the newest schema, and the folder of their load; new columns and wider types make a version."""
        self._settle()
        versions = self.versions()
        old = self.schema(versions[-1]) if versions else T.StructType([])
        new, version = widened(old, rows.schema), versions[-1] if versions else 0
        if new != old:
            version += 1
            write_text(self.spark, f"{self.path}/_schemas/{version}.json", new.json())
        for other in versions:
            if other != version:  # the load may have been written before a version it caused itself
                remove(self.spark, f"{self.path}/version={other}/load={name}")
        return conformed_to(rows, new), f"{self.path}/version={version}/load={name}"

    def _write(self, rows: DataFrame, path: str) -> None:
        """Rows come from files of one slot each, so a task meets few slots."""
        with files_kept_open(rows.sparkSession):
            rows.write.mode("overwrite").partitionBy(*self.slot).parquet(path)

    def load(self, rows: DataFrame, name: str) -> None:
        """Write a load under its name. A repeated load replaces itself."""
        fitted, out = self._fitted(rows, name)
        self._write(fitted, out)

    def replace(self, rows: DataFrame, name: str, slots: Iterable[tuple[str, ...]]) -> None:
        """Write a load that takes the place of all that other loads hold of ``slots``.

        The rows are written where no reader looks. A note then says which folders they stand for, and holds from the
        moment the load is renamed to its place: readers see the old rows or the new ones. The old folders are removed
        last, by the next load if this run breaks off.
        """
        fitted, out = self._fitted(rows, name)
        hidden = f"{self.path}/_replacing/{name}"
        self._write(fitted, hidden)
        gone = [[load, *slot] for load, slot, _ in self._held(set(slots)) if load != name]
        write_text(self.spark, self._note, json.dumps({"load": out.removeprefix(f"{self.path}/"), "gone": gone}))
        remove(self.spark, out)
        rename(self.spark, hidden, out)
        self._settle()

    @property
    def _note(self) -> str:
        return f"{self.path}/_replaced.json"

    def _gone(self) -> list[list[str]]:
        """``[load, *slot]`` of what a load has replaced and is not removed yet."""
        if not exists(self.spark, self._note):
            return []
        note = json.loads(read_text(self.spark, self._note))
        return note["gone"] if exists(self.spark, f"{self.path}/{note['load']}") else []

    def _settle(self) -> None:
        """Remove replaced folders, then the note on them."""
        gone = {tuple(g) for g in self._gone()}
        for load, slot, folder in list(self._held({g[1:] for g in gone})):
            if (load, *slot) in gone:
                remove(self.spark, folder)
        if exists(self.spark, self._note):
            remove(self.spark, self._note)

    def _held(self, slots: set[tuple[str, ...]]) -> Iterator[tuple[str, tuple[str, ...], str]]:
        """Load, slot and folder of everything that loads hold of ``slots``. Lists folders only."""

        def below(folder: str, slot: tuple[str, ...]) -> Iterator[tuple[tuple[str, ...], str]]:
            if len(slot) == len(self.slot):
                yield slot, folder
                return
            column = f"{self.slot[len(slot)]}="
            for name in names(self.spark, folder):
                deeper = (*slot, unquote(name.removeprefix(column)))
                if name.startswith(column) and deeper in starts:
                    yield from below(f"{folder}/{name}", deeper)

        starts = {slot[:n] for slot in slots for n in range(len(self.slot) + 1)}
        for version in self.versions() if slots else []:
            for name in names(self.spark, f"{self.path}/version={version}"):
                if name.startswith("load="):
                    for slot, folder in below(f"{self.path}/version={version}/{name}", ()):
                        yield name.removeprefix("load="), slot, folder

    def loads(self) -> list[str]:
        """Names of all loads."""
        found = [names(self.spark, f"{self.path}/version={v}") for v in self.versions()]
        return sorted(n.removeprefix("load=") for part in found for n in part if n.startswith("load="))

    def read(self, with_load: bool = False) -> DataFrame:
        """All rows, in the newest schema; ``with_load`` adds the name of each row's load."""
        versions, parts = self.versions(), []
        if not versions:
            raise ValueError(f"nothing has been loaded to {self.path}")
        load = [T.StructField("load", T.StringType())]
        newest = T.StructType([*self.schema(versions[-1]).fields, *(load if with_load else [])])
        for version in versions:
            root = f"{self.path}/version={version}"
            if exists(self.spark, root):
                own = T.StructType([*self.schema(version).fields, *load])
                rows = self.spark.read.schema(own).parquet(root)
                parts.append(conformed_to(rows.filter(self._is_live()), newest))
        return union_conformed(*parts)

    def _is_live(self) -> Column:
        """Rows that no load has replaced; looks at partition columns only."""
        replaced = [
            reduce(lambda a, b: a & b, [F.col(c) == v for c, v in zip(["load", *self.slot], gone)]) for gone in self._gone()
        ]
        return ~reduce(lambda a, b: a | b, replaced, F.lit(False))
