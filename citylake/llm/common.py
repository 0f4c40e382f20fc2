"""Helpers that the operators of this package share."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.session import staging_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send a module's functions to the workers by value, so that they need not have the library installed."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write rows to a new folder on shared storage and read them back.

    What is computed once stays fixed (row ids, ranks) and survives lost executors.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text of a document; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else.

    ``lower`` also changes other letters, but is much faster, and right where all characters are ASCII.
    """
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def whole_rows(docs: DataFrame, *columns: str) -> DataFrame:
    """``doc`` holds every column of a row, beside the named ones the operator works on.

    Columns the operator adds cannot clash with those of the caller, whatever they are called.
    """
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), *[docs[c] for c in columns])


ship(__name__)
