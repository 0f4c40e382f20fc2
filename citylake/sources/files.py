"""Readers of landed files. Schemas are given, so no pass over the data infers them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake import schemas
from citylake.functions import cast_to, nan_to_null
from citylake.operators.conform import union_conformed
from citylake.session import listed_in_groups
from citylake.sources.store import conformed_to, is_parquet, widened


def read_trips(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = schemas.TRIP) -> DataFrame:
    """Trip files that share one set of types; absent columns are NULL."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)


def read_trip_slots(
    spark: SparkSession, paths: Iterable[str], schema: T.StructType = schemas.TRIP, broken: list[str] | None = None
) -> DataFrame | None:
    """Trip files whose columns drift, e.g. passengers as a long in one month and a double in another.

    Known columns are cast to ``schema``, unknown ones are kept in a type that holds them in all files, and the
    file each row came from is added as ``source_file``. A file that is no Parquet file raises; with a list for
    ``broken`` it is added to the list and left out instead, and the result is None if no file is left.
    """
    groups = _alike(spark, sorted(paths), broken)
    if not groups:
        return None
    target = {f.name: f.dataType.simpleString() for f in schema.fields}
    parts = [
        raw.select(
            *[cast_to(c, target[c]).alias(c) if c in target else F.col(c) for c in raw.columns],
            F.col("_metadata.file_path").alias("source_file"),
        )
        for raw in groups
    ]
    common = widened(*[p.schema for p in parts])
    return union_conformed(*[conformed_to(p, common) for p in parts])


def _alike(spark: SparkSession, ordered: list[str], broken: list[str] | None = None) -> list[DataFrame]:
    """Files as a few DataFrames, each of files whose types agree.

    Spark merges the footers of all files in one job; only where types conflict or a footer cannot be read is the list
    of files halved, so the reads are about as many as the changes of type over the months. Any other failure of a
    single file, a storage that does not answer for instance, is raised.
    """
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*ordered)] if ordered else []
    except (PySparkException, Py4JJavaError) as error:  # which of them depends on who calls
        if len(ordered) == 1:
            if broken is None or is_parquet(spark, ordered[0]):
                raise
            broken.append(ordered[0])
            return []
        if broken is None and "CANNOT_MERGE" not in str(error):
            raise
        half = len(ordered) // 2
        return _alike(spark, ordered[:half], broken) + _alike(spark, ordered[half:], broken)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV under snake-case names."""
    raw = spark.read.schema(schemas.ZONE_CSV).option("header", "true").csv(path)
    return raw.withColumnsRenamed({"LocationID": "location_id", "Borough": "borough", "Zone": "zone_name"})


def read_fx(spark: SparkSession, path: str) -> DataFrame:
    """Exchange-rate CSV; columns are found by header name, an absent rate is NULL and never NaN."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(
        "TIME_PERIOD", "CURRENCY", nan_to_null(cast_to("OBS_VALUE", "double")).alias("OBS_VALUE")
    )


# What is wrong with a document. One of another type is loaded as far as it fits, others are not.
NO_JSON, OTHER_TYPE, NO_CONTENT = "not JSON", "a value of another type", "no "


def checked_documents(spark: SparkSession, path: str, schema: T.StructType, content: str) -> DataFrame:
    """Documents, one per file, with ``source_file`` and ``reason``: NULL for a good one.

    ``content`` is the field that a document is there for. A text that is no JSON, a document without that field (an
    error message of the source, a bare list or number) and one with a value of another type are told apart. Files
    without a byte hold no document and give no row.
    """
    text = "_broken"
    reader = (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(text, T.StringType())]))
        .option("multiLine", "true")
        .option("columnNameOfCorruptRecord", text)
    )
    with listed_in_groups(spark):  # when the reader is made, and not later
        docs = reader.json(path)
    is_json = F.expr(f"try_parse_json({text})").isNotNull()
    reason = (
        F.when(F.col(text).isNotNull() & ~is_json, NO_JSON)
        .when(F.col(content).isNull(), NO_CONTENT + content)
        .when(F.col(text).isNotNull(), OTHER_TYPE)
    )
    return docs.withColumns({"source_file": F.col("_metadata.file_path"), "reason": reason}).drop(text)


def checked_gdp(spark: SparkSession, path: str) -> DataFrame:
    """GDP documents ``[meta, rows]`` as their ``rows``, with ``source_file`` and ``reason`` as in :func:`checked_documents`."""
    text = spark.read.text(path, wholetext=True)
    rows = _rows_of_meta_array("value", schemas.GDP_ROW)
    reason = F.when(F.expr("try_parse_json(value)").isNull(), NO_JSON).when(F.col("rows").isNull(), NO_CONTENT + "rows")
    return text.select(rows.alias("rows"), F.col("_metadata.file_path").alias("source_file"), "value").select(
        "rows", "source_file", reason.alias("reason")
    )


def loaded_documents(docs: DataFrame) -> DataFrame:
    """Of checked documents those that can be loaded, without what the check has added."""
    return docs.filter(F.col("reason").isNull() | (F.col("reason") == OTHER_TYPE)).drop("source_file", "reason")


def rejected_documents(docs: DataFrame) -> DataFrame:
    """Of checked documents the files with something wrong: ``source_file, reason, loaded``."""
    wrong = docs.filter(F.col("reason").isNotNull())
    return wrong.select("source_file", "reason", (F.col("reason") == OTHER_TYPE).alias("loaded"))


def read_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Forecast documents, one per file; what is none is left out (:func:`checked_forecast` lists it)."""
    return loaded_documents(checked_forecast(spark, path))


def checked_forecast(spark: SparkSession, path: str) -> DataFrame:
    """Forecast documents, checked."""
    return checked_documents(spark, path, schemas.FORECAST, "list")


def read_sensor_locations(spark: SparkSession, path: str) -> DataFrame:
    """Location documents with their nested sensors."""
    return loaded_documents(checked_sensor_locations(spark, path))


def checked_sensor_locations(spark: SparkSession, path: str) -> DataFrame:
    """Location documents, checked."""
    return checked_documents(spark, path, schemas.SENSOR_LOCATIONS, "results")


def read_sensor_days(spark: SparkSession, path: str) -> DataFrame:
    """Documents of daily values, landed in ``sensor_id=<id>`` folders."""
    return loaded_documents(checked_sensor_days(spark, path))


def checked_sensor_days(spark: SparkSession, path: str) -> DataFrame:
    """Documents of daily values, checked."""
    return checked_documents(spark, path, schemas.SENSOR_DAYS, "results")


def read_gdp(spark: SparkSession, path: str) -> DataFrame:
    """GDP documents of the form ``[meta, rows]``."""
    return gdp_of(checked_gdp(spark, path))


def gdp_of(docs: DataFrame) -> DataFrame:
    """Rows of checked GDP documents."""
    return loaded_documents(docs).select(F.inline("rows"))


def _rows_of_meta_array(column: str, element_schema: T.StructType) -> Column:
    return F.from_json(F.get_json_object(column, "$[1]"), T.ArrayType(element_schema))


def rows_of_meta_array(df: DataFrame, column: str, element_schema: T.StructType) -> DataFrame:
    """Rows held by the second element of a two-element JSON array text."""
    return df.select(F.inline(_rows_of_meta_array(column, element_schema)))


def flatten_sensors(docs: DataFrame) -> DataFrame:
    """One row per sensor; documents without results and places without sensors give none."""
    places = docs.select(F.explode("results").alias("place"))
    sensors = places.select("place", F.explode("place.sensors").alias("sensor"))
    return sensors.select(
        F.col("sensor.id").alias("id"),
        F.col("sensor.parameter.name").alias("parameter"),
        F.col("sensor.parameter.units").alias("unit"),
        F.col("place.coordinates.latitude").alias("lat"),
        F.col("place.coordinates.longitude").alias("lon"),
        F.col("place.name").alias("location_name"),
    )


def flatten_days(docs: DataFrame, date_field: str = "datetimeTo") -> DataFrame:
    """One row per sensor and day, dated by the end of the period unless told otherwise."""
    return docs.select("sensor_id", F.explode("results").alias("day")).select(
        "sensor_id", F.col("day.value").alias("value"), F.col(f"day.period.{date_field}.utc").alias("date_utc")
    )


def rows_df(spark: SparkSession, rows: Sequence[tuple | dict], schema: T.StructType | str) -> DataFrame:
    """Small configuration rows of the driver as a DataFrame; an empty list is an empty table."""
    return spark.createDataFrame(list(rows), schema)
