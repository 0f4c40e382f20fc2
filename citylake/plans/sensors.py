"""Sensors and the history of their daily values, stored so that joining them shuffles nothing."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.plans.gold import drop_partitions, partitions
from citylake.sources.store import exists, names, read_text, write_text

PART, LOAD = "part", "load"
# The columns of both tables.
PLACES = "sensor_id bigint, location_name string, parameter string, unit string, lat double, lon double"
DAYS = "sensor_id bigint, value double, date_utc string"


class SensorHistory:
    """Sensors and daily values below ``path``, both in ``buckets`` buckets by sensor and part.

    A sensor's values are dealt over ``parts`` by their time, and its place is stored once for each part: so the values of one sensor that
    holds a large share of all rows lie in several buckets, and tasks. A join by sensor and part reads bucket beside bucket.
    The folder is the store: its layout lies beside the rows, and any session reopens it. Sensors without an id are left out,
    as they join nothing; so are values without one.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None, parts: int | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        note, asked = f"{self.path}/layout.json", {"buckets": buckets, "parts": parts}
        if exists(spark, note):
            layout = json.loads(read_text(spark, note))
            if unlike := [k for k, v in asked.items() if v not in (None, layout[k])]:
                raise ValueError(f"{path} has other {' and '.join(unlike)}: {layout}")
        elif names(spark, self.path):
            raise ValueError(f"{path} is not empty and no sensor history")
        else:
            layout = {"buckets": buckets or 64, "parts": parts or 8}
            write_text(spark, note, json.dumps(layout))
        self.buckets, self.parts = layout["buckets"], layout["parts"]
        tag = hashlib.sha256(self.path.encode()).hexdigest()[:24]
        self.places_table, self.days_table = f"sensor_places_{tag}", f"sensor_days_{tag}"
        self._register(self.places_table, PLACES, "places")
        self._register(self.days_table, DAYS, "days")

    def _register(self, name: str, columns: str, folder: str) -> None:
        at = f"{self.path}/{folder}".replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PART} int, {LOAD} string) USING parquet PARTITIONED BY ({LOAD}) "
            f"CLUSTERED BY (sensor_id, {PART}) SORTED BY (sensor_id, {PART}) INTO {self.buckets} BUCKETS LOCATION '{at}'"
        )
        if exists(self.spark, f"{self.path}/{folder}"):
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")  # loads may have come from another session
        self.spark.catalog.refreshTable(name)

    def close(self) -> None:
        """Take the entries out of the catalog; the rows stay at the path."""
        for name in (self.places_table, self.days_table):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _insert(self, rows: DataFrame, name: str, load: str) -> None:
        """Write one load, dealt as the table is, so that each bucket gets one file. A load repeated replaces itself."""
        key, conf = "spark.sql.sources.partitionOverwriteMode", rows.sparkSession.conf
        before = conf.get(key)
        dealt = rows.withColumn(LOAD, F.lit(load)).repartition(self.buckets, "sensor_id", PART)
        conf.set(key, "dynamic")
        try:
            dealt.select(*self.spark.table(name).columns).write.insertInto(name, overwrite=True)
        finally:
            conf.set(key, before)
        self.spark.catalog.refreshTable(name)  # the rows may be of another session

    def put_places(self, sensors: DataFrame) -> None:
        """Store the sensors, in place of those stored before. Acts."""
        every = F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1)))
        rows = sensors.filter("id IS NOT NULL").withColumnRenamed("id", "sensor_id")
        if rows.isEmpty():
            gone = partitions(self.spark, self.places_table)
            drop_partitions(self.spark, self.places_table, [LOAD], gone)
            return
        self._insert(rows.withColumn(PART, every), self.places_table, "all")

    def add_days(self, days: DataFrame, load: str) -> None:
        """Add daily values under the name of their load; other loads are neither read nor written. Acts."""
        dealt = F.pmod(F.xxhash64("date_utc"), F.lit(self.parts)).cast("int")
        self._insert(days.filter("sensor_id IS NOT NULL").withColumn(PART, dealt), self.days_table, load)

    def measurements(self, load: str | None = None) -> DataFrame:
        """Values with the place and parameter of their sensor: of all loads, or of one, whose files alone are read."""
        days = self.spark.table(self.days_table)
        if load is not None:
            days = days.filter(F.col(LOAD) == load)
        places = self.spark.table(self.places_table).drop(LOAD)
        return days.join(places, ["sensor_id", PART]).select(
            "sensor_id", "location_name", "parameter", "lat", "lon", "value", "unit", "date_utc"
        )
