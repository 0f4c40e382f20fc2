"""A dimension stored by its changes, and appends with their columns beside them."""

import pytest
from pyspark.sql import functions as F

from citylake import schemas
from citylake.plans.versions import VersionedDimension
from citylake.schemas import SchemaMismatch
from citylake.sources.sinks import append_evolving, read_evolving
from citylake.sources.store import names
from tests.conftest import values

FIRST = [(1, "Queens", "Astoria", "Boro"), (2, "Bronx", "Mott", None), (None, None, "Nowhere", None)]


def lookup(spark, rows):
    return spark.createDataFrame(rows, schemas.DIM_ZONE)


@pytest.fixture
def zones(spark, tmp_path):
    return VersionedDimension(spark, str(tmp_path / "zones"), ["location_id"], schemas.DIM_ZONE)


def test_a_renamed_zone_writes_one_row(spark, zones):
    assert zones.version() == 0 and zones.current().count() == 0
    assert zones.load(lookup(spark, FIRST)) == 3
    assert zones.load(lookup(spark, FIRST + FIRST)) == 0 and zones.version() == 1
    renamed = [FIRST[0], (2, "Bronx", "Mott Haven", None), FIRST[2]]
    assert zones.load(lookup(spark, renamed)) == 1
    assert values(zones.history().filter("version = 2"), "location_id", "zone_name", "gone") == [(2, "Mott Haven", False)]
    assert values(zones.current()) == values(lookup(spark, renamed))
    assert values(zones.current(1)) == values(lookup(spark, FIRST))


def test_keys_that_go_and_come_back(spark, zones):
    zones.load(lookup(spark, FIRST))
    assert zones.load(lookup(spark, FIRST[:1])) == 2
    assert values(zones.current()) == [FIRST[0]]
    assert zones.load(lookup(spark, FIRST)) == 2 and values(zones.current()) == values(lookup(spark, FIRST))
    assert zones.load(lookup(spark, [])) == 3 and zones.current().count() == 0


def test_of_rows_with_one_key_the_first_counts(spark, zones):
    zones.load(lookup(spark, [(1, "B", "x", "y"), (1, "A", "z", "y"), (1, "A", "x", "y")]))
    assert values(zones.current()) == [(1, "A", "x", "y")]
    assert zones.load(lookup(spark, [(1, "A", "x", "y"), (1, "C", "x", "y")])) == 0


def test_a_load_that_breaks_off_changes_nothing(spark, zones):
    zones.load(lookup(spark, FIRST))
    broken = lookup(spark, FIRST).withColumn("zone_name", F.expr("if(location_id = 2, raise_error('broken'), 'other')").cast("string"))
    with pytest.raises(Exception, match="broken"):
        zones.load(broken)
    assert values(zones.current()) == values(lookup(spark, FIRST))
    again = VersionedDimension(spark, zones.path, ["location_id"], schemas.DIM_ZONE)
    assert again.load(lookup(spark, FIRST[:2])) == 1 and values(again.current()) == values(lookup(spark, FIRST[:2]))
    with pytest.raises(SchemaMismatch):
        again.load(lookup(spark, FIRST).withColumn("extra", F.lit(1)))


def test_appends_keep_their_columns_beside_the_rows(spark, tmp_path):
    path = str(tmp_path / "evolving")
    append_evolving(spark.createDataFrame([(1, "a")], "id int, part string"), path, ["part"])
    append_evolving(spark.createDataFrame([(2, 0.5, "b")], "id int, fee double, part string"), path, ["part"])
    append_evolving(spark.createDataFrame([(3, "b")], "id int, part string"), path, ["part"])
    read = read_evolving(spark, path)
    assert values(read, "id", "fee", "part") == [(1, None, "a"), (2, 0.5, "b"), (3, None, "b")]
    with pytest.raises(SchemaMismatch):
        append_evolving(spark.createDataFrame([("x", "a")], "id string, part string"), path, ["part"])
    assert read_evolving(spark, path).count() == 3 and "_columns.json" in names(spark, path)


def test_rows_from_before_the_columns_were_noted_are_read(spark, tmp_path):
    path = str(tmp_path / "old")
    spark.createDataFrame([(1,)], "id int").write.parquet(path)
    assert values(read_evolving(spark, path)) == [(1,)]
    append_evolving(spark.createDataFrame([(2, True)], "id int, new boolean"), path)
    assert values(read_evolving(spark, path)) == [(1, None), (2, True)]
