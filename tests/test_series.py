import datetime as dt
import random
import uuid

import pytest

from pyspark.sql import functions as F

from citylake.operators.series import forward_fill, forward_fill_bucketed, forward_fill_by_period
from citylake.plans.filled import FilledSeries
from citylake.plans.dimensions import dim_fx
from citylake.plans import filled as filled_module
from citylake.sources.sinks import overwrite_partitions, overwrite_table
from tests.conftest import plan_of, values

SCHEMA = "k string, d int, id int, v double"


def fixture(spark):
    rows = [
        ("a", 1, 1, None),
        ("a", 2, 2, 1.0),
        ("a", 3, 3, None),
        ("a", 3, 4, None),
        ("a", 5, 5, 2.0),
        ("a", 6, 6, None),
        ("b", 1, 7, None),
        ("b", 2, 8, None),
        (None, 1, 9, 4.0),
        (None, 2, 10, None),
    ]
    return spark.createDataFrame(rows, SCHEMA)


EXPECTED = {1: None, 2: 1.0, 3: 1.0, 4: 1.0, 5: 2.0, 6: 2.0, 7: None, 8: None, 9: 4.0, 10: 4.0}


def test_forward_fill_carries_the_last_value_and_leaves_leading_nulls(spark):
    filled = forward_fill(fixture(spark), ["k"], ["d", "id"], "v")
    assert dict(values(filled, "id", "v")) == EXPECTED
    again = forward_fill(filled, ["k"], ["d", "id"], "v")
    assert dict(values(again, "id", "v")) == EXPECTED


def test_bucketed_fill_equals_plain_fill_for_any_slicing(spark):
    for buckets in (1, 3, 10):
        filled = forward_fill_bucketed(fixture(spark), ["k"], ["d", "id"], "v", buckets)
        assert filled.columns == ["k", "d", "id", "v"]
        assert dict(values(filled, "id", "v")) == EXPECTED


def test_bucketed_fill_of_one_dominating_key(spark):
    rng = random.Random(3)
    rows = [("hot", rng.randrange(40), i, None if rng.random() < 0.8 else float(i)) for i in range(4000)]
    rows += [(f"k{i % 50}", rng.randrange(40), 10_000 + i, None if i % 3 else 1.0) for i in range(500)]
    df = spark.createDataFrame(rows, SCHEMA)
    plain = forward_fill(df, ["k"], ["d", "id"], "v")
    sliced = forward_fill_bucketed(df, ["k"], ["d", "id"], "v", 16)
    assert values(sliced) == values(plain)


def test_bucketed_fill_broadcasts_fewer_rows_than_slices(spark):
    df = spark.range(2000).select(
        F.lit("hot").alias("k"), F.col("id").cast("int").alias("d"), "id", F.when(F.col("id") == 3, 1.0).alias("v")
    )
    filled = forward_fill_bucketed(df, ["k"], ["d", "id"], "v", 8)
    assert filled.filter("v IS NOT NULL").count() == 1997
    plan = plan_of(filled)
    assert "BroadcastHashJoin" in plan and "CartesianProduct" not in plan


def test_dim_fx_reads_dates_drops_bad_ones_and_fills_by_currency(spark):
    rows = [
        ("2024-01-02", "USD", 1.1),
        ("2024-01-01", "USD", None),
        ("2024-01-03", "USD", float("nan")),
        ("2024-01-05", "USD", None),
        ("2024-01-03", "GBP", 0.9),
        ("2024-01-04", "GBP", None),
        ("later", "GBP", 5.0),
    ]
    df = spark.createDataFrame(rows, "TIME_PERIOD string, CURRENCY string, OBS_VALUE double")
    day = lambda n: dt.date(2024, 1, n)
    expected = [
        (day(1), "USD", None),
        (day(2), "USD", 1.1),
        (day(3), "GBP", 0.9),
        (day(3), "USD", 1.1),
        (day(4), "GBP", 0.9),
        (day(5), "USD", 1.1),
    ]
    assert values(dim_fx(df)) == sorted(expected, key=lambda r: (r[0], r[1]))
    assert values(dim_fx(df, fill=forward_fill_bucketed)) == values(dim_fx(df))


def test_fill_by_period_equals_plain_fill(spark):
    for period in ("d", "d div 3", "1", "cast(null as int)"):
        filled = forward_fill_by_period(fixture(spark), ["k"], ["d", "id"], "v", period)
        assert filled.columns == ["k", "d", "id", "v"]
        assert dict(values(filled, "id", "v")) == EXPECTED
    odd = spark.createDataFrame([(None, None, 1, 2.0), (None, 3, 2, None), ("a", None, 3, None), ("a", 1, 4, float("nan")), ("a", 2, 5, None)], SCHEMA)
    assert str(values(forward_fill_by_period(odd, ["k"], ["d", "id"], "v", "d"))) == str(values(forward_fill(odd, ["k"], ["d", "id"], "v")))
    assert forward_fill_by_period(odd.limit(0), ["k"], ["d", "id"], "v", "d").count() == 0


def test_fill_by_period_cuts_a_hot_key_and_shuffles_its_rows_once(spark):
    rng = random.Random(4)
    rows = [("hot", rng.randrange(40), i, None if rng.random() < 0.9 else float(i)) for i in range(4000)]
    df = spark.createDataFrame(rows + [("cold", 1, 9000 + i, None) for i in range(9)], SCHEMA)
    filled = forward_fill_by_period(df, ["k"], ["d", "id"], "v", "d")
    assert values(filled) == values(forward_fill(df, ["k"], ["d", "id"], "v"))
    plan = plan_of(filled)
    rows_moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(k" in line and "_period" in line]
    assert len(rows_moved) == 1 and "partial_max_by" in plan  # closing values are found before they are shuffled
    assert "Join" not in plan and "Checkpoint" not in plan


def series_of(spark, tmp_path):
    tag = uuid.uuid4().hex
    return FilledSeries(spark, str(tmp_path / "note.json"), f"raw_{tag}", f"filled_{tag}", f"closings_{tag}", ["k"], ["d", "id"], "v")


def with_period(df):
    return df.withColumn("period", F.format_string("%02d", F.expr("d div 10")))


def expected_of(series):
    raw = series.spark.table(series.raw)
    return values(forward_fill(raw, ["k"], ["d", "id"], "v"), "k", "d", "id", "v")


def test_a_new_period_is_filled_alone_and_a_late_one_with_those_it_changes(spark, tmp_path):
    rows = [("a", 1, 1, 1.0), ("a", 11, 2, None), ("b", 11, 3, 5.0), ("a", 21, 4, None), ("a", 31, 5, 4.0), (None, 32, 6, None), ("a", 41, 7, None)]
    df, series = with_period(spark.createDataFrame(rows, SCHEMA)), series_of(spark, tmp_path)
    overwrite_table(df, series.raw, ["period"])

    def stored():
        return values(spark.table(series.filled), "k", "d", "id", "v")

    def files():
        found = spark.table(series.filled).select("period", F.col("_metadata.file_path")).distinct().collect()
        return {r[0]: r[1] for r in found}

    assert series.refresh() is None and stored() == expected_of(series)
    assert series.refresh() == []
    first = files()
    new = with_period(spark.createDataFrame([("a", 51, 8, None), ("b", 52, 9, None)], SCHEMA))
    overwrite_partitions(new, series.raw, ["period"])
    assert series.refresh() == ["05"] and stored() == expected_of(series)
    assert {p: f for p, f in files().items() if p != "05"} == first
    # A late value reaches the periods up to the next known value, and no further.
    overwrite_partitions(with_period(spark.createDataFrame([("a", 11, 2, 7.0), ("b", 11, 3, 5.0)], SCHEMA)), series.raw, ["period"])
    assert series.refresh() == ["01", "02", "03"] and stored() == expected_of(series)
    assert files()["04"] == first["04"]
    # A period that goes takes its values with it.
    spark.sql(f"alter table {series.raw} drop partition (period = '03')")
    assert series.refresh() == ["03", "04", "05"] and stored() == expected_of(series)


def test_a_fill_that_breaks_off_is_made_up_for(spark, tmp_path, monkeypatch):
    rows = [("a", 1, 1, 1.0), ("a", 11, 2, None), ("a", 21, 3, None)]
    series = series_of(spark, tmp_path)
    overwrite_table(with_period(spark.createDataFrame(rows, SCHEMA)), series.raw, ["period"])
    series.refresh()
    kept = spark.table(series.raw).filter("period = '01'").collect()
    overwrite_partitions(with_period(spark.createDataFrame([("a", 11, 2, 9.0)], SCHEMA)), series.raw, ["period"])
    real = overwrite_partitions

    def broken(df, name, by):
        if name == series.closings:
            raise RuntimeError("lost")
        real(df, name, by)

    monkeypatch.setattr(filled_module, "overwrite_partitions", broken)
    with pytest.raises(RuntimeError):
        series.refresh()
    monkeypatch.undo()
    real(spark.createDataFrame(kept, spark.table(series.raw).schema), series.raw, ["period"])  # back to what it was
    series.refresh()
    assert values(spark.table(series.filled), "k", "d", "id", "v") == expected_of(series)
