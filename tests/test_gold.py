"""Incremental facts, partition pruning, and totals at every level."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.sql import functions as F

from citylake import bindings, edges
from citylake.operators.facts import fact_taxi_daily, taxi_daily_by_zone
from citylake.plans import gold as gold_module
from citylake.plans.dimensions import dim_date
from citylake.plans.gold import MONTH, TaxiGold
from citylake.plans.measures import CityModel, measure
from citylake.sources.calendar import calendar
from citylake.sources.manifest import SLOT
from citylake.sources.sinks import overwrite_partitions, overwrite_table
from tests.conftest import plan_of, values

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "pickup_datetime timestamp, pickup_location_id int, taxi_type string, trip_distance double, total_amount double, "
    "tip_amount double, year string, month string"
)


def trips(spark, rows):
    """Rows ``(slot month, pickup date, zone, amount)`` of yellow trips of 2024."""
    full = [
        (dt.datetime.fromisoformat(day), zone, "yellow", amount / 3, amount, None if zone == 9 else amount / 7, "2024", f"{month:02d}")
        for month, day, zone, amount in rows
    ]
    return spark.createDataFrame(full, SCHEMA)


# The slot of February holds one trip that began in January.
ROWS = [
    (1, "2024-01-03", 1, 10.1), (1, "2024-01-03", 1, 0.3), (1, "2024-01-31", 2, 7.7), (2, "2024-01-31", 2, 1.1), (2, "2024-02-10", 1, 5.0),
    (3, "2024-03-01", 9, 2.5), (3, "2024-03-01", 9, 2.7),
]


@pytest.fixture
def gold(spark, tmp_path):
    names = [f"{kind}_{uuid.uuid4().hex}" for kind in ("silver", "states", "fact", "by_zone")]
    return TaxiGold(spark, f"{tmp_path}/note.json", *names)


def full_build(spark, gold):
    fact = fact_taxi_daily(spark.table(gold.silver))
    return values(fact), values(taxi_daily_by_zone(fact))


def built(spark, gold):
    return tuple(values(spark.table(t).drop(MONTH)) for t in (gold.fact, gold.by_zone))


def files_of(spark, table):
    """File names by month."""
    out = {}
    for r in spark.table(table).select(MONTH, F.col("_metadata.file_name").alias("f")).distinct().collect():
        out.setdefault(r[0], set()).add(r["f"])
    return out


def test_a_changed_slot_rewrites_the_months_it_has_trips_in(spark, gold):
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    assert gold.refresh() is None and built(spark, gold) == full_build(spark, gold)
    assert gold.refresh() == []  # nothing has changed
    before = {t: files_of(spark, t) for t in (gold.fact, gold.by_zone)}
    # February comes again, without its January trip.
    overwrite_partitions(trips(spark, [(2, "2024-02-10", 1, 6.0), (2, "2024-02-11", 3, 1.0)]), gold.silver, SLOT)
    assert gold.refresh() == ["2024-01", "2024-02"]
    assert built(spark, gold) == full_build(spark, gold)
    for table, old in before.items():
        new = files_of(spark, table)
        assert new["2024-03"] == old["2024-03"] and new["2024-01"] != old["2024-01"] and new["2024-02"] != old["2024-02"]


def test_a_new_month_reads_its_own_trips_and_states_only(spark, gold, monkeypatch):
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    gold.refresh()
    overwrite_partitions(trips(spark, [(4, "2024-04-02", 1, 3.0)]), gold.silver, SLOT)
    read, inner = [], gold_module.taxi_states
    monkeypatch.setattr(gold_module, "taxi_states", lambda df, slot: (read.append(df), inner(df, slot))[1])
    merged, facts = [], gold._facts_of
    monkeypatch.setattr(gold, "_facts_of", lambda states: (merged.append(states), facts(states))[1])
    assert gold.refresh() == ["2024-04"]
    assert built(spark, gold) == full_build(spark, gold)
    path = F.col("_metadata.file_path")
    assert all("/month=04/" in r[0] for r in read[-1].select(path).distinct().collect()) and read[-1].count() == 1
    assert all("pickup_month=2024-04" in r[0] for r in merged[-1].select(path).distinct().collect())
    plan = merged[-1]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_month" in plan or "pickup_month#" in plan.split("PartitionFilters")[1][:120]


def test_a_slot_that_goes_takes_its_rows_along(spark, gold):
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    gold.refresh()
    overwrite_table(trips(spark, [r for r in ROWS if r[0] != 3]), gold.silver, SLOT)
    assert "2024-03" in gold.refresh()
    assert built(spark, gold) == full_build(spark, gold) and "2024-03" not in files_of(spark, gold.fact)


def test_a_run_that_breaks_off_is_made_up_for(spark, gold, monkeypatch):
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    gold.refresh()
    overwrite_partitions(trips(spark, [(2, "2024-02-10", 1, 6.0)]), gold.silver, SLOT)
    with monkeypatch.context() as broken:
        broken.setattr(gold, "_merge", lambda months: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            gold.refresh()
    assert json.loads(open(gold.note).read())["months"] == ["2024-01", "2024-02"]
    assert gold.refresh() == ["2024-01", "2024-02"] and built(spark, gold) == full_build(spark, gold)


def test_other_columns_build_anew(spark, gold):
    overwrite_table(trips(spark, ROWS).drop("tip_amount"), gold.silver, SLOT)
    gold.refresh()
    assert built(spark, gold) == full_build(spark, gold)
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    assert gold.refresh() is None and built(spark, gold) == full_build(spark, gold)


def test_a_filter_on_days_prunes_the_facts_files(spark, gold):
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    gold.refresh()
    dates = f"dates_{uuid.uuid4().hex}"
    overwrite_table(dim_date(calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 12, 31))), dates)
    zones = spark.createDataFrame([(1, "Queens", "a", "x"), (2, "Bronx", "b", "x")], "location_id int, borough string, zone_name string, service_zone string")
    model = CityModel(taxi=spark.table(gold.by_zone), dates=spark.table(dates), zones=zones)
    plain = CityModel(taxi=spark.table(gold.by_zone).drop(MONTH), dates=spark.table(dates), zones=zones)
    for by in (["year", "month"], ["month", "borough"]):
        found = measure(model, "avg_fare", by, where={"month": 3})
        assert "dynamicpruning" in plan_of(found).lower()
        assert values(found) == values(measure(plain, "avg_fare", by, where={"month": 3}))
    found = measure(model, "avg_fare", ["year", "month"], where={"month": 3})
    found.collect()
    scans = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in scans.lower()


def test_states_and_facts_are_dealt_once(spark, gold):
    """One exchange each, from the stored rows to the written ones; the second fact is made from the first."""
    overwrite_table(trips(spark, ROWS), gold.silver, SLOT)
    gold.refresh()
    facts = gold._facts_of(spark.table(gold.states))
    for df in (gold._states_of(spark.table(gold.silver)), next(facts)[1], next(facts)[1]):
        assert plan_of(df).count("Exchange ") == 1
    assert built(spark, gold) == full_build(spark, gold)


def test_a_slot_in_several_files_adds_up(spark, gold, monkeypatch):
    """Its states are those of each file; facts in several parts of a month's zones are the same."""
    monkeypatch.setattr(gold_module, "PART_BYTES", 1)
    rows = [(1, "2024-01-03", zone, amount) for zone in range(1, 9) for amount in (10.1, 0.3, 7.7)]
    overwrite_table(trips(spark, rows).repartition(3), gold.silver, SLOT, together=True)
    assert len(spark.table(gold.silver).inputFiles()) == 3
    gold.refresh()
    assert spark.table(gold.states).count() > 8 and gold._parts() > 8
    assert built(spark, gold) == full_build(spark, gold)


def test_each_part_is_grouped_in_a_task_of_its_own(spark, gold, monkeypatch):
    """Adaptive execution does not merge the tasks: what they group in memory is many times what they are dealt."""
    rows = [(m, f"2024-{m:02d}-{d:02d}", zone, 1.5) for m in range(1, 7) for d in range(1, 5) for zone in range(1, 41)]
    overwrite_table(trips(spark, rows), gold.silver, SLOT)
    gold.refresh()
    plain = built(spark, gold)
    monkeypatch.setattr(gold_module, "TASK_BYTES", 1)
    monkeypatch.setattr(gold_module, "PIECE_BYTES", 1024)
    monkeypatch.setattr(gold, "_parts", lambda: 2)
    tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
    facts = gold._facts_of(spark.table(gold.states))
    assert [tasks(next(facts)[1]) for _ in range(2)] == [12, 12]
    assert tasks(gold._states_of(spark.table(gold.silver))) > 6
    gold._build()
    assert built(spark, gold) == plain == full_build(spark, gold)
    # A month that is merged alone has the tasks of its own parts only.
    facts = gold._facts_of(spark.table(gold.states).filter(F.col(MONTH) == "2024-02"))
    assert tasks(next(facts)[1]) == 2


def test_states_and_facts_are_written_in_order_of_their_key(spark, gold):
    """Rows dealt from files that lie in order are smaller."""
    rows = [(1, f"2024-01-{d:02d}", zone, 1.5) for d in (9, 3, 7) for zone in (5, 1, 30, 12)]
    overwrite_table(trips(spark, rows), gold.silver, SLOT)
    gold.refresh()
    for table in (gold.states, gold.fact):
        df = spark.table(table).select("_metadata.file_path", "_metadata.row_index", "pickup_date", "pickup_location_id")
        found = [(r[0], r[2], r[3]) for r in df.orderBy("file_path", "row_index").collect()]
        assert len(found) == 12 and found == sorted(found)


def test_trips_are_dealt_before_columns_are_computed(spark):
    """Only valid ones are, by one exchange after the join's; the rows are those of the conformed trips."""
    dealt = edges._dealt_trips(spark, SF_DIR)
    assert values(dealt) == values(edges._with_slot(bindings.trips(spark, SF_DIR)))
    plan = plan_of(dealt)
    above, below = plan.split("REBALANCE_PARTITIONS_BY_COL")
    assert "trip_duration_minutes" in above and "trip_duration_minutes" not in below and "total_amount" not in below
    assert "< coalesce(" in below and "> 0.0)" in below


def test_a_join_of_order_lines_has_partitions_for_its_size(spark, monkeypatch):
    monkeypatch.setattr(edges, "path_bytes", lambda *paths: 3 << 30)
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    with edges._joining(spark, SF_DIR):
        assert int(spark.conf.get(key)) == 144
    assert spark.conf.get(key) == before


def star(spark):
    taxi = trips(spark, ROWS)
    fact = taxi_daily_by_zone(fact_taxi_daily(taxi))
    fx = spark.createDataFrame([(dt.date(2024, 1, 3), "USD", 1.1), (dt.date(2024, 2, 10), "USD", 1.3), (dt.date(2023, 1, 1), "USD", 2.0)],
                               "fx_date date, CURRENCY string, exchange_rate_to_eur double")
    zones = spark.createDataFrame([(1, "Queens", "a", "x"), (2, "Bronx", "b", "x")], "location_id int, borough string, zone_name string, service_zone string")
    dates = dim_date(calendar(spark, dt.date(2024, 1, 1), dt.date(2024, 2, 20)))  # March is the blank member
    return CityModel(taxi=fact, dates=dates, zones=zones, fx=fx)


@pytest.mark.parametrize("name", ["avg_fare", "revenue_eur"])
@pytest.mark.parametrize("by", [["year", "month"], ["borough", "year"], ["month", "borough", "day_name"], ["borough"], []])
def test_each_level_is_the_measure_evaluated_there(spark, name, by):
    model, where = star(spark), {"is_weekend": 0} if name == "avg_fare" else None
    levels = measure(model, name, by, where=where, totals=True)
    assert plan_of(levels).count("Scan ExistingRDD") <= plan_of(measure(model, name, by, where=where)).count("Scan ExistingRDD")
    rows = levels.collect()
    for level in range(len(by) + 1):
        own = sorted((tuple(r[c] for c in by[:level]) + (r[name],) for r in rows if r["level"] == level), key=str)
        want = sorted((tuple(r) for r in measure(model, name, by[:level], where=where).select(*by[:level], name).collect()), key=str)
        assert own == want
    assert len(rows) == sum(measure(model, name, by[:level], where=where).count() for level in range(len(by) + 1))
