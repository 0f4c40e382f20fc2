"""A third of all rows under one key: results stay whole, and no task gets the key alone."""

import contextlib

import pytest
from pyspark.sql import functions as F

from citylake import bindings as b
from citylake.operators.conform import dedup
from citylake.operators.facts import fact_taxi_daily
from citylake.operators.series import forward_fill_bucketed
from tests.conftest import plan_of, values

ROWS = 30_000


@contextlib.contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}
SPLIT_EARLY = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Order lines of which a third belong to order 1 and zone 1, all on one day."""
    root = str(tmp_path_factory.mktemp("hot"))
    key = F.when(F.col("id") < ROWS // 3, F.lit(1)).otherwise(F.col("id") % 997 + 2)
    day = F.to_timestamp_ntz(F.lit("1998-01-01 00:00:00"))
    spark.range(0, ROWS, 1, 8).select(
        key.cast("bigint").alias("l_orderkey"),
        F.col("id").alias("l_partkey"),
        key.cast("bigint").alias("l_suppkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.lit(2.0).alias("l_quantity"),
        (F.rand(1) * 1000 + 1).alias("l_extendedprice"),
        F.lit(0.0).alias("l_discount"),
        F.lit(0.0).alias("l_tax"),
        F.lit("R").alias("l_returnflag"),
        F.lit("F").alias("l_linestatus"),
        day.alias("l_shipdate"),
    ).write.parquet(f"{root}/lineitem.parquet")
    spark.range(1, 1000).select(
        F.col("id").alias("o_orderkey"),
        F.col("id").alias("o_custkey"),
        F.lit("O").alias("o_orderstatus"),
        F.lit(1.0).alias("o_totalprice"),
        (day - F.expr("interval 1 day")).alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority"),
    ).write.parquet(f"{root}/orders.parquet")
    return root


def test_hot_order_is_split_in_the_trip_join(spark, hot):
    with settings(spark, **NO_BROADCAST, **SPLIT_EARLY):
        fact = fact_taxi_daily(b.trips(spark, hot))
        rows = {r["pickup_location_id"]: r["total_trips"] for r in fact.collect()}
        plan = fact._jdf.queryExecution().executedPlan().toString()
    assert sum(rows.values()) == ROWS and rows[1] == ROWS // 3
    assert "skew=true" in plan.lower()


def test_hot_zone_is_combined_before_the_shuffle(spark, hot):
    plan = plan_of(fact_taxi_daily(b.trips(spark, hot)))
    final, partial = plan.index("HashAggregate"), plan.rindex("HashAggregate")
    assert "partial_count" in plan[partial:] and final < plan.index("Exchange hashpartitioning") < partial


def test_dedup_of_a_hot_key_combines_before_the_shuffle(spark, hot):
    lines = b.table(spark, hot, "lineitem")
    once = dedup(lines, ["l_suppkey"], ["l_partkey"])
    plan = plan_of(once)
    assert "Window" not in plan and "partial_min_by" in plan
    assert once.count() == 998
    assert once.filter("l_suppkey = 1").first()["l_partkey"] == 0


def test_fill_slices_a_hot_series_evenly(spark, hot):
    lines = b.table(spark, hot, "lineitem").select(
        F.col("l_suppkey").alias("k"),
        "l_shipdate",
        F.col("l_partkey").alias("id"),
        F.when(F.col("l_partkey") == 5, 1.0).alias("v"),
    )
    ranged = lines.repartitionByRange(12, "k", "l_shipdate", "id").groupBy(F.spark_partition_id()).count()
    assert max(r["count"] for r in ranged.collect()) < ROWS // 6
    filled = forward_fill_bucketed(lines, ["k"], ["l_shipdate", "id"], "v", 12)
    assert filled.count() == ROWS
    assert values(filled.groupBy("k").agg(F.count("v").alias("n")).filter("n > 0")) == [(1, ROWS // 3 - 5)]
