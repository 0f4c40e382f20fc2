"""Laws that hold for any input."""

import math
from fractions import Fraction

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citylake.functions import exact_sum
from citylake.operators.conform import dedup, union_conformed
from citylake.operators.exact import exact_aggregate, merged, partial_states, rolled_up
from citylake.operators.facts import fact_aq_daily, pivot_parameters
from citylake.operators.series import forward_fill, forward_fill_bucketed
from citylake.plans.measures import latest_value
from citylake.schemas import PARAMETERS
from tests.conftest import values

few = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow]
)
amount = st.one_of(st.none(), st.integers(-(10**12), 10**12).map(lambda n: n / 1e6))
small = st.integers(0, 3)


@few
@given(st.lists(amount, max_size=30))
@example([1e-06, -3e-06])
@example([0.1, 0.2, -0.3, 1e11])
def test_exact_sum_is_the_true_sum(spark, amounts):
    """The sum of the doubles as they are, rounded once, but for the rests below 2^-20, which are added as doubles."""
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    known = [Fraction(a) for a in amounts if a is not None]
    for got in (df.agg(exact_sum("a")).first()[0], exact_aggregate(df, [], {"s": "a"}).first()[0]):
        if not known:
            assert got is None
        else:
            true = sum(known)
            rests = Fraction(len(known) ** 2, 2**73)
            assert abs(Fraction(got) - true) <= rests + abs(Fraction(math.ulp(float(true))))


@few
@given(st.lists(st.integers(-(2**59), 2**59).map(lambda n: n / 2**20), max_size=30))
def test_sums_of_fine_multiples_are_rounded_once(spark, amounts):
    df = spark.createDataFrame([(a,) for a in amounts], "a double")
    want = float(sum(map(Fraction, amounts))) if amounts else None
    assert exact_aggregate(df, [], {"s": "a"}).first()["s"] == want == df.agg(exact_sum("a")).first()[0]


@few
@given(st.lists(st.tuples(small, small, amount), max_size=30))
def test_merged_states_are_the_states_of_all_rows(spark, rows):
    df = spark.createDataFrame(rows, "k int, slot int, a double")
    fine = partial_states(df, ["k", "slot"], {"a": "a"}, {"n": "count(1)"})
    both = [merged(fine, ["k"], ["a"], ["n"]), partial_states(df, ["k"], {"a": "a"}, {"n": "count(1)"})]
    whole = [values(s.select("k", "n", "a__high", "a__unit", "a__low", "a__n")) for s in both]
    assert whole[0] == whole[1]
    levels = rolled_up(fine, ["k", "slot"], ["a"], ["n"])
    assert levels.filter("level = 0").agg(F.sum("n")).first()[0] == (len(rows) or None)
    assert values(levels.filter("level = 1").select("k", "n")) == values(both[0].select("k", "n"))


@few
@given(st.lists(st.tuples(small, small, st.one_of(st.none(), st.floats(0, 9))), max_size=40), st.integers(1, 7))
def test_bucketed_fill_is_plain_fill(spark, rows, buckets):
    df = spark.createDataFrame([(k, d, i, v) for i, (k, d, v) in enumerate(rows)], "k int, d int, id int, v double")
    args = (["k"], ["d", "id"], "v")
    assert values(forward_fill_bucketed(df, *args, buckets)) == values(forward_fill(df, *args))


@few
@given(st.lists(st.tuples(st.one_of(st.none(), small), small, st.sampled_from("abc")), max_size=30))
def test_dedup_gives_unique_keys_and_the_least_row(spark, rows):
    kept = values(dedup(spark.createDataFrame(rows, "k int, n int, s string"), ["k"]))
    expected = {k: min(r[1:] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    assert {r[0]: r[1:] for r in kept} == expected and len(kept) == len(expected)


@few
@given(st.lists(small, max_size=10), st.lists(small, max_size=10))
def test_union_counts_add_up(spark, left, right):
    a = spark.createDataFrame([(n,) for n in left], "a int")
    b = spark.createDataFrame([(n, n) for n in right], "a int, b int")
    assert union_conformed(a, b).count() == len(left) + len(right)


@few
@given(st.lists(st.tuples(small, st.one_of(st.none(), st.integers(0, 2))), min_size=1, max_size=12))
def test_latest_value_is_the_only_one_there(spark, rows):
    df = spark.createDataFrame(rows, "t int, v int").withColumn("t", F.timestamp_seconds("t"))
    newest = max(t for t, _ in rows)
    there = {v for t, v in rows if t == newest}
    assert latest_value(df, "t", "v").first()["latest_v"] == (there.pop() if len(there) == 1 else None)


@few
@given(st.lists(st.tuples(st.sampled_from("xy"), st.sampled_from([*PARAMETERS, "noise"]), st.integers(0, 9)), max_size=30))
def test_daily_averages_of_a_wide_table_are_its_values(spark, rows):
    df = spark.createDataFrame([(p, n, float(v)) for p, n, v in rows], "location_name string, parameter string, value double")
    day = df.withColumns({"reading_date": F.lit("2024-01-01").cast("date"), "lat": F.lit(1.0), "lon": F.lit(2.0)})
    wide = pivot_parameters(day)
    kept = wide.filter("pm25 IS NOT NULL OR no2 IS NOT NULL OR o3 IS NOT NULL")
    assert values(fact_aq_daily(wide), "location_name", "avg_pm25", "avg_temp") == values(
        kept, "location_name", "pm25", "temperature"
    )
