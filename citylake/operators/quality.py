"""Rules over rows: counts, suites, quarantine and the gate that stops a run."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citylake.functions import percent_text, rate


class QualityGateError(RuntimeError):
    """The data is too bad to go on with."""


@dataclass(frozen=True)
class Rule:
    """A named expectation; ``failed`` is true for rows that break it."""

    name: str
    failed: Column


def between(column: str, low: float, high: float) -> Rule:
    """Values lie in [low, high]; NULLs are not judged."""
    return Rule(f"{column} between {low} and {high}", ~F.col(column).between(low, high))


def not_null(column: str) -> Rule:
    """Every row has a value."""
    return Rule(f"{column} not null", F.col(column).isNull())


def bad_trip() -> Column:
    """Nobody on board or no distance."""
    return (F.col("passenger_count") <= 0) | (F.col("trip_distance") <= 0)


def impossible_pm25() -> Column:
    """Outside the plausible range of a fine-dust reading."""
    return (F.col("pm25") < 0) | (F.col("pm25") > 500)


def missing_rate() -> Column:
    """No exchange rate."""
    return F.col("exchange_rate_to_eur").isNull()


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows and failing rows of each rule, all rules in one pass: ``rule, total, failed``."""
    names = list(rules)
    counted = df.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(rules[n]).alias(f"_f{i}") for i, n in enumerate(names)]
    )
    cells = [
        F.struct(F.lit(n).alias("rule"), F.col("total"), F.col(f"_f{i}").alias("failed"))
        for i, n in enumerate(names)
    ]
    return counted.select(F.inline(F.array(*cells)))


# Counts of a rule: rows looked at and rows that fail.
Counts = dict[str, tuple[int, int]]


class RowCounts:
    """Counts of rules, taken from the rows as they are written, without a scan of their own.

    ``on`` must come last before the write. The rows are then seen by the tasks that write them, of which Spark counts each once,
    however often one is tried; a task before a shuffle is counted again if its output gets lost.
    """

    def __init__(self, rules: Mapping[str, Column]):
        self.rules, self._seen = dict(rules), Observation()

    def on(self, df: DataFrame) -> DataFrame:
        found = [F.count_if(failed).alias(f"_f{i}") for i, failed in enumerate(self.rules.values())]
        return df.observe(self._seen, F.count(F.lit(1)).alias("total"), *found)

    def counts(self) -> Counts:
        """After the write. A write whose rows Spark knows to be none has nothing to count."""
        seen = self._seen.get
        return {name: (seen.get("total", 0), seen.get(f"_f{i}", 0)) for i, name in enumerate(self.rules)}


def report_of(spark: SparkSession, counts: Counts) -> DataFrame:
    """The report of counts that are there already."""
    return failure_rate(spark.createDataFrame([(r, t, f) for r, (t, f) in counts.items()], "rule string, total long, failed long"))


def daily_rules() -> dict[str, dict[str, Column]]:
    """Rules of the trips, the air quality and the rates."""
    return {
        "trips": {"bad_trips": bad_trip()},
        "air": {"impossible_pm25": impossible_pm25()},
        "fx": {"fx_nulls": missing_rate()},
    }


def failure_rate(counts: DataFrame) -> DataFrame:
    """Share of failing rows; NULL for an empty table."""
    return counts.withColumn("failure_rate", rate("failed", "total"))


def quality_report(trips: DataFrame, air: DataFrame, fx: DataFrame) -> DataFrame:
    """The three daily checks, one pass over each table."""
    tables = {"trips": trips, "air": air, "fx": fx}
    parts = [rule_counts(tables[name], rules) for name, rules in daily_rules().items()]
    return failure_rate(reduce(DataFrame.unionByName, parts))


def report_text(report: DataFrame) -> DataFrame:
    """The report with its rate as percent text, for people."""
    return report.select("rule", "total", "failed", percent_text("failure_rate").alias("failure_percent"))


def gate_checks(report: DataFrame, max_rate: float = 0.01) -> DataFrame:
    """What the gate looks at: ``rule, value, bound, halted``.

    A share of exactly ``max_rate`` passes. An empty trip table has no share and halts. Any missing rate halts.
    """
    trips = report.filter("rule = 'bad_trips'").select(
        "rule", F.col("failure_rate").alias("value"), F.lit(float(max_rate)).alias("bound")
    )
    fx = report.filter("rule = 'fx_nulls'").select("rule", F.col("failed").cast("double").alias("value"), F.lit(0.0).alias("bound"))
    return trips.unionByName(fx).withColumn("halted", F.coalesce(F.col("value") > F.col("bound"), F.lit(True)))


def gate(report: DataFrame, max_rate: float = 0.01) -> None:
    """Raise when too many trips are bad or any rate is missing. Acts: reads the two rows of ``gate_checks``."""
    rows = {r["rule"]: r for r in gate_checks(report, max_rate).collect()}
    trips, fx = rows["bad_trips"], rows["fx_nulls"]
    if trips["value"] is None:
        raise QualityGateError("no trips to judge")
    if trips["halted"]:
        raise QualityGateError(f"bad trips: {trips['value']:.2%} is over {max_rate:.2%}")
    if fx["halted"]:
        raise QualityGateError(f"{fx['value']:.0f} exchange rates are missing")


def run_suite(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All expectations in one pass: ``rule, checked, failed, passed``."""
    counts = rule_counts(df, {r.name: r.failed for r in rules})
    return counts.select(
        "rule", F.col("total").alias("checked"), "failed", (F.col("failed") == 0).alias("passed")
    )


def suite_status(result: DataFrame) -> DataFrame:
    """One row: ``status, total_checks, success_percent``."""
    total, passed = F.count(F.lit(1)), F.count_if("passed")
    return result.agg(
        F.when(total == passed, "Success").otherwise("Failure").alias("status"),
        total.alias("total_checks"),
        (F.try_divide(passed, total) * F.lit(100.0)).alias("success_percent"),
    )


def weather_rules() -> list[Rule]:
    """Expectations on the forecast table."""
    return [between("temperature", -50, 60), not_null("humidity"), not_null("forecast_time")]


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Every row with the names of the rules it breaks; an empty array marks a clean row."""
    broken = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    return df.withColumn("reasons", broken)
