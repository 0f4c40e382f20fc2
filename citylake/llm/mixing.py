"""Mixing sources to target weights by Poisson replication, with DataFrame operations only.

A source's rate is the share it should have over the share it has. A document is repeated as often as a
Poisson variable of that mean says: a hash of its id and a seed is a uniform number, and the number of steps of
the cumulative distribution below it is the count. So a document's count depends on nothing but the seed,
its id and its source's rate, whatever the partitioning. Copies are put in the order of a second hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import staged, text_of, whole_rows

SEED = "mix-1"
# Hexadecimal digits of a hash that make a uniform number: 52 bits, all that a double holds exactly.
UNIFORM_DIGITS = 13
# Means above this are drawn as a sum of parts below it, or the first step of the distribution would vanish.
PART_MEAN = 16.0
# Steps of a part's distribution; beyond 80 nothing is left at a mean of 16.
MAX_STEPS = 80


def sizes(docs: DataFrame, measure: str = "characters") -> DataFrame:
    """``source`` and ``size``: its characters (null text: none) or documents. Null is a source of its own."""
    each = {"characters": F.length(text_of()), "documents": F.lit(1)}[measure]
    return docs.groupBy("source").agg(F.sum(each.cast("long")).alias("size"))


def root_weights(sized: DataFrame) -> DataFrame:
    """Target weights that grow with the square root of a source's size: large sources are damped."""
    return sized.select("source", F.sqrt(F.col("size").cast("double")).alias("weight"))


def rates(sized: DataFrame, weights: DataFrame, total_factor: float = 1.0) -> DataFrame:
    """``source`` and ``rate``, the mean number of copies of its documents.

    The mix has ``total_factor`` times the size of all sources. A source without a weight gets rate 0; one of size
    0 (only empty texts) has no share to change and gets rate 1.
    """
    w = weights.select(F.col("source").alias("of"), F.col("weight").cast("double").alias("weight"))
    joined = sized.join(w, sized["source"].eqNullSafe(w["of"]), "left").withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    total = lambda c: joined.agg(F.sum(c)).scalar()  # noqa: E731  a subquery of one row
    share = F.try_divide(F.col("weight"), total("weight")) * total("size") * total_factor
    rate = F.when(F.col("size") > 0, F.coalesce(share / F.col("size"), F.lit(0.0))).otherwise(F.lit(1.0))
    return joined.select("source", rate.alias("rate"))


def uniform(*parts: Column) -> Column:
    """Number in [0, 1) from the MD5 of the parts."""
    digits = F.substring(F.md5(F.concat_ws(":", *parts)), 1, UNIFORM_DIGITS)
    return F.conv(digits, 16, 10).cast("long").cast("double") / float(16**UNIFORM_DIGITS)


def steps(mean: Column) -> Column:
    """Cumulative Poisson probabilities of 0, 1, 2, ... for a mean of at most ``PART_MEAN``."""
    first = F.exp(-mean)
    start = F.struct(first.alias("p"), first.alias("sum"), F.array(first).alias("cdf"))

    def more(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        total = acc["sum"] + p
        return F.struct(p.alias("p"), total.alias("sum"), F.concat(acc["cdf"], F.array(total)).alias("cdf"))

    numbers = F.sequence(F.lit(1), F.lit(MAX_STEPS))
    return F.aggregate(numbers, start, more, lambda acc: acc["cdf"])


def replicate(docs: DataFrame, rated: DataFrame, seed: str = SEED) -> DataFrame:
    """Every copy of every document: ``doc`` (its columns), ``copy``, ``n_copies`` and ``shuffle_key``."""
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1))
    # The distribution is worked out once for each source, not for each document.
    tables = rated.withColumn("parts", parts).withColumn("cdf", steps(F.col("rate") / F.col("parts")))
    # Written, so that its size is known: small, it is broadcast and the documents stay where they are; else a
    # source with a third of all rows is split by AQE.
    tables = staged(tables.select(F.col("source").alias("of"), "parts", "cdf"), "rates")
    rows = whole_rows(docs, "doc_id", "source")
    joined = rows.join(tables, rows["source"].eqNullSafe(tables["of"]))
    drawn = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("parts")),
        F.lit(0),
        lambda total, part: total + F.size(
            F.filter("cdf", lambda c: c <= uniform(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), part))
        ),
    )
    copies = joined.withColumn("n_copies", drawn).filter("n_copies > 0")
    each = copies.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = F.md5(F.concat_ws(":", F.lit(seed), F.lit("order"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "copy"))
    return each.select("doc", "copy", "n_copies", key.alias("shuffle_key"))


def mix(docs: DataFrame, weights: DataFrame | None = None, measure: str = "characters", total_factor: float = 1.0, seed: str = SEED) -> DataFrame:
    """``doc``, ``copy``, ``n_copies`` and ``shuffle_key`` of every copy, in global order of the key.

    ``weights`` (``source``, ``weight``) are shares of the measure; without them they grow with the root of a
    source's size. A document of a rate below one may have no copy: that is what brings a source down. Null source is
    a source; a null ``doc_id`` draws as an empty one; rows that repeat a ``doc_id`` draw the same count; empty texts
    draw like any other. No documents give no rows.
    """
    sized = sizes(docs, measure)
    rated = rates(sized, root_weights(sized) if weights is None else weights, total_factor)
    return replicate(docs, rated, seed).orderBy("shuffle_key")
