"""Quality rules with robust multivariate outliers.

Statistics of every whole text are turned into a vector of five numbers. For each language and source, a minimum
covariance determinant fit finds the three quarters of the documents that lie closest together; a document whose
Mahalanobis distance from their centre is beyond a high quantile is rejected. Groups too small to fit
are pooled by language, and what is left of those, all together.

The fit runs as concentration steps over all rows: a histogram of distances gives the closest three quarters, sums
of products give their mean and covariance. Both combine before they shuffle, so a source with a third
of all rows costs no more per task than any other, and no group is gathered anywhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged, text_of

ship(__name__)

WHITE = b" \t\n\r\x0b\x0c"
SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = b"0123456789"
WINDOW_WORDS = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

# The vector, and the spread below which a component's differences do not count as unusual.
FEATURES = {"x_word": 0.1, "x_upper": 0.5, "x_symbol": 0.5, "x_repeat": 0.5, "x_digit": 0.5}
# Share of a group that the fit rests on, concentration steps, and the smallest group that is fitted.
CORE_SHARE = 0.75
STEPS = 4
MIN_GROUP = 200
# Chance of a larger distance, were the vectors normal.
TAIL = 1e-5
# Groups whose models are broadcast (about 300 bytes each); with more, rows and models are joined by group and salt.
BROADCAST_GROUPS, SALTS = 20_000, 64
# Steps of a histogram per unit of a component and per e-fold of a squared distance.
VALUE_BINS, DISTANCE_BINS = 64, 16

STATS = "doc_id bigint, lang string, source string, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint"
VECTOR = ", ".join(f"{x} double" for x in FEATURES)


def repeated_words(words: list[bytes], each: int = WINDOW_WORDS) -> int:
    """Words in windows of ``each`` words that occur twice or more."""
    from collections import Counter

    windows = list(zip(*[words[i:] for i in range(each)]))
    if len(set(windows)) == len(windows):
        return 0
    counts, inside = Counter(windows), bytearray(len(words))
    for i, window in enumerate(windows):
        if counts[window] > 1:
            inside[i : i + each] = b"\1" * each
    return sum(inside)


def measure(text: str) -> tuple:
    """Base statistics of a text, then its vector."""
    raw = text.encode()
    size = lambda kinds: len(raw) - len(raw.translate(None, kinds))
    words = raw.split()  # on bytes: ASCII white space only
    n, chars = len(words), len(text) - size(WHITE)
    lines = [x for x in raw.split(b"\n") if x.strip(WHITE)]
    symbols, repeat = size(SYMBOLS), repeated_words(words)
    # Small additions keep short texts near what is usual.
    vector = (
        math.log((chars + 100) / (n + 20)),
        math.log((size(UPPER) + 3) / (chars + 200)),
        math.log(symbols / (chars + 200) + 0.005),
        math.log(repeat / (n + 40) + 0.05),
        math.log(size(DIGITS) / (chars + 200) + 0.01),
    )
    return (n, chars, symbols, len(lines) - len(set(lines)), repeat, *vector)


def _measured(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        rows = [measure(text.as_py()) for text in batch.column("text")]
        found = [pa.array(c, pa.int64() if k < 5 else pa.float64()) for k, c in enumerate(zip(*rows))]
        if found:
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", *FEATURES]
            kept = ["doc_id", "lang", "source"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *found], [*kept, *names])


def statistics(docs: DataFrame) -> DataFrame:
    """Base statistics, ``base_failed`` and the vector of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint"), "lang", "source", text_of().alias("text"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return rows.mapInArrow(_measured, f"{STATS}, {VECTOR}").withColumn("base_failed", failed)


def _groups(stats: DataFrame, least: int) -> DataFrame:
    """``of_lang``, ``of_source`` and the group ``g`` their rows are fitted with (null: too few to fit)."""
    sized = stats.groupBy(F.col("lang").alias("of_lang"), F.col("source").alias("of_source")).count()
    small = F.when(F.col("count") < least, F.col("count"))
    by_lang = F.sum(small).over(Window.partitionBy("of_lang"))
    named = sized.withColumn("in_lang", by_lang).withColumn(
        "g",
        F.when(F.col("count") >= least, F.to_json(F.struct("of_lang", "of_source")))
        .when(F.col("in_lang") >= least, F.to_json(F.struct("of_lang")))
        .otherwise(F.lit("rest")),
    )
    rest = named.filter("g = 'rest'").agg(F.sum("count")).scalar()
    return named.select("of_lang", "of_source", F.when((F.col("g") != "rest") | (rest >= least), F.col("g")).alias("g"))


def _quantiles(binned: DataFrame, keys: list[str], shares: dict[str, float]) -> DataFrame:
    """Per key, the lowest ``bin`` that holds each share of its rows, from counts per bin."""
    counts = binned.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    up_to = F.sum("n").over(Window.partitionBy(*keys).orderBy("bin"))
    summed = counts.withColumn("up_to", up_to).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
    return summed.groupBy(*keys).agg(
        *[F.min(F.when(F.col("up_to") >= F.col("all") * s, F.col("bin"))).alias(name) for name, s in shares.items()]
    )


def _first_models(rows: DataFrame) -> DataFrame:
    """Start of the fit: component-wise medians, and spreads from the quartiles."""
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(F.col(x) * VALUE_BINS).alias("bin")) for k, x in enumerate(FEATURES)]))
    binned = rows.select("g", each.alias("e")).select("g", "e.k", "e.bin")
    found = _quantiles(binned, ["g", "k"], {"low": 0.25, "mid": 0.5, "high": 0.75})
    value = lambda c: (F.col(c) + 0.5) / VALUE_BINS
    spread = F.element_at(F.array(*[F.lit(s) for s in FEATURES.values()]), F.col("k") + 1)
    wide = F.greatest((value("high") - value("low")) / 1.349, spread)
    pivoted = found.groupBy("g").agg(*[
        F.max(F.when(F.col("k") == k, c)).alias(f"{name}{k}")
        for k in range(len(FEATURES)) for name, c in (("m", value("mid")), ("v", 1 / (wide * wide)))
    ])
    p = len(FEATURES)
    precision = F.array(*[F.col(f"v{i}") if i == j else F.lit(0.0) for i in range(p) for j in range(p)])
    return pivoted.select("g", F.array(*[F.col(f"m{k}") for k in range(p)]).alias("mean"), precision.alias("precision"))


def _distance(p: int = len(FEATURES)) -> Column:
    """Squared Mahalanobis distance of a row from its model."""
    off = [F.col(x) - F.get("mean", F.lit(k)) for k, x in enumerate(FEATURES)]
    terms = [
        off[i] * off[j] * F.get("precision", F.lit(i * p + j)) * (1 if i == j else 2) for i in range(p) for j in range(i, p)
    ]
    return sum(terms[1:], terms[0])


def _distance_bin() -> Column:
    return F.floor(F.log(F.col("d2") + 0.001) * DISTANCE_BINS)


def _inverted(frames: Iterator) -> Iterator:
    """Mean and inverse covariance of each group from its sums, with the least spreads added."""
    import numpy as np
    import pandas as pd

    p, spreads = len(FEATURES), np.diag(np.square(list(FEATURES.values())))
    for frame in frames:
        rows = []
        for r in frame.itertuples(index=False):
            mean = np.array(r.sums) / r.n
            square = np.zeros((p, p))
            square[np.triu_indices(p)] = np.array(r.products) / r.n
            square = square + square.T - np.diag(np.diag(square))
            cov = square - np.outer(mean, mean) + spreads
            rows.append((r.g, mean.tolist(), np.linalg.inv(cov).ravel().tolist()))
        yield pd.DataFrame(rows, columns=["g", "mean", "precision"])


def _beside(rows: DataFrame, models: DataFrame, how: str = "inner") -> DataFrame:
    """Rows with what a stored table holds for their group; a group with a third of all rows is not one task."""
    if models.count() <= BROADCAST_GROUPS:
        return rows.join(F.broadcast(models), "g", how)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(*FEATURES), F.lit(SALTS)).cast("int"))
    copies = models.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["g", "salt"], how).drop("salt")


def _concentrated(rows: DataFrame, models: DataFrame) -> DataFrame:
    """One concentration step: models of the rows that lie closest to the given ones."""
    placed = _beside(rows, models).withColumn("d2", _distance()).withColumn("bin", _distance_bin())
    bound = staged(_quantiles(placed.select("g", "bin"), ["g"], {"bound": CORE_SHARE}), "mcd-bound")
    x = list(FEATURES)
    products = [F.sum(F.col(x[i]) * F.col(x[j])) for i in range(len(x)) for j in range(i, len(x))]
    core = _beside(placed, bound).filter("bin <= bound").groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(c) for c in x]).alias("sums"), F.array(*products).alias("products")
    )
    return core.mapInPandas(_inverted, "g string, mean array<double>, precision array<double>")


def chi_square(share: float, p: int) -> float:
    """Quantile of the chi-square distribution (Wilson and Hilferty)."""
    spread = 2 / (9 * p)
    return p * (1 - spread + NormalDist().inv_cdf(share) * math.sqrt(spread)) ** 3


def fit(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """``g``, ``mean``, ``precision`` and ``loose``, by which distances are divided where the core is too tight."""
    models = staged(_first_models(rows), "mcd")
    for _ in range(steps):
        models = staged(_concentrated(rows, models), "mcd")
    placed = _beside(rows, models).withColumn("d2", _distance()).select("g", _distance_bin().alias("bin"))
    half = _quantiles(placed, ["g"], {"half": 0.5})
    median = F.exp((F.col("half") + 1) / DISTANCE_BINS)
    loose = half.select("g", F.greatest(median / chi_square(0.5, len(FEATURES)), F.lit(1.0)).alias("loose"))
    return staged(models.join(loose, "g"), "mcd")


def judge(docs: DataFrame, min_group: int = MIN_GROUP, tail: float = TAIL) -> DataFrame:
    """One row per document: base statistics, ``base_failed``, ``distance`` and ``kept``.

    Null and empty texts have no words and fail the base rules. Languages and sources may be null; null is a value.
    Groups of fewer than ``min_group`` documents that pass the base rules are pooled, and where even the pool is
    too small, nothing more is rejected (``distance`` is null). Rows that repeat a ``doc_id``, or have none, are
    judged each. Columns other than ``doc_id``, ``text``, ``lang`` and ``source`` are not read. No documents
    give no rows.
    """
    stats = staged(statistics(docs), "statistics")
    groups = staged(_groups(stats.filter("not base_failed"), min_group), "groups")
    same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("source").eqNullSafe(F.col("of_source"))
    grouped = staged(stats.join(groups, same, "left").drop("of_lang", "of_source"), "grouped")
    models = fit(grouped.filter("not base_failed and g is not null").select("g", *FEATURES))
    judged = _beside(grouped, models, "left").withColumn("distance", F.sqrt(F.abs(_distance() / F.col("loose"))))
    inside = F.coalesce(F.col("distance") <= math.sqrt(chi_square(1 - tail, len(FEATURES))), F.lit(True))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", (~F.col("base_failed") & inside).alias("kept"),
    )
