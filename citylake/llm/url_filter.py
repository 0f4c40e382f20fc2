"""URL verdicts: rules on host and path, and gradient-boosted trees on lexical features where no rule applies.

Labelled urls are given as a table, or are those that rules decide. Counts of allowed and blocked urls per host suffix
are taken over all of them, and so are trees and threshold fitted on all of them; the trees read nothing but the url's own
letters and those counts. (Where MLlib looks for places to split a feature, it takes quantiles of some 10,000 rows.) Labelled urls fall into folds by host. The counts that a labelled url meets leave its own fold out, and one
fold is kept from the trees to set the threshold: a url is blocked from the score at which the two error rates on hosts that
the trees have not seen are least together.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import ascii_lower, staged

# Verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
# Rules are part of the expression, so their number is bounded: more are an error.
MAX_RULES = 1000
TREES, DEPTH, SEED = 10, 4, 7
# Weight, in urls, with which a suffix's share of blocked urls leans on a half.
LEAN_URLS = 20.0
# Folds of labelled urls; the first one sets the threshold.
FOLDS = 5
# Scores are counted in so many steps to set the threshold.
STEPS = 1000

FEATURES = [
    "url_chars", "host_chars", "path_chars", "depth", "labels", "digit_ratio", "other_ratio", "entropy", "parameters",
    "query_chars", "has_fragment", "suffix_urls", "suffix_blocked",
]


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty without ``://``."""
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    text = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(text, pattern, 1)), F.regexp_extract(text, pattern, 2)


def longest_rule(rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits ``host`` and ``path``; null without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    text, verdict = [], []
    for kind, host, path in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        on_host = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        fits = on_host & F.col("path").startswith(path)
        text.append(F.when(fits, F.lit(host + path)))
        verdict.append(F.when(fits, F.lit(kind)))
    return F.coalesce(*text, F.lit(None).cast("string")), F.coalesce(*verdict, F.lit(None).cast("string"))


def entropy(text: Column) -> Column:
    """Bits per character of a text's own character frequencies."""
    size = F.length(text)
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (size - F.length(F.replace(text, c, F.lit("")))) / size)
    bits = F.aggregate(shares, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(size > 0, bits).otherwise(0.0)


def lexical(urls: DataFrame) -> DataFrame:
    """Add the url's own features and ``suffix``, the last label of its host."""
    url, count = F.coalesce("url", F.lit("")), lambda c, kinds: F.length(F.regexp_replace(c, f"[^{kinds}]", ""))
    query = F.regexp_extract(url, "(?s)^[^?#]*\\?([^#]*)", 1)
    ratio = lambda n: F.coalesce(F.try_divide(n, F.length(url)), F.lit(0.0))
    return urls.withColumns({
        "url_chars": F.log1p(F.length(url)),
        "host_chars": F.length("host"),
        "path_chars": F.log1p(F.length("path")),
        "depth": F.size(F.array_remove(F.split("path", "/"), "")),
        "labels": F.size(F.split("host", "\\.")),
        "digit_ratio": ratio(count(url, "0-9")),
        "other_ratio": ratio(F.length(F.regexp_replace(url, "[A-Za-z0-9]", ""))),
        "entropy": entropy(F.concat("host", "path")),
        "parameters": F.size(F.array_remove(F.split(query, "&"), "")),
        "query_chars": F.length(query),
        "has_fragment": F.instr(url, "#") > 0,
        "suffix": F.substring_index("host", ".", -1),
    })


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """Per host suffix and fold: urls ``n`` and their weight by verdict, ``a`` allowed and ``b`` blocked."""
    blocked = F.col("verdict") == "block"
    return labelled.groupBy(F.col("suffix").alias("of"), F.col("fold").alias("of_fold")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.when(~blocked, F.col("weight"))), F.lit(0.0)).alias("a"),
        F.coalesce(F.sum(F.when(blocked, F.col("weight"))), F.lit(0.0)).alias("b"),
    )


def with_suffix(urls: DataFrame, counts: DataFrame) -> DataFrame:
    """Add what is known of a url's suffix: from all folds, or where the url has a ``fold``, from the others.

    Count and share are given in coarse steps, the count as if no fold were left out: finer ones would tell the folds of a
    suffix apart. A suffix without any labelled url has a count of zero, which is a mark of its own, and a share of a half.
    """
    folds = counts.groupBy("of").agg(
        *[F.sum(c).alias(f"all_{c}") for c in "nab"],
        F.map_from_entries(F.collect_list(F.struct("of_fold", F.struct("n", "a", "b")))).alias("by_fold"),  # FOLDS at most
    )
    own = F.col("by_fold")[F.col("fold")]
    left = {c: F.coalesce(F.col(f"all_{c}"), F.lit(0)) - F.coalesce(own[c], F.lit(0)) for c in "nab"}
    share = (left["b"] + LEAN_URLS / 2) / (left["a"] + left["b"] + LEAN_URLS)
    # A suffix that a third of all urls share meets one row of counts: broadcast by size, or split by AQE.
    joined = urls.join(folds, F.col("suffix") == F.col("of"), "left")
    urls_of = left["n"] * F.when(F.col("fold").isNull(), 1.0).otherwise(FOLDS / (FOLDS - 1))
    coarse = {"suffix_urls": F.round(F.log2(1 + urls_of)), "suffix_blocked": F.round(share, 1)}
    return joined.withColumns(coarse).withColumns(
        {c: F.col(c).cast("double") for c in FEATURES}
    )


class Filter(NamedTuple):
    """Fitted trees, the score from which they block, suffix counts, and how they do on hosts they were not fitted on."""

    trees: GBTClassificationModel
    threshold: float
    counts: DataFrame
    auc: float
    false_blocks: float
    missed: float


def score_of(model: GBTClassificationModel, urls: DataFrame) -> DataFrame:
    """Add ``score``, the trees' probability that a url is to be blocked."""
    seen = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(urls))
    score = F.element_at(vector_to_array("probability"), 2)
    return seen.withColumn("score", score).drop("features", "rawPrediction", "probability", "prediction")


def fit(labelled: DataFrame) -> Filter | str:
    """Trees and threshold from lexical features with a ``verdict``; where all verdicts are one, or none is, that one.

    Every labelled url is learnt from, or held out for the threshold. Verdicts weigh the same, however many urls have them. Folds are made by host; only where the fold kept back or the
    others would lack a verdict, they are made by url.
    """
    fold_of = lambda c: F.pmod(F.xxhash64(c), F.lit(FOLDS))
    both = labelled.groupBy("verdict", fold_of("host").alias("fold")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = {v: sum(r["n"] for r in both if r["verdict"] == v) for v in sorted({r["verdict"] for r in both})}
    if len(n) < 2:
        return next(iter(n), "allow")
    split = {(r["verdict"], r["fold"] == 0) for r in both}
    total, fold = sum(n.values()), fold_of("host" if len(split) == 4 else "url")
    weight = F.when(F.col("verdict") == "block", total / 2 / n["block"]).otherwise(total / 2 / n["allow"])
    folded = labelled.withColumns({"fold": fold, "weight": weight})
    counts = staged(suffix_counts(folded), "suffixes")
    label = (F.col("verdict") == "block").cast("double").alias("label")
    rows = staged(with_suffix(folded, counts).select(*FEATURES, "fold", "weight", label), "labelled-urls")
    kept = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows.filter("fold <> 0"))
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, seed=SEED, labelCol="label", weightCol="weight").fit(kept)
    step = F.floor(F.col("score") * STEPS).cast("int")
    tried = score_of(trees, rows.filter("fold = 0")).groupBy(step.alias("step"), "label").agg(F.count(F.lit(1)).alias("n"))
    return Filter(trees, *_threshold({(r["step"], r["label"]): r["n"] for r in tried.collect()}, counts))


def _threshold(found: dict[tuple[int, float], int], counts: DataFrame) -> tuple:
    """Middle of the scores at which the held-out error rates are least together, and the figures on the held-out urls."""
    allowed = [found.get((s, 0.0), 0) for s in range(STEPS + 1)]
    blocked = [found.get((s, 1.0), 0) for s in range(STEPS + 1)]
    n, m = max(1, sum(allowed)), max(1, sum(blocked))
    wrong = [sum(allowed[s:]) / n for s in range(STEPS + 2)]
    missed = [sum(blocked[:s]) / m for s in range(STEPS + 2)]
    least = min(w + x for w, x in zip(wrong, missed))
    best = [s for s in range(STEPS + 2) if wrong[s] + missed[s] == least]
    run = [s for i, s in enumerate(best) if s == best[0] + i]
    at = run[len(run) // 2]
    over = sum(b * (sum(allowed[:s]) + allowed[s] / 2) for s, b in enumerate(blocked))
    return at / STEPS, counts, over / (n * m), wrong[at], missed[at]


def prepared(urls: DataFrame, rules=RULES) -> DataFrame:
    """Urls with host, path, rule, the rule's verdict and their lexical features."""
    host, path = parts(F.col("url"))
    text, verdict = longest_rule(rules)
    split = urls.select("page_id", "url", host.alias("host"), path.alias("path"))
    return lexical(split.withColumn("rule", text).withColumn("verdict", verdict))


def labelled_urls(urls: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """What the trees learn from: ``labels`` (``url, verdict``) if given, else the prepared urls that a rule decides."""
    if labels is None:
        return urls.filter("verdict is not null")
    given = labels.filter("verdict in ('allow', 'block')")
    read = prepared(given.select(F.struct("url", "verdict").alias("page_id"), "url"))
    return read.withColumns({"verdict": F.col("page_id.verdict"), "page_id": F.lit(None).cast("bigint")})


def judge(pages: DataFrame, rules=RULES, labels: DataFrame | None = None) -> DataFrame:
    """One row per page: ``page_id``, ``host``, ``path``, ``rule``, ``verdict`` and ``score`` (of being blocked).

    A null url, or one without ``://``, has an empty host and path and is left to the trees. Where labels are of one
    kind only, that is the verdict of the rest; where there are none, the rest is allowed. Labels with another verdict than
    allow or block are not read. Rows that repeat a ``page_id``, or have none, are judged each. Columns other than
    ``page_id`` and ``url`` are not read. No pages give no rows.
    """
    urls = prepared(pages, rules)
    found = fit(labelled_urls(urls, labels))
    if isinstance(found, str):
        urls = urls.withColumn("score", F.lit(float(found == "block")))
        rest = F.lit(found)
    else:
        urls = score_of(found.trees, with_suffix(urls.withColumn("fold", F.lit(None).cast("bigint")), found.counts))
        rest = F.when(F.col("score") >= found.threshold, F.lit("block")).otherwise(F.lit("allow"))
    return urls.select("page_id", "host", "path", "rule", F.coalesce("verdict", rest).alias("verdict"), "score")
