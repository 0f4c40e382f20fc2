"""Secrets: three fixed patterns, and Markov models of random strings against ordinary identifiers.

DataFrame operations only. The models count pairs of neighbouring characters in labelled samples: random strings,
made from digests, and identifiers of a bounded sample of documents, with what the fixed patterns find taken out.
A token is a secret when its log-likelihood ratio, summed over its character pairs, passes a threshold. A text is
scanned where it lies; nothing is shuffled but the models' counts.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm.common import text_of

# Patterns of the three kinds; what must be long enough is the value, the whole match, the whole match.
ASSIGN = "(?i:(password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "(?<![0-9a-f])[0-9a-f]{16,}"
ASSIGN_VALUE_CHARS = 12

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}"
# Shortest token the models judge, and shortest identifier they learn from.
TOKEN_CHARS, IDENTIFIER_CHARS = 16, 5
# The models are fitted on at most about so many documents, and on so many random strings of each form.
TRAIN_DOCS, TRAIN_STRINGS = 2000, 2000
# Pairs that a character's own frequency counts for in the probability of a pair.
LEAN_PAIRS = 20
# Nats by which a token must be likelier as a random string.
MIN_LOG_RATIO = 10.0
KINDS = ["assign", "access", "hex", "markov"]
# Elements of an array that are summed one after another.
CHUNK = 256


def _pairs(tokens: DataFrame) -> DataFrame:
    """Counts of neighbouring characters; at most the square of the alphabet."""
    pairs = F.expr("explode(transform(sequence(1, length(token) - 1), i -> substring(token, i, 2)))")
    return tokens.filter("length(token) > 1").select(pairs.alias("pair")).groupBy("pair").count()


def random_strings(spark: SparkSession, n: int = TRAIN_STRINGS) -> DataFrame:
    """Labelled samples of secrets: digests as Base64, as upper-case letters and digits, and in hexadecimal."""
    seeded = spark.range(n).select(F.sha2(F.concat(F.lit("random string "), F.col("id")), 256).alias("h"))
    text = "translate(base64(unhex(h)), '\\n\\r=', '')"
    return seeded.select(F.expr(f"explode(array({text}, upper(translate({text}, '+/', '')), h))").alias("token"))


def identifiers(docs: DataFrame, n: int = TRAIN_DOCS) -> DataFrame:
    """Labelled samples of ordinary identifiers: tokens of about ``n`` documents, drawn by a hash of their text.

    Tokens long enough to be judged are left out, or an unknown secret would teach that it is ordinary.
    """
    total = docs.count()
    share = min(1.0, n / total) if total else 1.0
    drawn = docs.filter(F.expr(f"pmod(xxhash64(text, 'train'), 1000000) < {share * 1000000:.0f}"))
    plain = F.regexp_replace(text_of(), f"{ASSIGN}|{ACCESS}|{HEX}", " ")
    tokens = F.regexp_extract_all(plain, F.lit(TOKEN % IDENTIFIER_CHARS), F.lit(0))
    return drawn.select(F.explode(tokens).alias("token")).filter(F.length("token") < TOKEN_CHARS)


def log_ratios(secret: DataFrame, ordinary: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of characters.

    A pair's probability leans on that of its second character, so that pairs a model has not seen are judged
    by how rare the character is. The size is that of the alphabet squared.
    """
    at = {c: i for i, c in enumerate(ALPHABET)}
    size, tables = len(ALPHABET), []
    for tokens in (secret, ordinary):
        counts = [[0] * size for _ in ALPHABET]
        for pair, n in _pairs(tokens).collect():  # at most size * size rows
            counts[at[pair[0]]][at[pair[1]]] += n
        second = [sum(column) + 1 for column in zip(*counts)]
        lean = [LEAN_PAIRS * n / sum(second) for n in second]
        tables.append([[math.log((n + x) / (sum(row) + LEAN_PAIRS)) for n, x in zip(row, lean)] for row in counts])
    return [s - o for a, b in zip(*tables) for s, o in zip(a, b)]


SPAN = "struct<start:int,rank:int,kind:string,end:int,token:string>"


def _running(values: str, chunk: int = CHUNK) -> Column:
    """Running sums of a column's array of integers, each with its own value.

    Growing one array by appending copies it for every element. Here it is cut into chunks: what lies before a chunk is
    the sum of the chunks' sums, and only a chunk's own array grows.
    """
    zero, add = F.lit(0), lambda total, x: total + x
    chunks = F.transform(F.sequence(zero, F.floor((F.size(values) - 1) / chunk).cast("int")), lambda j: F.slice(values, j * chunk + 1, F.lit(chunk)))
    sums = lambda cs: F.transform(cs, lambda c: F.aggregate(c, zero, add))
    start = lambda before: F.struct(before.alias("sum"), F.array().cast("array<int>").alias("out"))

    def grow(state: Column, x: Column) -> Column:
        return F.struct((state["sum"] + x).alias("sum"), F.concat(state["out"], F.array(state["sum"] + x)).alias("out"))

    def scanned(c: Column, before: Column) -> Column:
        return F.aggregate(c, start(before), grow, lambda state: state["out"])

    # No expression over the whole array stands inside a lambda, where it would be computed for every element.
    before = F.zip_with(scanned(sums(chunks), zero), sums(chunks), lambda total, own: total - own)
    return F.when(F.size(values) > 0, F.flatten(F.zip_with(chunks, before, scanned))).otherwise(F.array().cast("array<int>"))


def _spans(kind: str, value_chars: int = 0) -> Column:
    """Spans of a kind's matches (column ``<kind>``), in code points; with ``value_chars``, those whose assigned value is as long.

    The lengths of the texts between the matches (``<kind>_gaps``) and of the matches, summed up, give the ends (``<kind>_ends``).
    """
    placed = F.zip_with(kind, f"{kind}_ends", lambda m, end: F.struct(
        (end - F.length(m)).alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"), m.alias("token"),
    ))
    if value_chars:
        placed = F.filter(placed, lambda s: F.length(F.regexp_extract(s["token"], ASSIGN, 2)) >= value_chars)
    return placed.cast(f"array<{SPAN}>")


def _found(docs: DataFrame) -> DataFrame:
    """``doc_id`` and for every kind an array of spans. Each pattern runs twice over a text: for matches and for gaps."""
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "markov": TOKEN % TOKEN_CHARS}
    columns = ["doc_id", *patterns]
    matched = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", "text", *[F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(k) for k, p in patterns.items()]
    )
    gaps = {k: F.transform(F.split("text", p, -1), F.length) for k, p in patterns.items()}
    none = F.array().cast("array<int>")
    cut = matched.select(*columns, *[F.when(F.size(k) > 0, g).otherwise(none).alias(f"{k}_gaps") for k, g in gaps.items()])
    # A gap's and a match's length together; the gap after the last match is left out.
    steps = {k: F.zip_with(F.slice(f"{k}_gaps", F.lit(1), F.size(k)), k, lambda g, m: g + F.length(m)) for k in patterns}
    stepped = cut.select(*columns, *[s.alias(f"{k}_steps") for k, s in steps.items()])
    ended = stepped.select(*columns, *[_running(f"{k}_steps").alias(f"{k}_ends") for k in patterns])
    return ended.select("doc_id", _spans("assign", ASSIGN_VALUE_CHARS).alias("assign"), *[_spans(k).alias(k) for k in KINDS[1:]])


def _events(points: Column, queries: Column, points_first: bool) -> Column:
    """Points and queries in one array, in order; at one place the points come first, or last."""
    event = lambda kind: lambda at: F.struct(at.alias("at"), F.lit(kind).alias("kind"))
    return F.sort_array(F.concat(F.transform(points, event(0 if points_first else 2)), F.transform(queries, event(1))))


def _before(events: str) -> Column:
    """For every query of ``<events>``, the number of points before it; ``<events>_sums`` runs over the points."""
    both = F.zip_with(events, f"{events}_sums", lambda e, n: F.struct(e["kind"].alias("kind"), n.alias("n")))
    return F.transform(F.filter(both, lambda e: e["kind"] == 1), lambda e: e["n"])


def free_tokens(found: DataFrame) -> DataFrame:
    """``found`` with the tokens of ``markov`` that no span of ``base`` overlaps.

    Tokens are in order and do not overlap, so a token is free if as many spans start before its end as end by its start.
    Both numbers come from sorting and a running sum: nothing is compared pair by pair.
    """
    kept = ["doc_id", "base", "markov"]
    at = lambda c, end: F.transform(c, lambda s: s[end])
    some = (F.size("base") > 0) & (F.size("markov") > 0)
    none = F.array().cast("array<struct<at:int,kind:int>>")
    events = {
        "starts": _events(at("base", "start"), at("markov", "end"), points_first=False),
        "ends": _events(at("base", "end"), at("markov", "start"), points_first=True),
    }
    merged = found.select(*kept, *[F.when(some, e).otherwise(none).alias(n) for n, e in events.items()])
    point = lambda e: F.when(e["kind"] == 1, 0).otherwise(1)
    pointed = merged.select(*kept, *events, *[F.transform(n, point).alias(f"{n}_points") for n in events])
    summed = pointed.select(*kept, *events, *[_running(f"{n}_points").alias(f"{n}_sums") for n in events])
    counted = summed.select(*kept, F.zip_with(_before("starts"), _before("ends"), lambda s, e: s == e).alias("clear"))
    told = F.zip_with("markov", "clear", lambda t, clear: F.struct(t.alias("token"), F.coalesce(clear, F.lit(True)).alias("clear")))
    clear = F.transform(F.filter(told, lambda t: t["clear"]), lambda t: t["token"])
    return counted.select("doc_id", "base", clear.alias("markov"))


def log_ratio(token: Column, model: Column) -> Column:
    """Log-likelihood ratio of a token under the models; the token is taken apart once."""
    places = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

    def each(state: Column, at: Column) -> Column:
        pair = F.get(model, state["last"] * len(ALPHABET) + at)
        return F.struct(at.alias("last"), (state["sum"] + F.when(state["last"] >= 0, pair).otherwise(0.0)).alias("sum"))

    return F.aggregate(places, start, each, lambda state: state["sum"])


def scan(
    docs: DataFrame,
    train_docs: int = TRAIN_DOCS,
    min_log_ratio: float = MIN_LOG_RATIO,
    secrets: DataFrame | None = None,
    ordinary: DataFrame | None = None,
) -> DataFrame:
    """``doc_id``, ``base`` (spans of the fixed patterns) and ``spans`` (those and the models'), sorted by start.

    A span is ``(start, rank, kind, end, token)`` in code points. Tokens that overlap a fixed pattern's span are
    left to it. The models learn from ``secrets`` and ``ordinary``, labelled samples with a column ``token`` of characters of
    the alphabet, or else from made random strings and the documents' identifiers. Null and empty texts have no spans;
    without documents to learn from, the models know random strings only and judge by those. Rows that repeat a
    ``doc_id``, or have none, are scanned each. Time grows with a text's length and, a little faster, with its matches.
    """
    spark = docs.sparkSession
    positive = secrets if secrets is not None else random_strings(spark)
    ratios = log_ratios(positive, ordinary if ordinary is not None else identifiers(docs, train_docs))
    model = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    found = _found(docs)
    based = found.select("doc_id", "markov", F.sort_array(F.concat("assign", "access", "hex")).alias("base"))
    likely = F.filter("markov", lambda t: log_ratio(t["token"], model) > min_log_ratio)
    return free_tokens(based).select("doc_id", "base", F.sort_array(F.concat("base", likely)).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts, the digest of the fixed patterns' spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:3]],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )
