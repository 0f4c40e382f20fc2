"""Personal data: four fixed patterns, and terms that give a protected entity away.

An entity is a value the fixed patterns find. The corpus says how much a term reveals of it: their pointwise
mutual information over the entity's own information content, counted in whole documents over the whole corpus. The
quotient is 1 for a term that occurs with the entity only. Terms above one threshold are generalised, above a
higher one removed, in all documents and wherever they stand: in one without the entity they still point to it.

An entity in fewer documents than a pair must share has no such pair, so only the distinct words of documents with
more frequent entities are paired. The terms found go to the workers, if they are few enough, and the texts are
read where they lie. Counts combine before the shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged, text_of, whole_rows

ship(__name__)

KINDS = ["email", "ip", "card", "phone"]
# Characters of the shortest word that is a term.
TERM_CHARS = 3
# Documents that must hold both, before their number says anything.
MIN_DOCUMENTS = 3
# Share of an entity's information that a term may reveal before it is generalised, or removed.
GENERALISE, REMOVE = 0.8, 0.95
# Characters of text whose terms a worker counts before it passes the counts on.
COUNTED_CHARS = 32 * 1024 * 1024
# Disclosing terms, and bytes of them, that every worker can hold; with more, words and terms are joined.
HELD_TERMS, HELD_BYTES = 200_000, 8 * 1024 * 1024

DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Digits are taken possessively from the start of their run: no other start could match, and none is tried.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"\w+")

SPAN = "struct<rank:int,start:int,end:int,kind:string>"
FOUND = "entities array<bigint>, terms array<string>"
JUDGED = f"doc_id bigint, key bigint, base array<{SPAN}>, spans array<{SPAN}>"
SPELLED = f"doc_id bigint, key bigint, base array<{SPAN}>, words array<struct<term:string,starts:array<int>>>"


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the address pattern, in one pass: every ``@`` looks back to the last match at most."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            end = domain.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """``(rank of kind, start, end, entity)`` of all base spans; ``entity`` is the value without its spelling."""
    spans = [(0, s, e, "email:" + text[s:e].lower()) for s, e in emails(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m[0].split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                spans.append((1, *m.span(), "ip:" + ".".join(p or "0" for p in parts)))
        for m in CARD.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append((2, *m.span(), "card:" + digits))
        for m in PHONE.finditer(text):
            digits = re.sub("[^0-9]", "", m[0])
            if 9 <= len(digits) <= 15:
                spans.append((3, *m.span(), "phone:" + digits))
    return spans


def lowered(word: str) -> str:
    """Lower case, unless that changes the number of characters."""
    low = word.lower()
    return low if len(low) == len(word) else word


def free_words(text: str, spans: list) -> dict[str, list[int]]:
    """All places of every term that do not overlap a base span."""
    taken, places, k = sorted((start, end) for _, start, end, _ in spans), {}, 0
    reach = []  # furthest end of the spans so far
    for _, end in taken:
        reach.append(max(end, reach[-1]) if reach else end)
    for m in WORD.finditer(text):
        while k < len(taken) and taken[k][0] < m.end():
            k += 1
        if len(m[0]) >= TERM_CHARS and not (k and reach[k - 1] > m.start()):
            places.setdefault(lowered(m[0]), []).append(m.start())
    return places


def _found(batches: Iterator) -> Iterator:
    import pyarrow as pa
    import xxhash

    for batch in batches:
        entities, terms = [], []
        for text in batch.column("text"):
            text = text.as_py()
            if spans := base_spans(text):
                entities.append([xxhash.xxh64_intdigest(e.encode()) - (1 << 63) for e in {s[3] for s in spans}])
                terms.append(list(free_words(text, spans)))
        columns = [pa.array(entities, pa.list_(pa.int64())), pa.array(terms, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["entities", "terms"])


def _judged(removed: dict[str, bool] | None):
    """Base spans of every row, with those of the given terms, or (None) with all its words and their places."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        span = pa.struct([("rank", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])
        word = pa.struct([("term", pa.string()), ("starts", pa.list_(pa.int32()))])
        marks = {False: (len(KINDS), "generalise"), True: (len(KINDS) + 1, "remove")}
        for batch in batches:
            base, more = [], []
            for text in batch.column("text"):
                text = text.as_py()
                found = base_spans(text)
                base.append([(k, s, e, KINDS[k]) for k, s, e, _ in found])
                if removed is None:
                    more.append(list(free_words(text, found).items()))
                    continue
                spans = list(base[-1])
                if removed and any(lowered(w) in removed for w in set(WORD.findall(text))):
                    for term, starts in free_words(text, found).items():
                        if term in removed:
                            rank, kind = marks[removed[term]]
                            spans += [(rank, start, start + len(term), kind) for start in starts]
                more.append(sorted(spans))
            last = pa.array(more, pa.list_(word if removed is None else span))
            columns = [batch.column("doc_id"), batch.column("key"), pa.array(base, pa.list_(span)), last]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "base", "words" if removed is None else "spans"])

    return run


def _term_counts(batches: Iterator) -> Iterator:
    """Documents per term, added up for a bounded number of characters at a time."""
    from collections import Counter

    import pyarrow as pa

    def passed_on(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["term", "n"])

    counts, held = Counter(), 0
    for batch in batches:
        for text in batch.column("text"):
            text = text.as_py()
            counts.update({lowered(w) for w in set(WORD.findall(text)) if len(w) >= TERM_CHARS})
            held += len(text)
            if held >= COUNTED_CHARS:
                yield passed_on(counts)
                counts, held = Counter(), 0
    yield passed_on(counts)


def find(docs: DataFrame) -> DataFrame:
    """One stored row per document with entities: ``row_id``, its distinct ``entities`` and other ``terms``."""
    found = docs.select(text_of().alias("text")).mapInArrow(_found, FOUND)
    return staged(found.withColumn("row_id", F.monotonically_increasing_id()), "pii")


def disclosing(docs: DataFrame, found: DataFrame, least: float = GENERALISE, documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``entity``, ``term`` and ``revealed``, the share of the entity's information, from ``least`` up."""
    total = docs.count()
    held = found.select("row_id", F.explode("entities").alias("entity"))
    entities = held.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= documents)
    pairs = (
        found.select("row_id", "terms")
        .join(held.join(entities, "entity").select("row_id", "entity"), "row_id")
        .select("entity", F.explode("terms").alias("term"))
        .groupBy("entity", "term")
        .agg(F.count(F.lit(1)).alias("n_both"))
    )
    counted = docs.select(text_of().alias("text")).mapInArrow(_term_counts, "term string, n bigint")
    terms = counted.groupBy("term").agg(F.sum("n").alias("n_term"))
    bits = F.log2(F.col("n_both") * float(total) / (F.col("n_entity").cast("double") * F.col("n_term")))
    content = F.log2(float(total) / F.col("n_entity"))
    return (
        pairs.filter(F.col("n_both") >= documents)
        .join(entities, "entity")
        .join(terms, "term")
        .select("entity", "term", F.try_divide(bits, content).alias("revealed"))
        .filter(F.col("revealed") >= least)
    )


def spans(docs: DataFrame, generalise: float = GENERALISE, remove: float = REMOVE, documents: int = MIN_DOCUMENTS, held_terms: int = HELD_TERMS) -> DataFrame:
    """``doc_id``, ``key``, ``base`` and ``spans`` (base and disclosing terms, by kind, then start) of every row.

    A span is ``(rank, start, end, kind)`` in code points; kinds beyond the base are ``generalise`` and ``remove``.
    A term counts in every document, by the entity it reveals most of. Where it overlaps a base span it is left to
    that. Null and empty texts have no spans. Rows that repeat a ``doc_id``, or have none, are judged each, and
    count as documents each. An entity that every document holds has no information to give away. No documents give
    no rows.
    """
    pairs = disclosing(docs, find(docs), generalise, documents)
    terms = staged(pairs.groupBy("term").agg((F.max("revealed") >= remove).alias("removed")), "disclosing")
    rows = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("key"), text_of().alias("text"))
    n, size = terms.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
    if n <= held_terms and size <= HELD_BYTES:
        return rows.mapInArrow(_judged({r["term"]: r["removed"] for r in terms.collect()}), JUDGED)
    # A term that very many documents hold meets one row; AQE splits its documents.
    spelled = staged(rows.mapInArrow(_judged(None), SPELLED).withColumn("row_id", F.monotonically_increasing_id()), "spelled")
    hits = (
        spelled.select("row_id", F.inline("words"))
        .join(terms, "term")
        .select("row_id", F.explode("starts").alias("start"), "term", "removed")
        .groupBy("row_id")
        .agg(F.collect_list(F.struct(
            F.when(F.col("removed"), len(KINDS) + 1).otherwise(len(KINDS)).alias("rank"), "start",
            (F.col("start") + F.length("term")).alias("end"),
            F.when(F.col("removed"), F.lit("remove")).otherwise(F.lit("generalise")).alias("kind"),
        ).cast(SPAN)).alias("more"))
    )
    more = F.coalesce("more", F.array().cast(f"array<{SPAN}>"))
    return spelled.join(hits, "row_id", "left").select("doc_id", "key", "base", F.array_sort(F.concat("base", more)).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans, and all spans as text."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(joined(F.array_sort("base")), 256).alias("base_sha256"), joined("spans").alias("spans")
    )


def _cleaned(texts, spans) -> list:
    """Texts with base spans and generalised terms replaced by their kind, and removed terms taken out."""
    out = []
    for text, found in zip(texts, spans):
        last, parts = 0, []
        for s in sorted(found if found is not None else [], key=lambda s: (s["start"], -s["end"])):
            if s["start"] < last:
                continue
            value = text[s["start"] : s["end"]]
            plain = "NUMBER" if value.isdigit() else "NAME" if value[:1].isupper() else "TERM"
            shown = {"remove": "", "generalise": f"[{plain}]"}.get(s["kind"], f"[{s['kind'].upper()}]")
            parts += [text[last : s["start"]], shown]
            last = s["end"]
        out.append(text if text is None else "".join(parts) + text[last:])
    return out


def sanitise(docs: DataFrame, **thresholds) -> DataFrame:
    """The documents, with all their columns and a cleaned ``text``. Of overlapping spans the first counts.

    Every row stays, one for one: rows that repeat a ``doc_id``, or have none, are cleaned each by their own text. Null text
    stays null, empty text empty. No documents give no rows. Columns may have any names.
    """
    @F.pandas_udf("string")
    def cleaned(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series(_cleaned(text, spans), dtype=object)

    found = spans(docs, **thresholds).select(F.col("doc_id").alias("of"), "key", "spans").dropDuplicates(["of", "key"])
    rows = whole_rows(docs, "doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key"))
    joined = rows.join(found, same, "left").withColumn("clean", cleaned("text", "spans"))
    return joined.select(*[F.col("clean").alias(c) if c == "text" else F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
