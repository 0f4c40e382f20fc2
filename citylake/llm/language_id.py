"""Language identification by a bidirectional gated recurrent network over bytes (see ``bigru``).

The network is fitted on the driver with windows of a bounded sample of labelled documents; every whole text is
then read where it lies. Nothing is shuffled but the counts of documents per language.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from citylake.llm.bigru import Reader, Weights, train
from citylake.llm.common import ship, whole_rows

UNKNOWN = "und"
FOLDS = 5
# The fit uses every language, about so many documents of each, and so many windows per document. With very many
# languages there are fewer documents of each, so that their windows stay small enough for the driver.
DOCS_PER_LANGUAGE, WINDOWS_PER_DOC = 600, 3
DOCS_IN_ALL, LEAST_PER_LANGUAGE = 64 * DOCS_PER_LANGUAGE, 20
TRAIN_BYTES = 64
# Bytes of text that a task reads at once.
BLOCK_BYTES = 4 * 1024 * 1024
# The pipeline does not trust a prediction whose score is nearer to chance than to the score that all but this share of
# the training windows reach, each language counting the same; so many windows are looked at.
DOUBTED, CALIBRATED = 0.005, 20_000

ship(__name__)


@dataclass
class Model:
    languages: list[str]
    weights: Weights | None
    min_score: float = 0.0


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents the network must not learn from: every fifth by checksum, and those without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def sample(docs: DataFrame, per_language: int = DOCS_PER_LANGUAGE, windows: int = WINDOWS_PER_DOC) -> tuple[list[str], list]:
    """Languages, and ``(language, text)`` windows at hashed places of documents drawn by hash.

    All languages count, however many and however rare; their documents are bounded by arguments. The document
    with the smallest draw is always there, so no language is without windows.
    """
    known = docs.filter(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", "lang")
    known = known.withColumn("draw", F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)))
    counts = known.groupBy("lang").agg(F.count(F.lit(1)).alias("count"), F.min("draw").alias("first")).collect()
    languages = sorted(r["lang"] for r in counts)
    if not languages:
        return [], []
    per_language = min(per_language, max(LEAST_PER_LANGUAGE, DOCS_IN_ALL // len(languages)))
    below = [(r["lang"], max(r["first"] + 1, int(min(1.0, 1.2 * per_language / r["count"]) * (1 << 30)))) for r in counts]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(below, "lang string, below long"))
    at = [F.pmod(F.xxhash64("text", F.lit(k)), F.greatest(F.length("text") - TRAIN_BYTES, F.lit(1))) for k in range(windows)]
    parts = F.array(*[F.substring("text", (a + 1).cast("int"), F.lit(TRAIN_BYTES)) for a in at])
    chosen = known.join(bounds, "lang").filter(F.col("draw") < F.col("below")).select("lang", "draw", parts.alias("parts"))
    # Copies of a row have one draw, and would all be drawn.
    drawn = sorted(chosen.dropDuplicates(["lang", "draw"]).collect(), key=lambda r: (r["draw"], r["lang"]))
    return languages, [(r["lang"], part) for r in drawn for part in r["parts"]]


def trusted_from(weights: Weights, windows, labels) -> float:
    """Halfway from chance to the score that all but ``DOUBTED`` of the windows reach, each class counting the same.

    Whole texts are noisier than windows the network has learned from, hence not that score itself. A single class
    is always predicted with certainty, and nothing can be told from it.
    """
    import numpy as np

    if (classes := len(weights.out_bias)) == 1:
        return 0.0
    some = np.random.default_rng(5).permutation(len(windows))[:CALIBRATED]
    scores = Reader(weights).pooled([w.tobytes() for w in windows[some]]).max(1)
    each = 1 / np.bincount(labels[some])[labels[some]]
    order = np.argsort(scores)
    share = np.cumsum(each[order]) / each.sum()
    return float(scores[order][np.searchsorted(share, DOUBTED)] + 1 / classes) / 2


def fit(docs: DataFrame, **training) -> Model:
    """Network fitted on labelled documents that are not held out; no such documents, no languages.

    With more than eight languages the network has more units and takes more steps, unless told otherwise.
    """
    import numpy as np

    languages, rows = sample(docs)
    if not rows:
        return Model([], None)
    raw = [part.encode() for _, part in rows]
    windows = np.array([np.resize(np.frombuffer(x, "u1"), TRAIN_BYTES) for x in raw])
    number = {lang: k for k, lang in enumerate(languages)}
    labels = np.array([number[lang] for lang, _ in rows])
    scale = max(1.0, len(languages) / 8)
    training = {"size": min(32, int(8 * scale**0.5)), "steps": min(2000, int(400 * scale**0.5)), **training}
    weights = train(windows, labels, len(languages), **training)
    return Model(languages, weights, trusted_from(weights, windows, labels))


def _predictions(model: Model, inside: str | None = None):
    """Adds ``lang_pred`` and ``score`` to batches. The text is a column, or a field of the column ``inside``."""

    def predicted(texts: list) -> tuple[list, list]:
        """Languages and scores of texts (or None)."""
        letters = [i for i, x in enumerate(texts) if x is not None and any(map(str.isalpha, x))]
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if letters and model.weights is not None:
            pooled = Reader(model.weights).pooled([texts[i].encode() for i in letters])
            for i, p in zip(letters, pooled):
                languages[i], scores[i] = model.languages[int(p.argmax())], min(1.0, float(p.max()))
        return languages, scores

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in batches:
            text = pc.struct_field(batch.column(inside), "text") if inside else batch.column("text")
            size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            block = np.cumsum(size, dtype="i8") // BLOCK_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
            languages, scores = [], []
            for low, high in zip(cuts, cuts[1:]):
                found = predicted(text.slice(low, high - low).to_pylist())
                languages, scores = languages + found[0], scores + found[1]
            others = [n for n in batch.schema.names if n != "text"]
            columns = [*[batch.column(n) for n in others], pa.array(languages, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*others, "lang_pred", "score"])
            pa.default_memory_pool().release_unused()  # the worker lives on, beside those of other tasks

    return run


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (mean probability over all positions) of every row.

    ``und`` with score 0 where the text is null or has no letter, or the model knows no language. A null ``doc_id``
    counts as held out. Rows that repeat a ``doc_id`` are read each. Language, source and id play no part in a
    prediction. No documents give no rows.
    """
    rows = docs.select(F.col("doc_id").cast("bigint"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(_predictions(model), "doc_id bigint, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, min_score: float | None = None) -> DataFrame:
    """Documents, with all their columns, whose language is known with at least ``min_score``, or else the model's.

    Texts that are null or without a letter have no language and go. Rows that repeat a ``doc_id``, or have none, are
    judged each, and a score equal to the bound stays. No documents give no rows. Columns may have any names.
    """
    min_score = model.min_score if min_score is None else min_score
    rows = whole_rows(docs)
    schema = StructType([rows.schema["doc"], StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    found = rows.mapInArrow(_predictions(model, "doc"), schema)
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("doc.*")
