"""Training-data pipeline: language, exact copies, near copies, source mix, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before it kept; all but the last give the
columns of ``documents``. Empty tables give empty tables. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citylake.llm import exact_dedup, language_id, mixing, packing, simhash
from citylake.llm.common import staged, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network tells; it learns from the labelled ones that are not held out.

    Null texts and those without a letter go; repeated rows and null ids are judged each. Without labels no language is
    known, and all documents go.
    """
    return language_id.accepted(docs, language_id.fit(docs))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays.

    Null text equals empty text, a null id loses against any other, and of rows alike in id and text one stays, or one of
    each if they differ in another column.
    """
    index = exact_dedup.DigestIndex.temporary(spark, docs)
    kept = exact_dedup.deduplicate(docs, index)
    index.close()
    return kept


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near copies the document with the smallest id stays.

    Rows of one id are judged each by their own text, null ids too; texts without a word are near copies of each other.
    """
    return simhash.deduplicate(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents in a global random order, as many as bring each source to its share.

    A null source is a source of its own. A document may be drawn several times or, where its source has more than
    its share, not at all.
    """
    return mixing.mix(docs).select("doc.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences; one row per piece of a document. Null text counts as empty and has its end mark alone."""
    return packing.pack(docs)


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash", near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

# Language identification and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the last stage over ``documents``; each stage's rows are written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
