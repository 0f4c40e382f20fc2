"""License detection by diagonal voting, with DataFrame operations only.

Every run of ``k`` words of a text is hashed and joined to the positions of the same hash in the templates. A match
at word ``p`` of the text and ``t`` of the template votes for the diagonal ``p - t``: where the template
would start. Votes are added up per diagonal. A phrase needs all votes of one diagonal; for a
notice, neighbouring diagonals are merged, which lets words be inserted or left out, and the span is verified by
the part of the template it covers and by its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citylake.llm.common import ascii_lower, text_of

WORD_BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
GRAM_WORDS = 2
# Notices: least part of the template's word runs in a span, greatest span per template word, and the greatest
# step between diagonals that belong together.
MIN_COVERAGE = 0.6
MAX_STRETCH = 2.0
MAX_STEP = 3
# Templates are broadcast, so their number is bounded: more are an error. Coverage is a bit mask of 64 runs.
MAX_TEMPLATES = 1000
MAX_RUNS = 64

# Phrases and their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]
# Opening words of public license notices.
NOTICES = [
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit-notice"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
]


def words_of(text: Column) -> Column:
    """Words of a text, A-Z lower-cased."""
    return F.array_remove(F.split(ascii_lower(text), WORD_BREAK), "")


def _run_at(words: str, at: Column, k: int) -> list[Column]:
    return [F.get(F.col(words), at + i) for i in range(k)]


def templates(spark: SparkSession, phrases=PHRASES, notices=NOTICES, k: int = GRAM_WORDS) -> DataFrame:
    """One row per word run of every template: its hash, its words, and where it stands."""
    if len(phrases) + len(notices) > MAX_TEMPLATES:
        raise ValueError(f"more than {MAX_TEMPLATES} templates")
    rows = [
        (number, label, exact, len(words) - k + 1, at, words[at : at + k])
        for number, (text, label, exact) in enumerate([(*p, True) for p in phrases] + [(*n, False) for n in notices])
        for words in [text.split()]
        for at in range(len(words) - k + 1)
    ]
    if any(runs > MAX_RUNS for _, _, _, runs, _, _ in rows):
        raise ValueError(f"a template has more than {MAX_RUNS} word runs")
    schema = "template int, label string, exact boolean, runs int, t int, run array<string>"
    made = spark.createDataFrame(rows, schema)
    return made.withColumn("hash", F.xxhash64(*[F.get("run", F.lit(i)) for i in range(k)]))


def spans(docs: DataFrame, phrases=PHRASES, notices=NOTICES, k: int = GRAM_WORDS) -> DataFrame:
    """Verified spans of every document, and at least one row for each document.

    Columns: ``row_id`` (one value per input row), ``doc_id``, ``n_words``, ``template``, ``label``, ``exact`` (a
    phrase), ``first_word``, ``end_word`` and ``coverage``; a row that is no span has null from
    ``template`` on. The text is scanned once and never shuffled. Null and empty texts give their one row without a span;
    rows that repeat a ``doc_id``, or have none, are scanned each. No documents give no rows.
    """
    found = F.broadcast(templates(docs.sparkSession, phrases, notices, k))
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"), "doc_id", words_of(text_of()).alias("words"))
    placed = texts.select("row_id", "doc_id", "words", F.posexplode_outer("words").alias("p", "word"))
    hashed = placed.withColumn("key", F.xxhash64(*_run_at("words", F.col("p"), k)))
    same = F.col("key") == F.col("hash")
    for i, word in enumerate(_run_at("words", F.col("p"), k)):  # equal hashes may still be different words
        same = same & (word == F.get("run", F.lit(i)))
    votes = (
        hashed.join(found, same, "left")
        .filter("template is not null or p is null or p = 0")
        .select(
            "row_id", "doc_id", F.size("words").cast("long").alias("n_words"),
            "template", "label", "exact", "runs", "t", (F.col("p") - F.col("t")).alias("diagonal"),
        )
    )
    # One shuffle of votes, by row; all that follows is grouped by it.
    doc, one = ["row_id", "doc_id", "n_words"], ["template", "label", "exact", "runs"]
    diagonals = (
        votes.repartition("row_id")
        .groupBy(*doc, *one, "diagonal")
        .agg(F.bit_or(F.expr("shiftleft(1L, t)")).alias("mask"), F.min("t").alias("low"), F.max("t").alias("high"))
    )
    along = Window.partitionBy("row_id", "template").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(along)
    apart = (F.col("exact") | F.coalesce(step > MAX_STEP, F.lit(True))).cast("int")
    merged = (
        diagonals.withColumn("apart", apart)
        .withColumn("place", F.sum("apart").over(along))
        .groupBy(*doc, *one, "place")
        .agg(
            F.min(F.col("diagonal") + F.col("low")).alias("first_word"),
            (F.max(F.col("diagonal") + F.col("high")) + k).alias("end_word"),
            (F.bit_count(F.bit_or("mask")) / F.col("runs")).alias("coverage"),
        )
    )
    fits = (F.col("coverage") >= MIN_COVERAGE) & (F.col("end_word") - F.col("first_word") <= MAX_STRETCH * (F.col("runs") + k - 1))
    good = F.when(F.col("exact"), F.col("coverage") == 1).otherwise(fits)
    names = ["template", "label", "exact", "first_word", "end_word", "coverage"]
    return merged.select(*doc, *[F.when(good, F.col(n)).alias(n) for n in names])


def annotate(docs: DataFrame) -> DataFrame:
    """One row per document with its phrase places, labels and score (the best coverage of a template).

    Null and empty texts have no words and no labels. Rows that repeat a ``doc_id``, or have none, are judged
    each. Only ``doc_id`` and ``text`` are read. No documents give no rows.
    """
    base = F.when(F.col("exact"), F.col("first_word")).cast("long")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  at most one per template
    return (
        spans(docs)
        .groupBy("row_id", "doc_id", "n_words")
        .agg(
            F.count(base).alias("n_base"),
            F.min(base).alias("first_word"),
            F.max(base).alias("last_word"),
            joined(F.when(F.col("exact"), F.col("label"))).alias("base_labels"),
            joined("label").alias("labels"),
            F.coalesce(F.max("coverage"), F.lit(0.0)).alias("score"),
        )
        .drop("row_id")
    )
