"""How far the sources of a language diverge in their words, by joint tables of count levels.

The divergence of two sources depends on a term only through its two counts. So each block of terms becomes a matrix of
indicator columns, one for every count level of every source (zero included); the transposed matrix times the matrix counts, for
every pair of sources at once, the terms at each pair of levels, and each cell of these joint tables is priced once. The blocks
hold terms of similar frequency: rare terms have few levels, so many of them share a narrow matrix, and frequent ones
are cut into small matrices. All arithmetic is on whole numbers; a product of indicators is exact in floating point.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged

MIN_DOCS = 3
TOP_TERMS = 200
UNIT = 1_000_000_000
# Entries that a task counts before it passes them on.
HELD_TERMS = 400_000
# Counts of one block of terms, on average, and the columns of one matrix.
BLOCK_CELLS = 65_536
COLUMNS = 1024
MATRIX_CELLS = 1 << 22

# Characters below 128 that are no letters part terms; A-Z is lower-cased, everything above 127 belongs to a term.
TERM_BYTES = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))

ship(__name__)


def terms(text: str) -> list[bytes]:
    """Terms of a text in UTF-8."""
    return text.encode().translate(TERM_BYTES).split()


def _count(batches: Iterator) -> Iterator:
    """Occurrences and documents of every term by language and source, added up within a task."""
    import pyarrow as pa

    def told(seen: dict) -> Iterator:
        for (lang, source), (n, docs) in seen.items():
            if n:
                words = [w.decode() for w in n]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(n)), pa.array([source] * len(n)), pa.array(words),
                        pa.array(list(n.values()), pa.int64()), pa.array([docs[w] for w in n], pa.int64()),
                    ],
                    ["lang", "source", "term", "n", "docs"],
                )

    seen: dict = defaultdict(lambda: (Counter(), Counter()))
    held = 0
    for batch in batches:
        for lang, source, text in zip(*[batch.column(c) for c in ("lang", "source", "text")]):
            words = terms(text.as_py())
            n, docs = seen[lang.as_py(), source.as_py()]
            held -= len(n)
            n.update(words)
            docs.update(set(words))
            held += len(n)
            if held > HELD_TERMS:
                yield from told(seen)
                seen.clear()
                held = 0
    yield from told(seen)


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])


def counts(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, source, term, n, total, first`` for each kept term and source it occurs in.

    Kept are the terms of at least ``min_docs`` documents of the language; ``total`` is the term's count in the language and
    ``first`` marks one row of each term. Tasks add up before the shuffle, by language and term, so a very frequent
    term brings one row per task and source.
    """
    told = _named(docs).mapInArrow(_count, "lang string, source string, term string, n bigint, docs bigint")
    dealt = told.repartition("lang", "term").groupBy("lang", "term", "source")
    cells = dealt.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    whole = Window.partitionBy("lang", "term")
    seen = cells.withColumns({
        "in_docs": F.sum("docs").over(whole), "total": F.sum("n").over(whole), "first": F.col("source") == F.min("source").over(whole),
    })
    return seen.filter(F.col("in_docs") >= min_docs).select("lang", "source", "term", "n", "total", "first")


def share(count: str, n: str, v: str) -> Column:
    """One plus the term's share of the kept terms, in units of a billionth, counting each once more; NULL without terms."""
    wide = lambda x: f"cast({x} as decimal(19,0))"
    return F.expr(f"case when {v} > 0 then 1L + ({wide(UNIT)} * ({wide(count)} + 1)) div ({wide(n)} + {wide(v)}) end")


def group_totals(docs: DataFrame, cells: DataFrame) -> DataFrame:
    """``lang, source, n, lang_n, v`` of every group: kept occurrences in it and in its language, and kept terms."""
    found = docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    summed = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"), F.count_if("first").alias("firsts"))
    by_lang = summed.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.sum("firsts").alias("v"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    joined = found.join(summed.drop("firsts"), ["lang", "source"], "left").join(by_lang, "lang", "left")
    return joined.select("lang", "source", *[zero(c) for c in ("n", "lang_n", "v")])


def joint_price(term, group, level, p, n_groups: int, zero_p):
    """Summed price of every ordered pair of groups over some terms.

    ``term``, ``group``, ``level`` and ``p`` tell the counts above zero; ``zero_p`` is each group's p at count zero.
    """
    import numpy as np

    out = np.zeros((n_groups, n_groups), "i8")

    def product(lo: int, hi: int) -> None:
        """Terms from ``lo`` to ``hi``, halved until their indicator matrix is narrow."""
        own = slice(np.searchsorted(term, lo), np.searchsorted(term, hi))
        _, rank = np.unique(level[own], return_inverse=True)
        _, first, at = np.unique(group[own] * (len(rank) + 1) + rank, return_index=True, return_inverse=True)
        width = len(first)
        if hi - lo > 1 and (width > COLUMNS or (hi - lo) * (width + n_groups) > MATRIX_CELLS):
            middle = (lo + hi) // 2
            product(lo, middle)
            product(middle, hi)
            return
        x = np.zeros((hi - lo, width + n_groups), "f4")
        x[:, width:] = 1
        x[term[own] - lo, at] = 1
        x[term[own] - lo, width + group[own]] = 0
        of = np.concatenate([group[own][first], np.arange(n_groups)])
        price_at = np.concatenate([p[own][first], zero_p])
        # Terms lo..hi are fewer than 2^24, so counts are exact; blocks of columns bound the joint tables' memory.
        for start in range(0, len(of), 2 * COLUMNS):
            joint = x[:, start : start + 2 * COLUMNS].T @ x
            a, b = np.nonzero(joint)
            n = joint[a, b].astype("i8")
            a += start
            unlike = of[a] != of[b]
            a, b, n = a[unlike], b[unlike], n[unlike]
            far = price_at[a] - price_at[b]
            np.add.at(out, (of[a], of[b]), n * (far * far // price_at[b]))

    if len(term):
        product(0, int(term[-1]) + 1)
    return out


def _price_block(table):
    """Rows of one block: counts (with a term) and all groups of the language (without) to prices of pairs of groups."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    groups = table.filter(pc.is_null(table.column("term"))).sort_by("source")
    names = groups.column("source").combine_chunks()
    cells = table.filter(pc.is_valid(table.column("term"))).sort_by([("total", "ascending"), ("term", "ascending")])
    words = cells.column("term").combine_chunks().dictionary_encode().indices.to_numpy()
    group = pc.index_in(cells.column("source"), names).combine_chunks().to_numpy().astype("i8")
    prices = joint_price(
        words, group, cells.column("n").to_numpy(), cells.column("p").to_numpy(), len(names), groups.column("p").to_numpy()
    )
    a, b = np.nonzero(~np.eye(len(names), dtype=bool))
    lang = pa.array([table.column("lang")[0].as_py()] * len(a), pa.string())
    return pa.table({"lang": lang, "source": names.take(pa.array(a)), "item": names.take(pa.array(b)), "value": pa.array(prices[a, b])})


def pair_prices(cells: DataFrame, groups: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of sources of a language that has kept terms.

    A block holds terms of one octave of frequency, dealt by a hash of the term into parts of about ``block_cells``
    counts. Every block also gets its language's groups, whose count may be zero for any term.
    """
    banded = cells.withColumn("octave", F.length(F.bin("total")))
    sizes = banded.groupBy("lang", "octave").agg(F.expr(f"cast(ceil(count(*) / {block_cells}) as int)").alias("parts"))
    parts = staged(sizes, "block-parts")  # its size is known to the planner, which broadcasts it only where it is small
    key = ["lang", "octave", "part"]
    dealt = banded.join(parts, ["lang", "octave"]).withColumn("part", F.expr("cast(pmod(xxhash64(term), parts) as int)"))
    priced = dealt.join(groups.withColumnRenamed("n", "group_n"), ["lang", "source"]).select(
        *key, "source", "term", "total", "n", share("n", "group_n", "v").alias("p")
    )
    blocks = parts.select("lang", "octave", F.explode(F.expr("sequence(0, parts - 1)")).alias("part"))
    zeros = blocks.join(groups, "lang").select(
        *key, "source", F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("total"),
        F.lit(0).cast("bigint").alias("n"), share("0", "n", "v").alias("p"),
    )
    # Dealt by the whole key, so that the parts of one octave do not stay where a join by octave has put them.
    blocked = priced.unionByName(zeros).repartition(*key).groupBy(*key)
    found = blocked.applyInArrow(_price_block, "lang string, source string, item string, value bigint")
    return found.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``lang, source, part, item, value, rank``: for each source of a language how far it is from each other one
    (part ``pair``), and the terms that it favours most over the language (part ``term``, the first ``top_terms``).

    With p and q the shares of a term, the value is floor((p - q)^2 / q); q belongs to the other source, or to the
    language. Null text, language and source count as empty. A source without terms is compared all the same, by
    zero counts; in a language that keeps no term all pairs have the value 0. A language of one source has no pairs. Equal
    values go by the item's UTF-8. Rows that repeat a ``doc_id`` are documents each; no id is read. No documents give
    no rows. Further columns are not read.
    """
    cells = staged(counts(docs, min_docs), "term-counts")
    groups = staged(group_totals(docs, cells), "source-totals")
    priced = pair_prices(cells, groups, block_cells)
    every = groups.select("lang", "source").join(groups.select("lang", F.col("source").alias("item")), "lang").filter("source <> item")
    pairs = every.join(priced, ["lang", "source", "item"], "left").withColumn("value", F.coalesce("value", F.lit(0).cast("bigint")))

    shared = cells.join(groups.withColumnRenamed("n", "group_n"), ["lang", "source"]).select(
        "lang", "source", F.col("term").alias("item"), share("n", "group_n", "v").alias("p"), share("total", "lang_n", "v").alias("q")
    )
    favoured = shared.filter("p > q").select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = pairs.withColumns({"part": F.lit("pair"), "rank": F.row_number().over(best)}).select(*columns)
    ranked = favoured.withColumns({"part": F.lit("term"), "rank": F.row_number().over(best)})
    return pair.unionByName(ranked.filter(F.col("rank") <= top_terms).select(*columns))
