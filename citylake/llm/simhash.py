"""SimHash near-duplicates by a segment-popcount embedding.

A fingerprint of 64 bits becomes a vector of 32 bit counts, one for each segment of two bits. Two fingerprints
differ in at least as many bits as the Manhattan distance of their vectors. The axes are cut into six groups. Vectors
at a distance of three or less differ in three groups at most, so they share the grid cell that the other three
groups' coordinates span; there are twenty grids, one for each choice of three groups. Within a cell,
pairs beyond the Manhattan distance go first, and the rest is verified by the exact number of differing bits.

Equal fingerprints are one point. A cell of many points is dealt out in pairs of blocks, so that no task holds
more than two blocks, and a task gives only links that join what it had not joined before: no group is
written out as all its pairs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.llm.common import ship, staged, text_of, whole_rows
from citylake.llm.components import components

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
# Points of a cell that one block holds; a task compares two blocks at most.
BLOCK_POINTS = 2048
# Segments per axis group: 32 two-bit segments in six groups.
AXES = (6, 6, 5, 5, 5, 5)
LOW_BITS = 0x5555555555555555

ship(__name__)


def fingerprint(text: str, words_each: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """Unsigned fingerprint of a text; zero where it has no word."""
    import numpy as np
    import xxhash

    words = text.encode().lower().split()  # on bytes, both look at ASCII only
    if not words:
        return 0
    grams = [b" ".join(g) for g in zip(*[words[i:] for i in range(words_each)])] or [b" ".join(words)]
    hashes = np.array([xxhash.xxh64_intdigest(g, seed) for g in grams], "<u8")
    counts = np.zeros(64, "i8")
    for block in np.array_split(hashes, len(hashes) // 65536 + 1):
        counts += np.unpackbits(block.view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype="i8")
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_batches(batches: Iterator) -> Iterator:
    """The text column, which is the last, becomes its fingerprint."""
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        found = (fingerprint(text.as_py()) for text in batch.column("text"))
        prints = np.fromiter(found, "u8", batch.num_rows).view("i8")
        names = [*batch.schema.names[:-1], "fp"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints)], names)


def fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint's bits as a long) of every row."""
    rows = docs.select(F.col("doc_id").cast("bigint"), text_of().alias("text"))
    return rows.mapInArrow(_fingerprint_batches, "doc_id bigint, fp bigint")


def embedding(fp: Column) -> Column:
    """Bit counts (0 to 2) of the 32 two-bit segments, two bits each, in one long."""
    low = F.lit(LOW_BITS)
    a, b = fp.bitwiseAND(low), F.shiftrightunsigned(fp, 1).bitwiseAND(low)
    return a.bitwiseXOR(b).bitwiseOR(F.shiftleft(a.bitwiseAND(b), 1))


def grid_masks() -> list[int]:
    """For every choice of three axis groups, the bits of the embedding they cover (as a signed long)."""
    ends = list(itertools.accumulate(AXES))
    groups = [sum(3 << 2 * s for s in range(end - n, end)) for n, end in zip(AXES, ends)]
    masks = [sum(chosen) for chosen in itertools.combinations(groups, len(AXES) - MAX_BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _links(batches: Iterator) -> Iterator:
    """Links within the cells of sorted rows ``(grid, cell, i, j, fp)``; a cell's rows lie together."""
    import numpy as np
    import pyarrow as pa

    low = np.uint64(LOW_BITS)

    def counts(fp):
        a, b = fp & low, (fp >> np.uint64(1)) & low
        return (a ^ b) | ((a & b) << np.uint64(1))

    def manhattan(x, y):
        unlike = x ^ y
        ones = unlike & low
        twos = (unlike >> np.uint64(1)) & low & ~ones
        odd = ((unlike >> np.uint64(1)) & low) & ones
        return np.bitwise_count(ones | odd) + 2 * np.bitwise_count(twos)

    def links_of(key, fp):
        """Spanning links of every cell: distances at all offsets, joining as it goes."""
        vector, root = counts(fp), np.arange(len(fp))
        us, vs = [], []
        at = np.arange(len(fp))
        for offset in range(1, len(fp)):
            at = at[: np.searchsorted(at, len(fp) - offset)]
            at = at[key[at] == key[at + offset]]
            if not len(at):
                break
            near = at[manhattan(vector[at], vector[at + offset]) <= MAX_BITS]
            near = near[np.bitwise_count(fp[near] ^ fp[near + offset]) <= MAX_BITS]
            near = near[root[near] != root[near + offset]]
            if len(near):
                us.append(fp[near])
                vs.append(fp[near + offset])
                while len(near):  # hang the larger root of each link under the smaller one
                    a, b = root[near], root[near + offset]
                    np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
                    while not np.array_equal(up := root[root], root):
                        root = up
                    near = near[root[near] != root[near + offset]]
        return np.concatenate([np.zeros(0, "u8"), *us]).view("i8"), np.concatenate([np.zeros(0, "u8"), *vs]).view("i8")

    def cells() -> Iterator:
        """Whole cells: what a batch leaves of its last cell goes before the next batch."""
        held = None
        for batch in batches:
            got = pa.Table.from_batches([batch])
            held = got if held is None else pa.concat_tables([held, got])
            columns = [held.column(n).to_numpy() for n in ("grid", "cell", "i", "j")]
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
            if len(change):
                yield change, held.column("fp").to_numpy(), int(change[-1])
                held = held.slice(int(change[-1]))
        if held is not None and held.num_rows:
            yield np.zeros(0, "i8"), held.column("fp").to_numpy(), held.num_rows

    for change, fp, end in cells():
        key = np.zeros(end, "i8")
        key[change[change < end]] = 1
        u, v = links_of(np.cumsum(key), fp[:end].view("u8"))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def links(points: DataFrame, block: int = BLOCK_POINTS) -> DataFrame:
    """Links ``u, v`` between different fingerprints ``fp`` that reach all that differ in three bits or fewer."""
    vector = embedding(F.col("fp"))
    grids = F.array(*[
        F.struct(F.lit(g).alias("grid"), vector.bitwiseAND(F.lit(m)).alias("cell")) for g, m in enumerate(grid_masks())
    ])
    placed = points.select("fp", F.inline(grids))
    crowded = placed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = "pmod(xxhash64(fp), blocks)"
    dealt = (
        placed.join(crowded, ["grid", "cell"])
        .withColumn("blocks", F.expr(f"cast(ceil(n / {block}) as int)"))
        .withColumn("own", F.expr(f"cast({own} as int)"))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .select("grid", "cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    keys = ["grid", "cell", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "fp").mapInArrow(_links, "u bigint, v bigint")


def classes(prints: DataFrame) -> DataFrame:
    """``fp``, ``root`` (the smallest fingerprint) and ``component_id`` (the smallest ``doc_id``) of its component, for each."""
    points = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    roots = components(links(points)).withColumnRenamed("node", "fp")
    rooted = points.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return staged(rooted.join(smallest, "root").select("fp", "root", "component_id"), "classes")


def annotate(docs: DataFrame) -> DataFrame:
    """Every row with its fingerprint (16 hexadecimal digits) and component.

    Null text equals empty text: fingerprint zero, which links like any other. A null ``doc_id`` keeps its
    row and counts only where a component has no other id (then ``component_id`` is null). Rows that repeat a
    ``doc_id`` are separate texts under one id. No documents give no rows.
    """
    prints = staged(fingerprints(docs), "fingerprints")
    # Copies of one text meet one row of classes(); AQE splits them.
    return prints.join(classes(prints), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def deduplicate(docs: DataFrame) -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest ``doc_id``, of equal ids one of them.

    Null text equals empty text. A row without an id stays only where its component has no row with one. Rows that repeat
    an id are judged each by its own text, so a near copy goes and a clean text under the same id stays. Of rows that are
    equal in every column one is taken. No documents give no rows. Columns may have any names.
    """
    # A digest of the whole row tells rows of one id apart.
    rows = whole_rows(docs, "doc_id").select("doc", F.col("doc_id").cast("bigint"), F.xxhash64("doc").alias("row_key"))
    keyed = rows.select("doc_id", "row_key", text_of("doc.text").alias("text"))
    prints = staged(keyed.mapInArrow(_fingerprint_batches, "doc_id bigint, row_key bigint, fp bigint"), "fingerprints")
    roots = classes(prints).select("fp", "root")
    # Equal rows are one; the smallest of a component is an aggregate that combines before it shuffles.
    rows_of = prints.groupBy("fp", "doc_id", "row_key").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key", "n")
    of_print = rows_of.groupBy("fp").agg(F.min(order).alias("first"))
    first = of_print.join(roots, "fp").groupBy("root").agg(F.min("first").alias("first")).select("first.*")
    stays = staged(first.select(F.col("doc_id").alias("keep_id"), "row_key", "n"), "near-copies-kept")

    def kept(number: str) -> DataFrame:
        found = rows.join(stays.filter(number), "row_key")
        return found.filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))).select("doc.*")

    return kept("n = 1").unionByName(kept("n > 1").dropDuplicates())
