import numpy as np
import xxhash

from citylake.llm import simhash as sh
from citylake.llm.components import components
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        ids = least.setdefault(find(k), [])
        ids += [doc_id] if doc_id is not None else []
    return sorted(
        ((i, f"{prints[k]:016x}", min(least[find(k)], default=None)) for k, (i, _) in enumerate(rows)), key=str
    )


def test_against_brute_force(spark):
    for docs in (documents(spark), odd_documents(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        assert sorted(map(tuple, sh.annotate(docs).collect()), key=str) == brute(rows)


def near(seed, n):
    """Fingerprints in chains and clusters of few differing bits, with sign bits, and far ones between."""
    rng = np.random.default_rng(seed)
    out = [0, 1 << 63, (1 << 64) - 1]
    for _ in range(n):
        at = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 8))):
            out.append(at)
            for bit in rng.choice(64, int(rng.integers(1, 5)), replace=False):
                at ^= 1 << int(bit)
    return sorted(set(out))


def test_links_join_all_that_is_near_and_nothing_else(spark):
    values = near(3, 120)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    points = spark.createDataFrame([(v,) for v in signed], "fp bigint")
    for block in (2048, 3):  # with small blocks, cells are dealt out in pairs of blocks
        found = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in sh.links(points, block).collect()]
        assert all(0 < (a ^ b).bit_count() <= 3 for a, b in found)
        roots = {v: v for v in values}
        for pairs in (found, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3]):
            seen = dict(roots)
            for _ in range(len(values)):
                was = dict(seen)
                for a, b in pairs:
                    seen[a] = seen[b] = min(seen[a], seen[b])
                if was == seen:
                    break
            pairs[:] = sorted(seen.items())
        assert pairs == found


def test_embedding_is_a_lower_bound(spark):
    values = [v - (1 << 64) if v >> 63 else v for v in near(5, 20)]
    rows = spark.createDataFrame([(v,) for v in values], "fp bigint").withColumn("e", sh.embedding(sh.F.col("fp")))
    for fp, e in rows.collect():
        assert [(e >> 2 * s) & 3 for s in range(32)] == [(fp >> 2 * s & 3).bit_count() for s in range(32)]


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (102, 101), (200, 200), (-5, 300)]
    found = dict(components(spark.createDataFrame(chain, "u bigint, v bigint")).collect())
    assert found == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100, -5: -5, 300: -5}
    assert components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_stage(spark):
    base = " ".join(f"w{i}" for i in range(400))
    docs = docs_of(spark, [(1, base), (2, base + " end"), (3, "something else entirely"), (None, "no id"), (4, None)])
    docs = clashing(docs, "fp", "component_id", "doc", "root")
    kept = sh.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"] for r in kept.collect()), key=str) == [1, 3, 4, None]
    assert sh.annotate(empty_documents(spark)).count() == 0 and sh.deduplicate(empty_documents(spark)).count() == 0


def test_stage_keeps_one_row_of_each_component(spark):
    """Ids that repeat with other texts, and rows without an id, are judged by their own text."""
    base = " ".join(f"w{i}" for i in range(400))
    rows = [(5, base), (5, base + " end"), (None, base + " fin"), (9, "alone unique text"), (9, base + " x")]
    assert [(r["doc_id"], r["text"][-6:]) for r in sh.deduplicate(docs_of(spark, rows[1:3] + rows[4:])).collect()] == [(5, "99 end")]
    kept = sorted((r["doc_id"], r["text"]) for r in sh.deduplicate(docs_of(spark, rows)).collect())
    assert len(kept) == 2 and kept[0][0] == 5 and kept[1] == (9, "alone unique text")
    unnamed = docs_of(spark, [(None, base), (None, base + " end"), (None, "other words here"), (None, "other words here")])
    assert sh.deduplicate(unnamed).count() == 2


def test_stage_against_brute_force(spark):
    docs = documents(spark).unionByName(odd_documents(spark).withColumn("doc_id", sh.F.col("doc_id") + 1_000_000))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    component = {(i, p): c for i, p, c in brute(rows)}
    kept = [(r["doc_id"], r["text"]) for r in sh.deduplicate(docs).collect()]
    assert len(kept) == len(set(component.values()))  # one component has no id at all
    assert all(component[i, f"{plain_fingerprint(t):016x}"] == i for i, t in kept)
