import hashlib
import os
import subprocess
import sys
from collections import defaultdict

import pytest

from citylake.llm import exact_dedup as ed
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[(text or "").translate(LOWER)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return sorted(out, key=str)


def test_against_brute_force(spark):
    for docs in (documents(spark), odd_documents(spark)):
        rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
        for resolve in (ed.annotate, ed.annotate_table):
            found = resolve(docs, ed.DigestIndex.temporary(spark, docs))
            assert sorted(map(tuple, found.collect()), key=str) == brute(rows)


def test_empty(spark):
    docs = empty_documents(spark)
    index = ed.DigestIndex.temporary(spark, docs)
    assert ed.annotate(docs, index).count() == 0 and ed.annotate_table(docs, index).count() == 0
    assert index.read().count() == 0 and ed.deduplicate(docs, index).count() == 0


def test_table_of_ids_that_are_all_missing_or_equal(spark):
    for ids in ([None, None, None], [7, 7, 7], [-3, None, 4]):
        docs = docs_of(spark, [(i, "same") for i in ids])
        found = ed.annotate_table(docs, ed.DigestIndex.temporary(spark, docs))
        assert sorted(map(tuple, found.collect()), key=str) == brute([(i, "same") for i in ids])


OTHER_SESSION = """
import sys
from citylake.llm.exact_dedup import DigestIndex, deduplicate
from citylake.session import build_session
spark = build_session("other", "local[2]", **{"spark.ui.enabled": "false", "spark.checkpoint.dir": sys.argv[2]})
index = DigestIndex.open(spark, sys.argv[1])
batch = spark.createDataFrame([(9, "A"), (10, "c")], "doc_id bigint, text string")
before = index.read().count()
print("SAID", before, [r["doc_id"] for r in deduplicate(batch, index).collect()], index.buckets)
"""


def test_index_goes_on_in_another_session(spark, tmp_path):
    """An application of its own finds the rows, keeps them and adds to them; the first one then sees both batches."""
    path = f"{tmp_path}/index"
    index = ed.DigestIndex.open(spark, path, 4)
    assert ed.deduplicate(docs_of(spark, [(1, "a"), (2, "b")]), index).count() == 2
    said = subprocess.run(
        [sys.executable, "-c", OTHER_SESSION, path, f"{tmp_path}/shared"], capture_output=True, text=True, check=True, cwd=ROOT
    ).stdout
    assert "SAID 2 [10] 4" in said
    index.close()
    again = ed.DigestIndex.open(spark, path)
    assert again.buckets == 4 and sorted(r["keep_id"] for r in again.read().collect()) == [1, 2, 10]
    assert ed.deduplicate(docs_of(spark, [(20, "C"), (21, "B"), (22, "d")]), again).first()["doc_id"] == 22


def test_other_layouts_and_folders_are_refused(spark, tmp_path):
    ed.DigestIndex.open(spark, f"{tmp_path}/index", 4)
    with pytest.raises(ValueError, match="4 buckets"):
        ed.DigestIndex.open(spark, f"{tmp_path}/index", 8)
    docs_of(spark, [(1, "a")]).write.parquet(f"{tmp_path}/rows")
    with pytest.raises(ValueError, match="no digest index"):
        ed.DigestIndex.open(spark, f"{tmp_path}/rows")


def test_second_batch_of_a_table_is_decided_by_the_anti_join(spark):
    """Copies under smaller ids meet those of larger ids in the index only."""
    docs = docs_of(spark, [(i, f"text {i % 40}") for i in range(100)])
    index = ed.DigestIndex.temporary(spark, docs)
    found = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in ed.annotate_table(docs, index).collect()}
    assert index.read().count() == 40
    assert all(found[i] == (i % 40 + (80 if i % 40 < 20 else 40), 3 if i % 40 < 20 else 2, i >= 60) for i in range(100))


def test_buckets_follow_the_input(spark, monkeypatch):
    docs = documents(spark)
    assert ed.buckets_for(docs) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    monkeypatch.setattr(ed, "scanned_bytes", lambda df: 10**12)
    assert ed.buckets_for(docs) == -(-(10**12) // 2**28)


def test_second_batch_is_held_against_the_first(spark):
    index = ed.DigestIndex.temporary(spark, empty_documents(spark))
    first = docs_of(spark, [(1, "a"), (2, "A"), (3, "b")])
    assert {r["doc_id"] for r in ed.deduplicate(first, index).collect()} == {2, 3}
    second = docs_of(spark, [(10, "b"), (11, "c"), (12, "C")])
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in ed.annotate(second, index).collect()}
    assert found == {10: (3, False), 11: (12, False), 12: (12, True)}
    assert index.read().count() == 3
    index.add(ed.batch_groups(ed.digests(second)))
    assert index.read().count() == 3


def test_index_is_not_shuffled(spark):
    index = ed.DigestIndex.temporary(spark, empty_documents(spark))
    ed.annotate(docs_of(spark, [(1, "a")]), index)
    plan = index.unseen(ed.batch_groups(ed.digests(docs_of(spark, [(2, "b")]))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Bucketed: true" in text


def test_stage_keeps_columns_and_one_of_repeated_rows(spark):
    docs = clashing(odd_documents(spark), "digest", "keep_id", "fresh", "doc", "n")
    kept = ed.deduplicate(docs, ed.DigestIndex.temporary(spark, docs))
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(5) == 1 and 4 not in ids and 2 in ids and 1 not in ids and None in ids
