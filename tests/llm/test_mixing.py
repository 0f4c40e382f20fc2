import hashlib
import math
from collections import Counter

import pytest

from citylake.llm import mixing as mx
from tests.llm.fixtures import clashing, docs_of, documents, empty_documents, odd_documents


def count_of(doc_id, rate):
    parts = max(1, math.ceil(rate / 16))
    total, mean = 0, rate / parts
    for part in range(1, parts + 1):
        name = f"mix-1:{'' if doc_id is None else doc_id}:{part}"
        u = int(hashlib.md5(name.encode()).hexdigest()[:13], 16) / 16**13
        p = cdf = math.exp(-mean)
        k = 0
        while cdf <= u and k <= 80:
            k += 1
            p *= mean / k
            cdf += p
            total += 1
    return total


def test_against_brute_force(spark):
    for docs in (documents(spark), odd_documents(spark)):
        rows = docs.collect()
        size = Counter()
        for r in rows:
            size[r["source"]] += len(r["text"] or "")
        weight = {s: math.sqrt(n) for s, n in size.items()}
        rate = {s: weight[s] / sum(weight.values()) * sum(size.values()) / n for s, n in size.items()}
        want = Counter()
        for r in rows:
            n = count_of(r["doc_id"], rate[r["source"]])
            want.update((r["doc_id"], k, n) for k in range(1, n + 1))
        got = Counter((r["doc"]["doc_id"], r["copy"], r["n_copies"]) for r in mx.mix(docs).collect())
        assert got == want


def test_shares_come_near_their_targets(spark):
    docs = documents(spark, "/root/testdata/sf0.1")
    weights = spark.createDataFrame([("src1", 3.0), ("src2", 1.0), ("src3", 60.0)], "source string, weight double")
    mixed = mx.mix(docs, weights, measure="documents").groupBy("doc.source").count().collect()
    share = {r["source"]: r["count"] / docs.count() for r in mixed}
    assert set(share) == {"src1", "src2", "src3"}
    for source, want in (("src1", 3 / 64), ("src2", 1 / 64), ("src3", 60 / 64)):
        assert share[source] == pytest.approx(want, rel=0.12)


def test_rates(spark):
    sized = spark.createDataFrame([("a", 100), ("b", 300), (None, 0), ("c", 50)], "source string, size bigint")
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), (None, 2.0)], "source string, weight double")
    rates = {r["source"]: r["rate"] for r in mx.rates(sized, weights).collect()}
    assert rates == {"a": 450 / 4 / 100, "b": pytest.approx(450 / 4 / 300), None: 1.0, "c": 0.0}


def test_order_is_global_and_seeded(spark):
    docs = clashing(documents(spark), "copy", "shuffle_key", "rate", "cdf")
    keys = [r["shuffle_key"] for r in mx.mix(docs).collect()]
    assert keys == sorted(keys)
    again = mx.mix(docs.repartition(7))
    assert sorted(keys) == sorted(r["shuffle_key"] for r in again.collect())
    assert again.select("doc.*").columns == docs.columns
    assert sorted(keys) != sorted(r["shuffle_key"] for r in mx.mix(docs, seed="other").collect())


def test_empty_and_native(spark):
    assert mx.mix(empty_documents(spark)).count() == 0
    plan = mx.mix(docs_of(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
