"""Centroid clustering against plain integers, and odd vectors."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from citylake.llm import centroids

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, k=8, rounds=10, dims=64, scale=1024, seed=3):
    good = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    now = [v for _, v in sorted(good, key=key)[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((far(v, c), at) for at, c in enumerate(now))
    for _ in range(rounds):
        own = [[v for _, v in good if near(v)[1] == at] for at in range(len(now))]
        now = [[sum(x) // len(vs) for x in zip(*vs)] if vs else c for vs, c in zip(own, now)]
    placed = [(i, *near(v)[::-1]) for i, v in good]
    held = lambda x: min(x, 2**63 - 1)
    inertia = {c: sum(held(d) for _, at, d in placed if at == c) for _, c, _ in placed}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    return sorted([(i, c, held(d), held(inertia[c]), held(sum(inertia.values())), digest[c]) for i, c, d in placed], key=str)


def found(spark, rows, **options):
    return sorted([tuple(r) for r in centroids.cluster(spark.createDataFrame(rows, SCHEMA), **options).collect()], key=str)


def vectors(n, dims=64, seed=1):
    r = random.Random(seed)
    return [(i, [r.gauss((i % 5) / 3, 0.4) for _ in range(dims)]) for i in range(n)]


def test_equals_plain_integers(spark):
    rows = vectors(300)
    assert found(spark, rows) == brute(rows)


@pytest.mark.parametrize("k,rounds", [(3, 4), (1, 1), (5, 0)])
def test_other_parameters(spark, k, rounds):
    rows = vectors(80, 3)
    options = {"k": k, "rounds": rounds, "dims": 3, "scale": 10, "seed": 8}
    assert found(spark, rows, **options) == brute(rows, **options)


def test_odd_vectors(spark):
    rows = vectors(30, 2) + [
        (40, None), (41, [1.0, None]), (42, [math.nan, 1.0]), (43, [1.0, -math.inf]), (44, []), (45, [1.0]), (46, [1.0, 2.0, 3.0]),
        (None, [0.5, 0.25]), (None, [0.5, 0.25]), (7, [9.0, 9.0]), (7, [9.0, 9.0]), (47, [-0.0001, 0.0001]),
    ]
    assert found(spark, rows, dims=2) == brute(rows, dims=2)


def test_ties_go_to_the_smaller_number_and_equal_centroids_stay_empty(spark):
    rows = [(i, [float(i % 2)]) for i in range(12)]
    assert found(spark, rows, dims=1, k=4) == brute(rows, dims=1, k=4)


def test_very_large_components_are_exact(spark):
    rows = [(i, [1e30 * (i % 3), -3e38, float(i)]) for i in range(20)]
    assert found(spark, rows, dims=3, k=3) == brute(rows, dims=3, k=3)


def test_few_vectors_and_none(spark):
    assert found(spark, []) == [] and found(spark, [(1, None), (2, [1.0])]) == []
    rows = vectors(3)
    assert found(spark, rows) == brute(rows)


def test_further_columns_do_not_clash(spark):
    rows = vectors(40, 4)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("mine") for c in ("v", "norm", "cluster", "distance", "inertia", "d")})
    assert sorted([tuple(r) for r in centroids.cluster(df, dims=4).collect()], key=str) == brute(rows, dims=4)


def test_tables_give_the_distances():
    r = np.random.default_rng(3)
    x, c = r.integers(-50, 50, (200, 6)), r.integers(-50, 50, (4, 6))
    want = ((x[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (centroids.distances(x, c) == want).all()
    assert (centroids.distances(x.astype(object), c.astype(object)) == want).all()
