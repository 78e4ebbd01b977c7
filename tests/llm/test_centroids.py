"""Centroid clustering against plain k-means in Python integers, and on odd rows."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from meterlake.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int"


def usable(v):
    return v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if usable(v)]
    named = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        own = [[] for _ in centres]
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(o) for x in zip(*o)] if o else c for o, c in zip(own, centres)]
    last = [(i, *nearest(v)) for i, v in kept]
    total = [sum(d for _, d, j in last if j == c) for c in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, j, d, total[j], sum(total), names[j]) for i, d, j in last), key=str)


def got(df):
    return sorted((tuple(r) for r in centroids.clustered(df).collect()), key=str)


def vectors(seed, n, kinds=5, spread=0.3):
    rng = random.Random(seed)
    middles = [[rng.uniform(-1, 1) for _ in range(64)] for _ in range(kinds)]
    return [(i, [float(np.float32(x + rng.gauss(0, spread))) for x in rng.choice(middles)], 0) for i in range(n)]


@pytest.mark.parametrize("seed, n", [(1, 300), (2, 40)])
def test_equals_plain_k_means(spark, seed, n):
    rows = vectors(seed, n)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df) == plain([r[:2] for r in rows])


def test_given_vectors(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert got(df) == plain([(r.vec_id, r.embedding) for r in df.collect()])


def test_odd_rows(spark):
    rows = vectors(3, 30, kinds=2)
    rows += [rows[0], rows[0], (None, rows[1][1], 0), (None, rows[2][1], None), (100, None, 0), (101, [], 0), (102, [1.0] * 63, 0),
             (103, [1.0] * 63 + [None], 0), (104, [1.0] * 63 + [float("nan")], 0), (105, [1.0] * 63 + [float("inf")], 0),
             (106, [0.0] * 64, 0), (107, [0.0] * 64, 0), (108, [-0.0005] * 64, 0), (109, [90.0] * 64, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "cluster", "distance", "components", "block", "near", "of", "inertia"):
        df = df.withColumn(name, F.lit("clash"))
    assert got(df) == plain([r[:2] for r in rows])


def test_few_and_no_vectors(spark):
    assert got(spark.createDataFrame([], SCHEMA)) == []
    rows = vectors(4, 3)
    assert got(spark.createDataFrame(rows, SCHEMA)) == plain([r[:2] for r in rows])
    one = rows[:1]
    assert got(spark.createDataFrame(one, SCHEMA)) == plain([r[:2] for r in one])
    assert got(spark.createDataFrame([(None, one[0][1], 0)], SCHEMA)) == []
    with pytest.raises(ValueError):
        got(spark.createDataFrame([(1, [1e30] * 64, 0)], SCHEMA))


def test_search_is_exact_and_saves_distances():
    """Bounds and shrinking balls against all distances, over moving centroids, with
    many ties; most distances are never taken."""
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, size=(400, 4))
    x[:200] += 50 * rng.integers(0, 8, size=(200, 1))
    values, before, state, taken = x[rng.choice(400, 20, replace=False)].copy(), None, None, 0
    for _ in range(12):
        centres = centroids.Centres.of(values, before)
        near, second, upper, lower, more = centroids.assign(x, centres, state)
        state, taken = (near, second, upper, lower), taken + more
        every = np.array([centroids.squared(x, c) for c in values]).T
        assert (near == every.argmin(axis=1)).all()
        chosen = every[np.arange(400), near]
        every[np.arange(400), near] = np.iinfo(np.int64).max
        assert (upper >= np.sqrt(chosen) * (1 - 1e-9)).all() and (lower <= np.sqrt(every.min(axis=1)) * (1 + 1e-9)).all()
        before = values
        sums = {}
        for j in range(20):
            own = x[near == j]
            sums.update({j * 5 + i: int(v) for i, v in enumerate([*own.sum(axis=0), len(own)])})
        values = centroids.moved_centroids(values, sums)
    assert taken < 0.5 * 12 * 400 * 20


def test_rounds_move_no_vector(spark):
    """The blocks and their states are bucketed alike: their join needs no exchange."""
    rows = spark.createDataFrame(vectors(6, 50), SCHEMA)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found, _ = centroids.cluster(rows)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
