"""Centroid clustering by lookup tables against exact integers in Python."""

import hashlib
import math

import numpy as np
import pytest

from popweave.llm import centroid_clusters as cc


def simple(rows, k=16, rounds=3, scale=64, dim=64):
    kept = [(i, [math.floor(scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    centroids = [v for _, v in start[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, v in kept:
            held.setdefault(near(v)[1], []).append(v)
        centroids = [[sum(x) // len(held[j]) for x in zip(*held[j])] if j in held else c for j, c in enumerate(centroids)]
    out = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = {j: sum(d for _, c, d in out if c == j) for j in range(k)}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), names[c]) for i, c, d in out), key=str)


def test_query_equals_brute_force(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = cc.query(spark, sf)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == simple(rows)


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 64))
    rows = [(i, (base[i % 6] + 0.1 * rng.standard_normal(64)).tolist()) for i in range(60)]
    rows += [(i, rows[0][1]) for i in range(60, 90)]                      # equal vectors
    rows += [(5, rows[1][1]), (5, rows[1][1]), (None, rows[2][1]), (None, rows[3][1]),   # repeated and null ids
             (91, None), (92, []), (93, [1.0] * 63), (94, [1.0] * 65), (95, [None] + [1.0] * 63), (96, [float("nan")] + [1.0] * 63),
             (97, [float("-inf")] + [1.0] * 63), (98, [0.0] * 64), (99, [-0.0] * 64), (100, [2e6 * (-1) ** j for j in range(64)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS cluster", "'x' AS distance").repartition(5)
    got = cc.report(*cc.cluster(df)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == simple(rows)
    few = [r for r in rows if r[0] is not None and r[0] < 5]              # fewer vectors than centroids
    got = cc.report(*cc.cluster(spark.createDataFrame(few, "vec_id long, embedding array<double>")))
    assert sorted(map(tuple, got.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=str) == simple(few)
    for none in (df.limit(0), df.filter("vec_id BETWEEN 91 AND 97")):
        assert cc.report(*cc.cluster(none)).count() == 0
    with pytest.raises(Exception, match="would not fit 64 bits"):
        cc.cluster(spark.createDataFrame([(1, [1e12] * 64)], "vec_id long, embedding array<double>"))


@pytest.mark.parametrize("spread", [3, 1 << 20])
def test_tables_equal_differences(spread):
    rng = np.random.default_rng(spread)
    m, c = rng.integers(-spread, spread, (500, 8)), rng.integers(-spread, spread, (7, 8))
    assert (cc.distances(m, c) == ((m[:, None] - c[None]) ** 2).sum(axis=2)).all()
