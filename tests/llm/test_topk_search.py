"""Exact top-k search against brute force, in one and in several rounds and units."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from popweave.llm import topk_search as ts


def simple(rows, k=5, scale=256, every=50):
    held = [(r, i, [math.floor(scale * float(x)) for x in v]) for r, (i, v) in enumerate(rows)
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for r, i, v in held:
        if i is None or i % every:
            continue
        best = sorted((-sum(a * b for a, b in zip(v, w)), j is None, j or 0) for s, j, w in held if s != r)[:k]
        out += [(i, n + 1, None if null else j, -s) for n, (s, null, j) in enumerate(best)]
    return sorted(out, key=str)


def run(df, **kw):
    return sorted(map(tuple, ts.top_k(df, F.col("vec_id") % 50 == 0, **kw).collect()), key=str)


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = ts.query(spark, sf)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == simple(rows)


def awkward():
    rng = np.random.default_rng(9)
    base = rng.standard_normal((9, 12)) * 2
    rows = [(i, (base[i % 9] + 0.05 * rng.standard_normal(12)).tolist()) for i in range(500)]
    rows += [(i, rows[100][1]) for i in range(500, 760)]                  # a hot vector, also as query
    rows += [(50, rows[7][1]), (50, rows[7][1]), (None, rows[50][1]), (None, [9.0] * 12),   # repeated and null ids
             (800, None), (850, [float("nan")] * 12), (900, [None] + [1.0] * 11), (901, [float("inf")] * 12),
             (950, []), (1000, [0.0] * 12), (1050, [1.0, 2.0]), (1100, [3.0] * 15), (1101, [1e3, -1e3])]
    return rows


@pytest.mark.parametrize("how", [{}, dict(pivots=5, annuli=3, first=1, growth=2, chunk=40, queries=3, sample=64),
                                 dict(pivots=1, annuli=1, chunk=7), dict(k=1000)])
def test_awkward_vectors(spark, how):
    rows = awkward()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "'x' AS q").repartition(4)
    assert run(df, **how) == simple(rows, how.get("k", 5))


def test_large_integers_stay_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.integers(-2**19, 2**19, 40) + 1 / 256).tolist()) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert run(df, pivots=4) == simple(rows)
    with pytest.raises(Exception, match="would not fit 64 bits"):
        run(spark.createDataFrame([(0, [8e6] * 2000)], "vec_id long, embedding array<double>"))


def test_few_rows_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (50, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert run(df) == [(0, 1, 50, 4 * 65536), (50, 1, 0, 4 * 65536)]
    assert run(df.limit(1)) == [] and run(df.limit(0)) == [] and run(df.filter("vec_id = 7")) == []


def test_clusters_let_the_search_stop_early(spark):
    """With clustered vectors most annuli are ruled out by the triangle inequality."""
    rng = np.random.default_rng(4)
    base = rng.standard_normal((20, 16))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    m = np.floor(256 * (base[np.arange(2000) % 20] + 0.01 * rng.standard_normal((2000, 16))))
    longest = int((m * m).sum(axis=1).max())
    pivots = ts.Pivots(ts.farthest(m[:400], 20), longest)
    d = pivots.of_vectors(m)
    near, dist = d.argmin(axis=1), d.min(axis=1)
    p = np.arange(20)
    lo, hi = (np.array([f(dist[near == i]) for i in p]) for f in (np.min, np.max))
    bound = ts._bounds(pivots, p, lo, hi, m[:50])
    score = m[:50] @ m.T
    assert (bound[:, near] >= score).all()                       # never below a true score
    fifth = np.sort(score, axis=1)[:, -6]
    assert (bound >= fifth[:, None]).mean() < 0.25
