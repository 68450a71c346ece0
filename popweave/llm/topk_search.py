"""Exact top-k search by inner product (operator 13).

Method: pivot-distance index. Vectors of integers floor(``scale`` * x) get one more coordinate,
sqrt(M^2 - |x|^2) with M the greatest length, queries a zero there; then
|q - x|^2 = |q|^2 + M^2 - 2 <q, x>, so the greatest inner products are the nearest points and the
triangle inequality applies. Every vector is keyed by its nearest pivot and its distance to it;
the distances of a pivot's vectors are cut into annuli of about equal counts. For a query at
distance d to a pivot no vector of the annulus [lo, hi] is nearer than max(lo - d, d - hi), which
bounds its inner product from above. Each query sorts all annuli by that bound and expands
them in this order; it stops at the first annulus whose bound is below the smallest score it
holds. Bounds keep a margin for rounding, ties are visited (bound equal to the score), and the scores
themselves are exact integers, so the result is exact whatever the pivots are.

Spark does the search in rounds: ``first`` annuli, then ``growth`` times as many, until no query has
one left that it must see. In a round the (query, annulus) visits meet the annuli's vectors in
units of at most about ``chunk`` vectors and ``queries`` queries, so an annulus of any size is spread over tasks
and numpy multiplies matrices; a unit sends only its ``k + 1`` best per query. Every round's best are
written under the checkpoint folder. The directory of annuli has at most pivots x annuli rows.

Equal vectors are one class that keeps the ``k + 1`` smallest ids: the rows behind them can't be among
anybody's ``k`` best. So a vector held by a third of all rows is compared once, as vector and as query.

Pivots come from a bounded sample (``sample`` vectors by hash), each the farthest from those before.
Over vectors without clusters little can be ruled out in many dimensions and the search becomes a
blocked product of all queries and all rows.

Defined cases: vectors that are null or hold a null or non-finite component take no part; vectors of
different lengths are compared as if filled up with zeros; a null id is never a query and ranks
behind all ids at ties; rows that share an id are rows of their own (each excludes itself only);
fewer other rows than ``k`` give them all; an empty table gives no rows; other columns of the input
are ignored. Squared lengths beyond ``2**62`` stop the run (scores would not fit 64 bits).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from popweave.llm.centroid_clusters import integers, whole_rows
from popweave.llm.common import parts, prepare, read, starts, whole_groups
from popweave.session import drop_path, materialize

UNIT = ["cell", "ci", "qi"]
LIMIT = (1 << 31) - 1
EXACT = 1 << 53    # integers below it are exact in double precision
OPEN = -(1 << 63)  # stands for the threshold of a query that holds too few rows
BLOCK = 1024       # rows a task turns into one matrix


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, v, nn): the vectors that take part as integers, and their squared lengths."""
    def run(batches):
        for batch in batches:
            at, x, lengths = whole_rows(batch.column(1), None)
            v = integers(x, scale, LIMIT)
            ends = np.concatenate([[0], np.cumsum(lengths)])
            square = np.concatenate([[0.0], np.cumsum(v.astype(float) ** 2)])
            if len(at) and np.diff(square[ends]).max() >= 2.0 ** 62:
                raise ValueError("a squared length passes 2**62: scores would not fit 64 bits")
            whole = np.concatenate([[0], np.cumsum((v * v).view(np.uint64), dtype=np.uint64)])  # wraps, differences don't
            nn = (whole[ends[1:]] - whole[ends[:-1]]).astype(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(v.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), lists, pa.array(nn)], names=["vec_id", "v", "nn"])

    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
            .mapInArrow(run, "vec_id long, v array<int>, nn long"))


def matrix(lists, width: int | None = None) -> np.ndarray:
    """Rows of integers as doubles, shorter ones filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    width = int(lengths.max(initial=0)) if width is None else width
    out = np.zeros((len(lengths), width))
    out[np.arange(width)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def narrow(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without the components that only one of them has: they add nothing to products."""
    w = min(a.shape[1], b.shape[1])
    return a[:, :w], b[:, :w]


def products(a: np.ndarray, b: np.ndarray, longest: int) -> np.ndarray:
    """Exact integer inner products; every partial sum is at most the squared greatest length."""
    a, b = narrow(a, b)
    if longest < EXACT:
        return a @ b.T
    return a.astype(np.int64) @ b.astype(np.int64).T


def farthest(sample: np.ndarray, count: int) -> np.ndarray:
    """Up to ``count`` different rows of ``sample``, each the farthest from those before it."""
    if not len(sample):
        return sample
    at, gap = [0], ((sample - sample[0]) ** 2).sum(axis=1)
    while len(at) < count and gap.max() > 0:
        at.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[at[-1]]) ** 2).sum(axis=1))
    return sample[at]


class Pivots:
    """Pivot points with their extra coordinate; distances of vectors and of queries to them."""

    def __init__(self, points: np.ndarray, longest: int):
        self.points, self.longest = points, longest
        self.extra = np.sqrt(np.maximum(0.0, longest - (points * points).sum(axis=1)))

    def of_vectors(self, m: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(0.0, self.longest - (m * m).sum(axis=1)))
        a, b = narrow(m, self.points)
        return np.sqrt(np.maximum(0.0, 2 * (self.longest - a @ b.T - extra[:, None] * self.extra)))

    def of_queries(self, m: np.ndarray) -> np.ndarray:
        a, b = narrow(m, self.points)
        return np.sqrt(np.maximum(0.0, (m * m).sum(axis=1)[:, None] + self.longest - 2 * (a @ b.T)))


def _keyed(pivots: Pivots):
    """(cls, hid, v, pivot, dist): each vector's nearest pivot and the distance to it."""
    def run(batches):
        for batch in batches:
            near, dist = [np.zeros(0, np.int32)], [np.zeros(0)]
            for i in range(0, batch.num_rows, BLOCK):
                d = pivots.of_vectors(matrix(batch.column("v").slice(i, BLOCK)))
                near.append(d.argmin(axis=1).astype(np.int32))
                dist.append(d.min(axis=1))
            columns = [*batch.columns, pa.array(np.concatenate(near)), pa.array(np.concatenate(dist))]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "hid", "v", "pivot", "dist"])

    return run


def _bounds(pivots: Pivots, pivot: np.ndarray, lo: np.ndarray, hi: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Upper bounds of the inner products of queries ``m`` with the vectors of each annulus."""
    d = pivots.of_queries(m)[:, pivot]
    # distances near zero carry the rounding of squares of size M^2
    near = np.maximum(0.0, np.maximum(lo - d, d - hi) - 1e-6 * np.sqrt(pivots.longest))
    both = (m * m).sum(axis=1)[:, None] + pivots.longest
    return (both - near * near) / 2 + 1e-9 * both


def _visits(pivots: Pivots, directory: tuple, done: int, upto: int):
    """(q, v, t, cells): the annuli from number ``done`` to ``upto`` in a query's own order that it
    must see, ``t`` being the smallest score it holds (null: fewer than it needs)."""
    cell, pivot, lo, hi = directory

    def run(batches):
        for batch in batches:
            ends, out = [0], [np.zeros(0, np.int32)]
            t = batch.column("t").fill_null(OPEN).to_numpy(zero_copy_only=False)
            for i in range(0, batch.num_rows, BLOCK):
                bound = _bounds(pivots, pivot, lo, hi, matrix(batch.column("v").slice(i, BLOCK)))
                order = np.argsort(-bound, axis=1, kind="stable")[:, done:upto]
                must = np.take_along_axis(bound, order, axis=1) >= t[i:i + BLOCK, None]
                out.append(cell[order[must]])
                ends.extend((ends[-1] + np.cumsum(must.sum(axis=1))).tolist())
            cells = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(out)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("q", "v", "t")), cells], names=["q", "v", "t", "cells"])

    return run


def _best(k: int, longest: int, block: int = 256):
    """Per unit and query the ``k`` best classes by score, then smallest head id, then class."""
    def run(batches):
        for table in whole_groups(batches, UNIT):
            at = starts(table, UNIT).tolist()
            side = table.column("side").to_numpy()
            item = table.column("item").to_numpy()
            hid = table.column("hid").fill_null(np.iinfo(np.int64).max).to_numpy()
            t = table.column("t").fill_null(OPEN).to_numpy()
            found = []
            for i, j in zip(at, [*at[1:], table.num_rows]):
                own, ask = i + np.flatnonzero(side[i:j] == 0), i + np.flatnonzero(side[i:j] == 1)
                if not len(own) or not len(ask):
                    continue
                own = own[np.lexsort((item[own], hid[own]))]  # equal scores: by place
                c = matrix(table.column("v").take(pa.array(own)))
                for s in range(0, len(ask), block):
                    rows = ask[s:s + block]
                    score = products(matrix(table.column("v").take(pa.array(rows))), c, longest)
                    least = t[rows]
                    if len(own) > k:
                        free = least == OPEN
                        if free.any():
                            least[free] = np.partition(score[free], -k, axis=1)[:, -k]
                    r, p = np.nonzero(score >= least[:, None])
                    value = score[r, p].astype(np.int64)
                    order = np.lexsort((p, -value, r))
                    r, p, value = r[order], p[order], value[order]
                    place = np.arange(len(r)) - np.searchsorted(r, r)
                    top = place < k
                    found.append((item[rows[r[top]]], value[top], own[p[top]]))
            if found:
                q, value, row = (np.concatenate(x) for x in zip(*found))
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q), pa.array(value), table.column("hid").take(row).combine_chunks(),
                     table.column("item").take(row).combine_chunks()], names=["q", "score", "hid", "cls"])

    return run


def meet(index: DataFrame, counts: DataFrame, visits: DataFrame, k: int, longest: int, chunk: int, queries: int) -> DataFrame:
    """(q, score, hid, cls): the units' best for one round's visits."""
    asked = visits.select("q", "v", "t", F.explode("cells").alias("cell"))
    load = (asked.groupBy("cell").agg(F.count("*").alias("_asked")).join(F.broadcast(counts), "cell")
            .select("cell", F.ceil(F.col("_n") / F.lit(chunk)).cast("int").alias("_c"),
                    F.ceil(F.col("_asked") / F.lit(queries)).cast("int").alias("_q")))  # a row an annulus
    deal = lambda col, n: F.pmod(F.xxhash64(F.lit(3), F.col(col)), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    own = (index.join(F.broadcast(load), "cell").withColumn("ci", deal("cls", "_c")).withColumn("qi", every("_q"))
           .select(*UNIT, F.lit(0).alias("side"), F.col("cls").alias("item"), "hid", F.lit(None).cast("long").alias("t"), "v"))
    ask = (asked.join(F.broadcast(load), "cell").withColumn("qi", deal("q", "_q")).withColumn("ci", every("_c"))
           .select(*UNIT, F.lit(1).alias("side"), F.col("q").alias("item"), F.lit(None).cast("long").alias("hid"), "t", "v"))
    both = own.unionByName(ask).repartition(parts(index), *UNIT).sortWithinPartitions(*UNIT)
    return both.mapInArrow(_best(k, longest), "q long, score long, hid long, cls long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query; the limit is applied before the shuffle, too."""
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("hid"), "cls")
    return found.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k).drop("_r")


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """(cls, hid, v, nn, head): different vectors with their ``k`` smallest rows."""
    order = Window.partitionBy("v").orderBy(F.asc_nulls_last("vec_id"), "rid")
    least = rows.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= k)
    return (least.groupBy("v").agg(F.min("rid").alias("cls"), F.min("vec_id").alias("hid"), F.max("nn").alias("nn"),
                                   F.sort_array(F.collect_list(F.struct("_r", "vec_id", "rid"))).alias("head")))


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, pivots: int = 64, annuli: int = 8,
          sample: int = 4096, first: int = 8, growth: int = 16, chunk: int = 8192, queries: int = 2048,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best other rows for each row whose id (``vec_id``) meets ``is_query``."""
    spark = vectors.sparkSession
    rows = materialize(quantised(vectors, scale, id_col, vec_col).withColumn("rid", F.monotonically_increasing_id()), "rows")
    classes = materialize(classes_of(rows, k + 1), "classes")
    asking = materialize(rows.filter(is_query).select("rid", F.col("vec_id").alias("query_id"), "v")
                         .join(classes.select("v", F.col("cls").alias("q")), "v").select("rid", "query_id", "q"), "asking")
    longest = classes.agg(F.max("nn").alias("m")).first().m or 0
    drawn = classes.select("v").orderBy(F.xxhash64("v"), "v").limit(sample).toArrow()  # the sample bounds it
    pivot = Pivots(farthest(matrix(drawn.column("v")), pivots), longest)
    if not len(pivot.points):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")

    keyed = materialize(classes.select("cls", "hid", "v")
                        .mapInArrow(_keyed(pivot), "cls long, hid long, v array<int>, pivot int, dist double"), "keyed")
    cuts = keyed.groupBy("pivot").agg(F.percentile_approx("dist", [i / annuli for i in range(1, annuli)] or [1.0], 1000).alias("cuts"))
    # a row a pivot; an annulus holds the distances from one cut to below the next
    place = F.col("pivot") * annuli + (F.size(F.filter("cuts", lambda c: c <= F.col("dist"))) if annuli > 1 else F.lit(0))
    index = materialize(keyed.join(F.broadcast(cuts), "pivot").withColumn("cell", place.cast("int"))
                        .select("cell", "dist", "cls", "hid", "v"), "index")
    counts = materialize(index.groupBy("cell").agg(F.count("*").alias("_n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")), "annuli")
    annulus = counts.orderBy("cell").collect()  # at most pivots x annuli rows
    cell = np.array([r.cell for r in annulus], np.int32)
    directory = (cell, cell // annuli, np.array([r.lo for r in annulus]), np.array([r.hi for r in annulus]))

    ask = materialize(asking.select("q").distinct().join(classes.select(F.col("cls").alias("q"), "v"), "q"), "queries")
    best = materialize(spark.createDataFrame([], "q long, score long, hid long, cls long"), "best")
    done, step = 0, first
    while done < len(annulus):
        held = (best.groupBy("q").agg(F.count("*").alias("_n"), F.min("score").alias("_s"))
                .select("q", F.when(F.col("_n") > k, F.col("_s")).alias("t")))
        visits = materialize(ask.join(held, "q", "left").select("q", "v", "t")
                             .mapInArrow(_visits(pivot, directory, done, done + step), "q long, v array<int>, t long, cells array<int>")
                             .filter(F.size("cells") > 0), "visits")
        if visits.isEmpty():
            break
        found = meet(index, counts.select("cell", "_n"), visits, k + 1, longest, chunk, queries)
        after = materialize(best_of(best.unionByName(found), k + 1), "best")
        for old in (visits, best):
            for folder in {f.rsplit("/", 1)[0] for f in old.inputFiles()}:
                drop_path(spark, folder)
        best, done, step = after, done + step, step * growth

    key = F.struct((-F.col("score")).alias("_s"), F.col("m.vec_id").isNull().alias("_null"), F.col("m.vec_id").alias("vec_id"),
                   F.col("m.rid").alias("rid"))
    heads = (best.join(classes.select("cls", "head"), "cls").select("q", "score", F.explode("head").alias("m"))
             .groupBy("q").agg(F.sort_array(F.collect_list(key)).alias("_top")))  # at most (k + 1)^2 a query
    others = F.slice(F.filter("_top", lambda x: x["rid"] != F.col("rid")), 1, k)
    return (asking.join(heads, "q").select("query_id", F.posexplode(others).alias("_p", "_m"))
            .select("query_id", (F.col("_p") + 1).alias("rank"), "_m.vec_id", (-F.col("_m._s")).alias("score")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


SQL = """
WITH q AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.r, a.vec_id AS query_id, b.r AS o, b.vec_id,
             CAST(coalesce(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
      FROM q a JOIN q b ON a.r <> b.r WHERE a.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, o) AS rank FROM s)
WHERE rank <= 5"""
