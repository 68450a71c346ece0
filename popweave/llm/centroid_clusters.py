"""Centroid clustering (operator 12).

Method: scalar lookup tables. Components are small integers, so each round tabulates, for every
dimension, every integer value that occurs there and every centroid, the squared difference;
a vector's distances to all centroids are then table gathers, one row a dimension, and their
sums. No vector is subtracted from a centroid.

Spark reads the vectors once, writes them as integers under the checkpoint folder and runs one
job a round over that table: each task tabulates the values of its Arrow batch (memory follows
the batch, however wide the values spread), assigns its rows and sends one row a centroid, the
count and the exact component sums of its members. The driver holds the centroids only, ``k``
times ``dim`` integers, both parameters. A lost executor costs its tasks of one round; a hot
vector that holds a third of all rows adds rows to tasks, never to a group.

Defined cases: vectors that are null, of another length, or hold a null or non-finite component
aren't kept; a null id is hashed as the empty string; repeated rows are vectors of their own; ties
in the start order fall to the smaller components, ties in distance to the smaller centroid;
fewer vectors than ``k`` give fewer centroids; no kept vector gives no rows; other columns of the
input are ignored. Integers beyond ``2**27`` stop the run (64 squared differences would not
fit 64 bits): nothing is dropped or rounded.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.common import prepare, read
from popweave.session import materialize

LIMIT = 1 << 27    # largest integer a component may become
DENSE = 1 << 16    # widest range of a batch's values that is marked, not sorted


def whole_rows(column: pa.ListArray, dim: int | None):
    """(row numbers, flat values, lengths) of the lists without null or non-finite components;
    ``dim``: and of that length only."""
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()  # a null list has no values
    x = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    held = np.maximum(lengths, 0)
    row = np.repeat(np.arange(len(lengths)), held)
    bad = np.zeros(len(lengths), bool)
    bad[row[~np.isfinite(x)]] = True
    good = ~bad & (lengths >= 0 if dim is None else lengths == dim)
    return np.flatnonzero(good), x[good[row]], lengths[good]


def integers(x: np.ndarray, scale: int, limit: int) -> np.ndarray:
    y = np.floor(scale * x)
    if len(y) and np.abs(y).max() > limit:
        raise ValueError(f"a component of {scale} x its value passes {limit}: the sums would not fit 64 bits")
    return y.astype(np.int64)


def quantised(vectors: DataFrame, dim: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the kept vectors as integers floor(``scale`` * x)."""
    def run(batches):
        for batch in batches:
            at, x, _ = whole_rows(batch.column(1), dim)
            v = integers(x, scale, LIMIT).astype(np.int32)
            ends = pa.array(np.arange(len(at) + 1) * dim, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.ListArray.from_arrays(ends, pa.array(v))],
                                             names=["id", "v"])

    kind = vectors.schema[id_col].dataType.simpleString()
    return (vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .mapInArrow(run, f"id {kind}, v array<int>"))


def codes(column: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The integer values that occur in a dimension, ascending, and each row's place among them."""
    low, high = int(column.min()), int(column.max())
    if high - low >= DENSE:
        return np.unique(column, return_inverse=True)
    seen = np.zeros(high - low + 1, bool)
    seen[column - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[column - low]


def distances(m: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of ``m`` to the centroids by lookup tables."""
    out = np.zeros((len(m), len(centroids)), np.int64)
    for d in range(m.shape[1]):
        values, code = codes(m[:, d])
        table = (values[:, None] - centroids[None, :, d]) ** 2
        out += table[code]
    return out


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(batch.num_rows, dim)


def _sums(centroids: np.ndarray):
    """Per task: (cluster, count, component sums) of its members."""
    k, dim = centroids.shape

    def run(batches):
        count, total = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for batch in batches:
            if batch.num_rows:
                m = _matrix(batch, dim)
                near = distances(m, centroids).argmin(axis=1)  # the first of equal ones
                count += np.bincount(near, minlength=k)
                np.add.at(total, near, m)
        at = np.flatnonzero(count)
        ends = pa.array(np.arange(len(at) + 1) * dim, pa.int32())
        sums = pa.ListArray.from_arrays(ends, pa.array(total[at].ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(count[at]), sums], names=["cluster", "n", "s"])

    return run


def _assign(centroids: np.ndarray):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                d = distances(_matrix(batch, centroids.shape[1]), centroids)
                near = d.argmin(axis=1)
                best = d[np.arange(len(d)), near]
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(near.astype(np.int32)), pa.array(best)],
                                                 names=["id", "cluster", "distance"])

    return run


def first_centroids(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors with the smallest SHA-256 of ``seed:id`` (k rows reach the driver)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    rows = table.select(key.alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return np.array([r.v for r in rows], np.int64)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: floor of the exact mean of their vectors; empty ones stay."""
    part = table.mapInArrow(_sums(centroids), "cluster int, n long, s array<long>")
    # k x dim rows: totals of the tasks' totals, wide enough for any row count
    rows = (part.select("cluster", "n", F.posexplode("s").alias("d", "x")).groupBy("cluster", "d")
            .agg(F.sum("n").alias("n"), F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect())
    out = centroids.copy()
    for r in rows:
        out[r.cluster, r.d] = int(r.x) // int(r.n)
    return out


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, scale: int = 64, dim: int = 64, seed: int = 1,
            id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """(id, ``cluster``, ``distance``) of every kept vector, and the final centroids."""
    table = materialize(quantised(vectors, dim, scale, id_col, vec_col), "integers")
    centroids = first_centroids(table, k, seed)
    if not len(centroids):
        kind = table.schema["id"].dataType.simpleString()
        return table.sparkSession.createDataFrame([], f"{id_col} {kind}, cluster int, distance long"), centroids.reshape(0, dim)
    for _ in range(rounds):
        centroids = moved(table, centroids)
    kind = table.schema["id"].dataType.simpleString()
    out = table.mapInArrow(_assign(centroids), f"id {kind}, cluster int, distance long")
    return out.withColumnRenamed("id", id_col), centroids


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with its cluster's and the whole inertia and its centroid's digest."""
    spark = assigned.sparkSession
    assigned = materialize(assigned, "assigned")
    names = spark.createDataFrame([(i, digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # one row a centroid: small by construction
    own = assigned.groupBy("cluster").agg(F.sum("distance").cast("long").alias("cluster_inertia"))
    whole = own.agg(F.sum("cluster_inertia").cast("long").alias("inertia")).select("inertia").scalar()
    return (assigned.join(F.broadcast(own.join(F.broadcast(names), "cluster")), "cluster")
            .withColumn("inertia", whole))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return report(*cluster(read(spark, sf_dir, "embeddings"))).select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _round_sql(i: int) -> str:
    """Round ``i``: assignment to the centroids ``c{i}``, then the centroids ``c{i+1}``."""
    return f"""
a{i} AS MATERIALIZED (SELECT q.r, arg_min(c.c, (list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c)) AS c
        FROM q CROSS JOIN c{i} c GROUP BY q.r),
m{i} AS (SELECT a.c, u.d, SUM(q.v[u.d]) AS s, COUNT(*) AS n
         FROM a{i} a JOIN q ON a.r = q.r CROSS JOIN (SELECT unnest(range(1, 65)) AS d) u GROUP BY a.c, u.d),
c{i + 1} AS MATERIALIZED (SELECT c.c, coalesce(g.v, c.v) AS v FROM c{i} c LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY d) AS v FROM m{i} GROUP BY c) g ON c.c = g.c)"""


SQL = """
WITH q AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v
    FROM (SELECT sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h, v FROM q ORDER BY h, v LIMIT 16)),""" \
    + ",".join(_round_sql(i) for i in range(3)) + """,
z AS (SELECT q.r, q.vec_id, min((list_sum(list_transform(list_zip(q.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))), c.c)) AS b
      FROM q CROSS JOIN c3 c GROUP BY q.r, q.vec_id),
o AS (SELECT vec_id, CAST(b[2] AS INTEGER) AS cluster, CAST(b[1] AS BIGINT) AS distance FROM z)
SELECT vec_id, cluster, distance, CAST(SUM(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
       CAST(SUM(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM o JOIN c3 ON o.cluster = c3.c"""
