"""Embedding near-dedup (operator 10).

Method: Euclidean p-stable hashing. Vectors are scaled to length 1; each of ``tables`` hash
tables quantises ``projections`` Gaussian projections, floor((a.v + b) / width), and the
quantised values make the bucket. Members of a bucket get an exact cosine check in double
precision. Cosine ``c`` is Euclidean distance sqrt(2 - 2c), so at 0.98 the distance is 0.2;
with width 2.0 one projection collides with probability 0.920, twelve with 0.368, and one of
20 tables with 0.9999; nearer pairs collide more often.

Only equal non-null labels are compared. Equal vectors are collapsed to one class first, so a
vector held by a third of all rows is hashed once. A pair counts in the first table in which
it shares a bucket, so links are counted without a table of pairs; large buckets are cut into
units (``buckets``).

Defined cases: null, empty or all-zero vectors, and those with null or non-finite components,
link with nothing, like rows with a null label; vectors of other lengths aren't compared;
repeated rows (equal id) count as vectors of their own; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.llm.buckets import UNIT, deal, forest
from popweave.llm.common import prepare, read, starts, whole_groups
from popweave.llm.components import components
from popweave.session import materialize


def bucket_keys(classes: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(cls, dim, v, label, w, sig): ``raw`` at length 1 and the bucket hash of each table."""
    def run(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            dims = batch.column(1).to_numpy()
            ends = np.cumsum(dims)
            sig, unit = np.zeros((batch.num_rows, tables), np.int64), np.empty(len(flat))
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                place = (ends[at] - d)[:, None] + np.arange(d)
                m = flat[place]
                # by the largest component first: the squares neither overflow nor vanish
                m = m / np.abs(m).max(axis=1, keepdims=True)
                m /= np.sqrt((m * m).sum(axis=1, keepdims=True))
                unit[place] = m
                rng = np.random.default_rng([seed, int(d)])
                a, b = rng.standard_normal((int(d), tables * projections)), rng.uniform(0, width, tables * projections)
                q = np.floor((m @ a + b) / width).astype(np.int64).reshape(len(at), tables, projections)
                mix = rng.integers(-(1 << 62), 1 << 62, (tables, projections)) * 2 + 1
                sig[at] = (q * mix).sum(axis=2)
            sigs = pa.ListArray.from_arrays(pa.array(np.arange(len(sig) + 1) * tables, pa.int32()), pa.array(sig.ravel()))
            v = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(unit))
            columns = [batch.column("cls"), batch.column("dim"), v, batch.column("label"), batch.column("w"), sigs]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "dim", "v", "label", "w", "sig"])

    label = classes.schema["label"].dataType.simpleString()
    return (classes.select("cls", "dim", "raw", "label", "w")
            .mapInArrow(run, f"cls long, dim int, v array<double>, label {label}, w long, sig array<long>"))


def _compare(cosine: float):
    """Per unit: the links of each member not met in an earlier table, and a spanning forest.
    Rows: (a, b, n): ``b`` null and ``n`` the link count of ``a``, or a link between a and b."""
    def run(batches):
        for table in whole_groups(batches, UNIT):
            at = starts(table, UNIT).tolist()
            cls, dim, own, t, w = (table.column(c).to_numpy() for c in ("cls", "dim", "own", "t", "w"))
            ui, uj = table.column("ui").to_numpy(), table.column("uj").to_numpy()
            sig = np.asarray(table.column("sig").combine_chunks().flatten()).reshape(table.num_rows, -1)
            vec, ends = table.column("v").combine_chunks().flatten().to_numpy(), np.cumsum(dim)
            a, b, n = [], [], []
            for i, j in zip(at, [*at[1:], table.num_rows]):
                m = vec[ends[i] - dim[i]:ends[j - 1]].reshape(j - i, dim[i])
                near = m @ m.T >= cosine
                if ui[i] != uj[i]:
                    near &= own[i:j, None] != own[None, i:j]
                np.fill_diagonal(near, False)
                for k in range(int(t[i])):  # met in an earlier table: counted there
                    near &= sig[i:j, k, None] != sig[None, i:j, k]
                count = near @ w[i:j]
                for r in np.flatnonzero(count).tolist():
                    a.append(int(cls[i + r]))
                    b.append(None)
                    n.append(int(count[r]))
                for p, q in forest(near):
                    a.append(int(cls[i + p]))
                    b.append(int(cls[i + q]))
                    n.append(0)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()),
                                                  pa.array(n, pa.int64())], names=["a", "b", "n"])

    return run


def near_duplicates(vectors: DataFrame, cosine: float = 0.98, tables: int = 20, projections: int = 12,
                    width: float = 2.0, seed: int = 11, chunk: int = 1024, id_col: str = "vec_id",
                    vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per vector: id, ``n_links``, ``component_id``, ``kept``."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("raw"),
                          F.col(label_col).alias("label"))
    finite = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("raw") > 0)
                        & finite & F.exists("raw", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    # classes of equal vectors under equal labels
    classes = materialize(
        rows.filter("usable").groupBy("label", "raw").agg(F.min("id").alias("rep"), F.count("*").alias("w"))
        .withColumn("cls", F.monotonically_increasing_id()).withColumn("dim", F.size("raw")), "classes")
    hashed = materialize(bucket_keys(classes, tables, projections, width, seed), "hashed")
    keyed = (hashed.select("cls", "w", "dim", "label", F.posexplode("sig").alias("t", "h"))
             .select("cls", "w", "t", F.xxhash64("label", "dim", "t", "h").alias("key")))
    crowd = keyed.groupBy("key").agg(F.count("*").alias("_n")).filter("_n > 1")
    # vectors travel only to buckets with company
    met = keyed.join(crowd, "key").join(hashed.select("cls", "dim", "v", "sig"), "cls")
    found = materialize(deal(met, "cls", chunk).mapInArrow(_compare(cosine), "a long, b long, n long"), "found")
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("m"))
    joined = (classes.select("cls", "rep", "w", "label", "raw").join(counts, "cls", "left")
              .join(components(found.filter("b IS NOT NULL")), F.col("cls") == F.col("node"), "left")
              .withColumn("component", F.coalesce("component", "cls")))
    least = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    label = (joined.join(least, "component")
             .select("label", "raw", (F.coalesce("m", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id"))
    out = rows.join(label, ["label", "raw"], "left")
    linked = lambda c, other: F.coalesce(F.when(F.col("usable"), F.col(c)), other)
    return (out.select(F.col("id").alias(id_col), linked("n_links", F.lit(0)).cast("long").alias("n_links"),
                       linked("component_id", F.col("id")).alias("component_id"))
            .withColumn("kept", F.col(id_col) == F.col("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_duplicates(read(spark, sf_dir, "embeddings"))


#: Cosine self-join and reachability; for small tables.
SQL = """
WITH RECURSIVE v AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
n AS (SELECT *, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS size FROM v
      WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(e, lambda x: x IS NOT NULL AND isfinite(x))) = len(e)),
u AS MATERIALIZED (SELECT r, vec_id, label, e, size FROM n WHERE size > 0),
l AS MATERIALIZED (SELECT a.r AS a, b.r AS b FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
      WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.98),
c(r, m) AS (SELECT r, r FROM u UNION SELECT l.b, c.m FROM c JOIN l ON l.a = c.r),
g AS (SELECT c.r, min(u.vec_id) AS component_id FROM c JOIN u ON c.m = u.r GROUP BY c.r),
d AS (SELECT a AS r, COUNT(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, CAST(coalesce(d.n_links, 0) AS BIGINT) AS n_links, coalesce(g.component_id, v.vec_id) AS component_id,
       v.vec_id = coalesce(g.component_id, v.vec_id) AS kept
FROM v LEFT JOIN d ON v.r = d.r LEFT JOIN g ON v.r = g.r"""
