"""Helpers shared by the training-data operators.

Intermediate tables go to the shared folder of ``spark.checkpoint.dir`` (through
``popweave.session.materialize``); code that runs in Python workers is imported there from
this package, so ``prepare`` puts the repository on the workers' path.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from popweave.session import ensure_checkpoint_dir, materialize

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Arrow batches to and from Python workers: a batch stands in the executor and in the worker
#: at the same time, so a task's memory is a few times this, whatever its rows hold.
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Checkpoint folder, size of Arrow batches and the workers' import path (a cluster ships
    the package itself)."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, env.get("PYTHONPATH", "")) if x)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def parts(df: DataFrame) -> int:
    """Shuffle partitions of the session, for explicit repartitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: int, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``size`` bytes of text each, so that a Python
    worker's memory follows one run (or one very long text), not the batch."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(lengths):
        held += int(n)
        if held >= size:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """From batches sorted by ``keys``, tables that end where a group of equal keys ends."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if held is None else pa.concat_tables([held, table])
        cut = _last_group(table, keys)
        if cut:
            yield table.slice(0, cut).combine_chunks()
        held = table.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks()


def starts(table: pa.Table, keys: list[str]):
    """Row numbers at which a new group of equal keys begins."""
    import numpy as np

    n = table.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for k in keys:
        v = table.column(k).to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.flatnonzero(new)


def _last_group(table: pa.Table, keys: list[str]) -> int:
    return int(starts(table, keys)[-1])


def positions(df: DataFrame, order: list[str], size: str | None = None) -> DataFrame:
    """Add the dense global position ``pos`` (0-based) in the order of ``order`` and, for
    ``size``, the sum ``before`` of the sizes of all earlier rows.

    The rows are dealt by range and written once (a retried task can't deal them
    differently); prefix sums of the per-range totals, one row per range, place each range.
    Rows that tie on ``order`` (even equal rows) are told apart by ``_tie``, so that a value
    shared by a third of all rows is cut over several ranges like any other.
    """
    from pyspark.sql import Window

    n = parts(df)
    narrow = df.withColumn("_tie", F.monotonically_increasing_id())
    cols = [F.col(c).asc_nulls_first() for c in order] + [F.col("_tie")]
    dealt = narrow.repartitionByRange(n, *cols).withColumn("_range", F.spark_partition_id())
    table = materialize(dealt, "positions")
    amount = F.lit(0).cast("long") if size is None else F.col(size).cast("long")
    totals = table.groupBy("_range").agg(F.count("*").alias("_n"), F.sum(amount).alias("_s"))
    # one row per range: as many rows as there are shuffle partitions
    run = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.coalesce(F.sum("_n").over(run), F.lit(0)).alias("_n0"),
                            F.coalesce(F.sum("_s").over(run), F.lit(0)).alias("_s0"))
    own = Window.partitionBy("_range").orderBy(*cols)
    out = (table.withColumn("_rn", F.row_number().over(own) - 1)
           .withColumn("_run", F.coalesce(F.sum(amount).over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
           .join(F.broadcast(offsets), "_range")
           .withColumn("pos", F.col("_n0") + F.col("_rn")))
    if size is not None:
        out = out.withColumn("before", F.col("_s0") + F.col("_run"))
    return out.drop("_range", "_n0", "_s0", "_rn", "_run", "_tie")
