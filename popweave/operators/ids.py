"""Dense ids, first-row dedup and household numbers (WN3, WN4, JN6, PL2).

``dense_position`` numbers rows 1..n in a total order without funnelling them through
one task (an un-partitioned ``row_number()`` would): rows are range-partitioned and
sorted on the order key, each partition's row count is taken (one row per partition),
the counts are turned into offsets on that tiny table, and each row's id is its
partition offset plus its position inside the partition. The numbered frame is
written as a table under the session's checkpoint folder (one job) so a lost executor
recomputes nothing that could renumber.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popweave.session import materialize


def dense_position(df: DataFrame, order_cols: Sequence[str], out_col: str,
                   num_partitions: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row in ``order_cols`` order (WN3)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_cols)
              .sortWithinPartitions(*order_cols)
              .withColumn("_pid", F.spark_partition_id())
              .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        ranged = materialize(ranged, "positions")
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: the un-partitioned window runs over n rows, not over records
    offsets = counts.select("_pid", "_first",
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = ranged.join(F.broadcast(offsets), "_pid", "inner")  # exactly n rows
    return out.withColumn(out_col, F.col("_off") + (F.col("_mid") - F.col("_first")) + 1) \
              .drop("_pid", "_mid", "_first", "_off")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Keep the first row per key under ``order``, ties broken by every other column (WN4).

    Written as ``min(struct(order..., rest...))`` per key: an aggregate, so it is partially
    combined map-side and a hot key never lands whole in one task, unlike a
    ``row_number()`` window partitioned by the key.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(F.min(packed).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest],
                      *[F.col(f"_r._o{i}").alias(c) for i, c in enumerate(order)]) \
              .select(*df.columns)


def assign_hhnum(households: DataFrame, persons: DataFrame,
                 key: str = "household_id") -> tuple[DataFrame, DataFrame]:
    """Household table with dense ``hhnum`` 1..n in key order; persons left-joined to it
    (PL2, JN6). The person join is on the household key, a co-partitionable equi-join."""
    hh = dense_position(households, [key], "hhnum")
    pers = persons.join(hh.select(key, "hhnum"), key, "left")
    return hh, pers
