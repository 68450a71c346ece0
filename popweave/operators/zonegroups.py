"""Running population over ordered zones and balanced contiguous zone groups (WN1, WN2).

The running sum is a prefix scan: zones are dealt by range, each range sums its own, and the
totals of the ranges (one row a range) become offsets. No task holds all zones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from popweave.session import materialize


def running_population(zone_pop: DataFrame, zone_col: str = "zone",
                       pop_col: str = "population", out_col: str = "running") -> DataFrame:
    """Cumulative population in zone order (WN1)."""
    n = int(zone_pop.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(zone_pop.repartitionByRange(n, zone_col).sortWithinPartitions(zone_col)
                        .withColumn("_range", F.spark_partition_id()), "zone-ranges")
    totals = dealt.groupBy("_range").agg(F.sum(pop_col).alias("_sum"))
    # as many rows as there are ranges
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", F.sum("_sum").over(before).alias("_before"))
    own = Window.partitionBy("_range").orderBy(zone_col).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = F.sum(pop_col).over(own)
    return (dealt.withColumn("_run", run).join(F.broadcast(offsets), "_range")
            # sums of nulls only are null, as in one running sum
            .withColumn(out_col, F.when(F.col("_run").isNull() | F.col("_before").isNull(), F.coalesce("_run", "_before"))
                        .otherwise(F.col("_run") + F.col("_before")))
            .drop("_range", "_run", "_before"))


def balanced_groups(zone_pop: DataFrame, n: int, zone_col: str = "zone",
                    pop_col: str = "population", out_col: str = "group") -> DataFrame:
    """Split ordered zones into contiguous groups of near-equal population (WN2).

    Greedy rule: walking the zones in order with running total ``t``, a zone is put in
    the current group; if ``t - start > total / n`` the *next* zone opens a new group and
    ``start`` becomes ``t``. ``start`` begins at the first zone's running total.

    Each break is the first zone whose running total passes a known value: a lookup in the
    written prefix sums, which lie in zone order, so that the files' column ranges rule out all but one
    range of zones. A break uses up more than a group's share, so there are at most
    ``n`` of them; the driver holds their zone ids.
    """
    cum = materialize(running_population(zone_pop.select(zone_col, F.coalesce(pop_col, F.lit(0)).alias(pop_col)),
                                         zone_col, pop_col, "_cum"), "zone-prefix-sums")
    ends = cum.agg(F.max("_cum").alias("total"), F.min(F.struct(zone_col, "_cum")).alias("first")).first()
    breaks: list = []
    if ends.first is not None:
        limit, start = float(ends.total) / float(n), ends.first["_cum"]
        while True:
            passed = (F.col("_cum") - F.lit(start)).cast("double") > limit
            # the second predicate is the pushed form of the first
            hit = cum.filter(passed & (F.col("_cum") > F.lit(start))).agg(F.min(F.struct(zone_col, "_cum")).alias("z")).first().z
            if hit is None:
                break
            breaks.append(hit[zone_col])
            start = hit["_cum"]
    group = F.lit(1)
    for b in breaks:
        group = group + (F.col(zone_col) > b).cast("int")
    return cum.select(zone_col, group.cast("int").alias(out_col))
